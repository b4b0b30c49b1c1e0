"""The registered queries as plain SQL over the same tables."""

from __future__ import annotations

AS_OF = "DATE '2001-08-15'"
EARLIER = "DATE '1999-08-15'"

SOURCE_COLUMNS = """src_order, src_line, ean, store_tax_id, issue_month, product, manufacturer,
       supplier, supplier_tax_id, product_group, subclass, brand, amount, quantity,
       issue_date, proc_date"""

FEED = """
feed_all AS (
  SELECT l_orderkey AS src_order, l_linenumber AS src_line,
         lpad(CAST(l_partkey AS VARCHAR), 13, '0') AS ean,
         lpad(CAST(o_custkey AS VARCHAR), 14, '0') AS store_tax_id,
         CAST(year(l_shipdate) * 100 + month(l_shipdate) AS VARCHAR) AS issue_month,
         CASE WHEN p_type = 'PROMO' THEN p_name || '; x' ELSE p_name END AS product,
         'Maker ' || substring(p_brand, 7, 1) AS manufacturer,
         CASE WHEN l_linenumber = 1 THEN s_name || ' Ltd' ELSE s_name END AS supplier,
         CAST(l_suppkey AS VARCHAR) AS supplier_tax_id,
         p_type AS product_group,
         CASE WHEN p_size >= 5 THEN CAST(p_size AS VARCHAR) END AS subclass,
         CASE WHEN p_size <= 45 THEN p_brand END AS brand,
         CAST(l_extendedprice AS DECIMAL(15,4)) AS amount,
         l_quantity + CASE WHEN l_linenumber = 2 THEN 0.5 ELSE 0.0 END AS quantity,
         CAST(l_shipdate AS DATE) AS issue_date,
         CAST(date_trunc('week', CAST(l_shipdate AS DATE)) AS DATE)
           + CASE l_returnflag WHEN 'N' THEN 8 WHEN 'A' THEN 9 ELSE 10 END AS proc_date,
         CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus <> 'O'
              THEN 'LATE' ELSE 'DAILY' END AS origin,
         l_returnflag, l_linestatus
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
)"""

SOURCES = f"""{FEED},
feed_daily AS (
  SELECT {SOURCE_COLUMNS} FROM feed_all
  WHERE origin = 'DAILY' AND proc_date <> DATE '2001-08-12'
),
feed_late AS (
  SELECT {SOURCE_COLUMNS} FROM feed_all
  WHERE origin = 'LATE' AND proc_date <> DATE '2001-08-12'
  UNION ALL
  SELECT {SOURCE_COLUMNS} FROM feed_all
  WHERE origin = 'LATE' AND proc_date <> DATE '2001-08-12' AND l_returnflag = 'R'
),
totals AS (
  SELECT proc_date, count(*) AS expected_rows FROM feed_daily GROUP BY proc_date
  UNION ALL
  SELECT proc_date, count(*) AS expected_rows FROM feed_late GROUP BY proc_date
  UNION ALL
  SELECT DATE '2001-08-12', 5
),
lake AS (
  SELECT {SOURCE_COLUMNS}, origin FROM feed_all
  WHERE proc_date <> DATE '2001-08-12' AND day(proc_date) <> 9
    AND (origin = 'DAILY' OR l_returnflag = 'N' OR l_linestatus = 'F')
)"""

REPORT = f"""{SOURCES},
recent AS (
  SELECT CAST(d AS DATE) AS proc_date
  FROM generate_series({AS_OF} - INTERVAL 7 DAY, {AS_OF} - INTERVAL 1 DAY, INTERVAL 1 DAY) s(d)
),
looked_at AS (
  SELECT proc_date, 'recent' AS reason FROM recent
  UNION ALL
  SELECT DISTINCT proc_date, 'flagged' FROM feed_late
  WHERE proc_date IS NOT NULL AND proc_date NOT IN (SELECT proc_date FROM recent)
),
report AS (
  SELECT l.proc_date, l.reason,
         CAST(coalesce(e.n, 0) AS BIGINT) AS expected_rows,
         CAST(coalesce(a.n, 0) AS BIGINT) AS actual_rows,
         coalesce(e.n, 0) <> coalesce(a.n, 0) AS diverged,
         coalesce(a.n, 0) > 0 AS has_lake
  FROM looked_at l
  LEFT JOIN (SELECT proc_date, sum(expected_rows) AS n FROM totals GROUP BY proc_date) e
    ON l.proc_date = e.proc_date
  LEFT JOIN (SELECT proc_date, count(*) AS n FROM lake GROUP BY proc_date) a
    ON l.proc_date = a.proc_date
)"""

DIVERGED = "(SELECT proc_date FROM report WHERE diverged AND has_lake)"
EMPTY = "(SELECT proc_date FROM report WHERE diverged AND NOT has_lake)"
FOLDERS = ("CAST(year(proc_date) AS INTEGER) AS proc_year, "
           "lpad(CAST(month(proc_date) AS VARCHAR), 2, '0') AS proc_month")

REPAIRED = f"""{REPORT},
merged AS (
  SELECT * FROM lake WHERE proc_date IN {DIVERGED}
  UNION
  SELECT *, 'LATE' AS origin FROM feed_late WHERE proc_date IN {DIVERGED}
),
loaded AS (
  SELECT *, 'DAILY' AS origin FROM feed_daily WHERE proc_date IN {EMPTY}
  UNION ALL
  SELECT *, 'LATE' AS origin FROM feed_late WHERE proc_date IN {EMPTY}
)"""


def rollup(source: str, as_of: str = AS_OF) -> str:
    return f"""
  SELECT ean, store_tax_id, CAST(strptime(issue_month, '%Y%m') AS DATE) AS issue_month,
         proc_year, product, manufacturer, max(supplier) AS supplier,
         lpad(CAST(supplier_tax_id AS VARCHAR), 14, '0') AS supplier_tax_id,
         product_group, subclass, brand,
         CAST(sum(amount) AS DECIMAL(25,4)) AS amount, sum(quantity) AS quantity
  FROM (SELECT *, CAST(year(proc_date) AS INTEGER) AS proc_year FROM {source}) r
  WHERE issue_date >= date_trunc('month', {as_of}) - INTERVAL 24 MONTH
  GROUP BY ean, store_tax_id, r.issue_month, proc_year, product, manufacturer,
           r.supplier_tax_id, product_group, subclass, brand"""


SILVER = f"{FEED},\nsilver AS ({rollup('feed_all')}\n)"


def key(*columns: str) -> str:
    parts = ", ".join(
        f"CASE WHEN {c} IS NULL THEN '-' ELSE concat(CAST(length({c}) AS VARCHAR), ':', {c}) END"
        for c in columns
    )
    return f"md5(concat({parts}))"


def fact_key(*columns: str) -> str:
    return f"CASE WHEN {columns[0]} IS NOT NULL THEN {key(*columns)} END"


FACT_COLUMNS = f"""
         {fact_key('ean', 'product')} AS product_id,
         {fact_key('brand')} AS brand_id,
         {fact_key('manufacturer')} AS manufacturer_id,
         {fact_key('product_group', 'subclass')} AS group_id"""

FACT_VALUES = """
         CAST(supplier_tax_id AS VARCHAR) AS supplier_tax_id,
         CAST(store_tax_id AS VARCHAR) AS store_tax_id,
         CAST(issue_month AS DATE) AS issue_month,
         CAST(amount AS DECIMAL(15,4)) AS amount,
         CAST(quantity AS INTEGER) AS quantity"""

FACT = f"{SILVER},\nfact AS (SELECT {FACT_COLUMNS}, {FACT_VALUES} FROM silver)"


def members(id_column: str, columns: list[str], renames: dict[str, str] | None = None) -> str:
    names = renames or {}
    shown = ", ".join(
        f"regexp_replace({c}, '[\\n\\r;]', '', 'g') AS {names.get(c, c)}" for c in columns
    )
    return f"""
  SELECT {key(*columns)} AS {id_column}, {shown}, max(issue_month) AS issue_month
  FROM silver WHERE {columns[0]} IS NOT NULL GROUP BY ALL"""


DIMENSIONS = {
    "dim_manufacturer": members("manufacturer_id", ["manufacturer"]),
    "dim_supplier": members("supplier_id", ["supplier", "supplier_tax_id"]),
    "dim_brand": members("brand_id", ["brand"], {"brand": "brand_name"}),
    "dim_group": members("group_id", ["product_group", "subclass"]),
    "dim_product": members("product_id", ["ean", "product"]),
}

RUN_TABLES = f"""{REPAIRED},
bronze AS (
  SELECT * FROM lake
  WHERE proc_date NOT IN (SELECT proc_date FROM merged UNION ALL SELECT proc_date FROM loaded)
  UNION ALL SELECT * FROM merged
  UNION ALL SELECT * FROM loaded
),
silver AS ({rollup('bronze')}
)"""


def orphans() -> str:
    checks = {
        "product_id": ("dim_product", fact_key("ean", "product")),
        "brand_id": ("dim_brand", fact_key("brand")),
        "manufacturer_id": ("dim_manufacturer", fact_key("manufacturer")),
        "group_id": ("dim_group", fact_key("product_group", "subclass")),
        "supplier_id": ("dim_supplier", fact_key("supplier", "supplier_tax_id")),
    }
    selects = [
        f"""
  SELECT '{name}' AS key_name, count(*) AS orphans FROM (
    SELECT DISTINCT {expression} AS k FROM silver
  ) f WHERE k IS NOT NULL AND k NOT IN (SELECT {name} FROM ({DIMENSIONS[table]}) d)"""
        for name, (table, expression) in checks.items()
    ]
    return f"WITH {SILVER}" + "\n  UNION ALL".join(selects)


AGAIN = f"""{REPAIRED},
again AS (
  SELECT * FROM lake WHERE proc_date NOT IN (SELECT proc_date FROM report WHERE diverged)
  UNION ALL SELECT * FROM merged
  UNION ALL SELECT * FROM loaded
),
still AS (
  SELECT l.proc_date
  FROM looked_at l
  JOIN (SELECT proc_date, count(*) AS n FROM again GROUP BY proc_date) a ON l.proc_date = a.proc_date
  LEFT JOIN (SELECT proc_date, sum(expected_rows) AS n FROM totals GROUP BY proc_date) e
    ON l.proc_date = e.proc_date
  WHERE coalesce(e.n, 0) <> a.n
),
lacking AS (SELECT *, 'LATE' AS origin FROM feed_late EXCEPT SELECT * FROM again),
repeated AS (SELECT *, count(*) AS n FROM again GROUP BY ALL HAVING count(*) > 1)
SELECT proc_date,
       proc_date IN (SELECT proc_date FROM lacking) OR proc_date IN (SELECT proc_date FROM repeated) AS changed
FROM still"""


def published() -> str:
    columns = {
        "dim_manufacturer": ("manufacturer_id", "manufacturer", None),
        "dim_supplier": ("supplier_id", "supplier", "supplier_tax_id"),
        "dim_brand": ("brand_id", "brand_name", None),
        "dim_group": ("group_id", "product_group", "subclass"),
        "dim_product": ("product_id", "ean", "product"),
    }
    selects = [
        f"SELECT '{table}' AS table_name, {key_name} AS member_key, {first} AS first_attribute, "
        f"CAST({second or 'NULL'} AS VARCHAR) AS second_attribute, issue_month, "
        f"'2001-08-15 03:00:00' AS stamp FROM ({DIMENSIONS[table]}) d"
        for table, (key_name, first, second) in columns.items()
    ]
    return f"WITH {SILVER} " + " UNION ALL ".join(selects)


def contents(columns: list[str]) -> str:
    """A number that changes with any value of any row, whatever the order of rows."""
    joined = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in columns)
    return f"CAST(sum(('0x' || substr(md5(concat_ws('|', {joined})), 1, 12))::BIGINT) AS VARCHAR) AS contents"


def sizes() -> str:
    total = "CAST(sum({}) AS DECIMAL(25,4)) AS amount_total"
    selects = [
        f"SELECT '{t}' AS table_name, count(*) AS row_count, {total.format('amount')}, "
        f"{contents(RUN_CONTENTS[t])} FROM {t}" for t in ("bronze", "silver")
    ]
    selects.append(
        f"SELECT 'fact_purchases', count(*), {total.format('amount')}, "
        f"{contents(RUN_CONTENTS['fact_purchases'])} FROM (SELECT {FACT_COLUMNS}, {FACT_VALUES} FROM silver) f"
    )
    selects += [
        f"SELECT '{name}', count(*), {total.format('NULL')}, {contents(RUN_CONTENTS[name])} FROM ({sql}) d"
        for name, sql in DIMENSIONS.items()
    ]
    return f"WITH {RUN_TABLES}\n" + "\nUNION ALL ".join(selects)


# The columns whose values a run is compared by; all but stamps, row ids and doubles.
RUN_CONTENTS = {
    "bronze": ["src_order", "src_line", "ean", "store_tax_id", "issue_month", "product", "manufacturer",
               "supplier", "supplier_tax_id", "product_group", "subclass", "brand", "amount", "issue_date",
               "proc_date", "origin"],
    "silver": ["ean", "store_tax_id", "issue_month", "proc_year", "product", "manufacturer", "supplier",
               "supplier_tax_id", "product_group", "subclass", "brand", "amount"],
    "fact_purchases": ["product_id", "brand_id", "manufacturer_id", "group_id", "supplier_tax_id",
                       "store_tax_id", "issue_month", "amount", "quantity"],
    "dim_manufacturer": ["manufacturer_id", "manufacturer", "issue_month"],
    "dim_supplier": ["supplier_id", "supplier", "supplier_tax_id", "issue_month"],
    "dim_brand": ["brand_id", "brand_name", "issue_month"],
    "dim_group": ["group_id", "product_group", "subclass", "issue_month"],
    "dim_product": ["product_id", "ean", "product", "issue_month"],
}

ORACLES: dict[str, str] = {
    "monthly_rollup": f"WITH {SILVER} SELECT * FROM silver",
    "rolling_window_filter": f"""WITH {FEED}
SELECT {SOURCE_COLUMNS}, origin FROM feed_all
WHERE issue_date >= date_trunc('month', {AS_OF}) - INTERVAL 24 MONTH""",
    "representative_supplier": f"""WITH {FEED}
SELECT supplier_tax_id, max(supplier) AS supplier FROM feed_all GROUP BY supplier_tax_id""",
    "fact_build": f"WITH {FACT} SELECT * FROM fact",
    "fact_with_supplier_key": f"""WITH {SILVER}
SELECT {FACT_COLUMNS}, {fact_key('supplier', 'supplier_tax_id')} AS supplier_id, {FACT_VALUES}
FROM silver""",
    **{name: f"WITH {SILVER} {sql}" for name, sql in DIMENSIONS.items()},
    "fact_key_integrity": orphans(),
    "expected_counts": f"""WITH {SOURCES}
SELECT proc_date, CAST(coalesce(sum(expected_rows), 0) AS BIGINT) AS expected_rows
FROM totals GROUP BY proc_date""",
    "actual_counts": f"""WITH {SOURCES}
SELECT proc_date, count(*) AS actual_rows FROM lake GROUP BY proc_date""",
    "late_dates": f"""WITH {SOURCES}
SELECT DISTINCT proc_date FROM feed_late WHERE proc_date IS NOT NULL""",
    "reconcile_recent": f"""WITH {REPORT}
SELECT proc_date, expected_rows, actual_rows, diverged, has_lake
FROM report WHERE reason = 'recent' ORDER BY proc_date DESC""",
    "reconcile_flagged": f"""WITH {REPORT}
SELECT proc_date, expected_rows, actual_rows, diverged, has_lake
FROM report WHERE reason = 'flagged' ORDER BY proc_date DESC""",
    "reconcile_report": f"WITH {REPORT} SELECT * FROM report ORDER BY proc_date DESC",
    "initial_load": f"""WITH {SOURCES}
SELECT *, 'DAILY' AS origin FROM feed_daily
UNION ALL SELECT *, 'LATE' AS origin FROM feed_late""",
    "late_merge": f"""WITH {SOURCES}
SELECT * FROM lake UNION SELECT *, 'LATE' AS origin FROM feed_late""",
    "repair_all": f"""WITH {REPAIRED}
SELECT *, {FOLDERS} FROM (SELECT * FROM merged UNION ALL SELECT * FROM loaded) r""",
    "repair_reread_daily": f"""WITH {REPAIRED}
SELECT *, {FOLDERS} FROM (
  (SELECT * FROM merged
   UNION SELECT *, 'DAILY' AS origin FROM feed_daily WHERE proc_date IN {DIVERGED})
  UNION ALL SELECT * FROM loaded
) r""",
    "repair_again": f"WITH {AGAIN}",
    "published_dimensions": published(),
    "bronze_partition_roundtrip": f"""WITH {SOURCES}
SELECT *, {FOLDERS} FROM (
  SELECT *, 'DAILY' AS origin FROM feed_daily
  UNION ALL SELECT *, 'LATE' AS origin FROM feed_late
) r""",
    "silver_partition_overwrite": f"""WITH {SILVER},
earlier AS ({rollup('feed_all', EARLIER)}
)
SELECT * FROM silver
UNION ALL
SELECT * FROM earlier WHERE proc_year NOT IN (SELECT proc_year FROM silver)""",
    "delimited_roundtrip": f"WITH {SILVER} SELECT * FROM silver",
    "swap_publish": f"WITH {FACT} SELECT * FROM fact",
    "load_metrics": f"""WITH {FACT}
SELECT 'fact_purchases' AS table_name, count(*) AS row_count,
       CAST(sum(amount) AS DECIMAL(25,4)) AS amount_total FROM fact""",
    "fact_row_ids": f"""WITH {FACT}
SELECT count(*) AS row_count, count(*) AS distinct_ids, 1::BIGINT AS first_id, count(*) AS last_id FROM fact""",
    "layered_run": sizes(),
}
