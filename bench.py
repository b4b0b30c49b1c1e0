"""Time every registered query and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. Each query is
materialised into Spark's no-op sink, once to warm up and then for the best of
BENCH_RUNS timed runs, all alike. The test tables are one file each, so their lines
are spread over the cores. With
BENCH_BASELINE=1 the SQL oracles are timed too, in DuckDB on as many threads.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from sedimenta.plans.feed import PARTITIONS
from sedimenta.plans.oracles import ORACLES
from sedimenta.plans.queries import QUERIES
from sedimenta.session import build_session

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# Oracles whose query also writes files in a given layout, which the baseline
# then writes as well.
WRITTEN = {
    "bronze_partition_roundtrip":
        "(FORMAT PARQUET, PARTITION_BY (proc_year, proc_month, proc_date), COMPRESSION SNAPPY)",
    "silver_partition_overwrite": "(FORMAT PARQUET, PARTITION_BY (proc_year), COMPRESSION SNAPPY)",
    "delimited_roundtrip": "(FORMAT CSV, DELIMITER ';', HEADER FALSE)",
}


def timed(action) -> float:
    started = time.perf_counter()
    action()
    return time.perf_counter() - started


def best(action, runs: int) -> float:
    action()
    return min(timed(action) for _ in range(runs))


def spark_times(sf_dir: str, cpus: int, runs: int, names: list[str]) -> dict[str, float]:
    with tempfile.TemporaryDirectory(prefix="bench-") as scratch:
        return _spark_times(sf_dir, cpus, runs, names, scratch)


def _spark_times(sf_dir: str, cpus: int, runs: int, names: list[str], scratch: str) -> dict[str, float]:
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": str(cpus),
            PARTITIONS: str(cpus),
            "spark.checkpoint.dir": f"{scratch}/tables",
            "spark.sql.warehouse.dir": f"{scratch}/warehouse",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name):
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()

    run(names[0])
    times = {name: round(best(lambda: run(name), runs), 3) for name in names}
    spark.stop()
    return times


def baseline_times(sf_dir: str, cpus: int, runs: int, names: list[str]) -> dict[str, float]:
    import duckdb

    con = duckdb.connect()
    con.execute(f"SET threads = {cpus}")
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    with tempfile.TemporaryDirectory(prefix="bench-") as scratch:
        turn = iter(range(1_000_000))

        def run(name):
            if name in WRITTEN:
                target = f"{scratch}/{name}-{next(turn)}"
                con.execute(f"COPY ({ORACLES[name]}) TO '{target}' {WRITTEN[name]}")
                return
            con.execute(f"CREATE OR REPLACE TEMP TABLE result AS {ORACLES[name]}")

        return {name: round(best(lambda: run(name), runs), 3) for name in names}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or list(QUERIES)
    times = spark_times(sf_dir, cpus, runs, names)
    result = {
        "metric": "total_query_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
    }
    if os.environ.get("BENCH_BASELINE") == "1":
        result["baseline"] = baseline_times(sf_dir, cpus, runs, names)
    print(json.dumps(result))


if __name__ == "__main__":
    main()
