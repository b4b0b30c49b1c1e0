"""The purchase model: feed schema, rollup, fact and dimensions."""

from __future__ import annotations

from sedimenta.specs import (
    ColumnSpec,
    DimensionSpec,
    FactSpec,
    KeySpec,
    LakeLayout,
    RollupSpec,
)

LAYOUT = LakeLayout()

DAILY = "DAILY"
LATE = "LATE"
ORIGIN = "origin"

RECENT_DAYS = 7

ROLLUP = RollupSpec(
    keys=(
        "ean",
        "store_tax_id",
        "issue_month",
        "proc_year",
        "product",
        "manufacturer",
        "supplier_tax_id",
        "product_group",
        "subclass",
        "brand",
    ),
    month_key="issue_month",
    year_key="proc_year",
    event_date="issue_date",
    sums=("amount", "quantity"),
    representatives=("supplier",),
    padded=("supplier_tax_id",),
    output=(
        "ean",
        "store_tax_id",
        "issue_month",
        "proc_year",
        "product",
        "manufacturer",
        "supplier",
        "supplier_tax_id",
        "product_group",
        "subclass",
        "brand",
        "amount",
        "quantity",
    ),
)

PRODUCT_KEY = KeySpec("product_id", ("ean", "product"))
BRAND_KEY = KeySpec("brand_id", ("brand",))
MANUFACTURER_KEY = KeySpec("manufacturer_id", ("manufacturer",))
GROUP_KEY = KeySpec("group_id", ("product_group", "subclass"))
SUPPLIER_KEY = KeySpec("supplier_id", ("supplier", "supplier_tax_id"))

FACT = FactSpec(
    table="fact_purchases",
    keys=(PRODUCT_KEY, BRAND_KEY, MANUFACTURER_KEY, GROUP_KEY),
    columns=(
        ColumnSpec("supplier_tax_id", "supplier_tax_id", "varchar(20)"),
        ColumnSpec("store_tax_id", "store_tax_id", "varchar(20)"),
        ColumnSpec("issue_month", "issue_month", "date"),
        ColumnSpec("amount", "amount", "decimal(15,4)"),
        ColumnSpec("quantity", "quantity", "int"),
    ),
    month="issue_month",
    totals=("amount",),
    lookups=("product_id", "brand_id", "manufacturer_id", "group_id",
             "supplier_tax_id", "store_tax_id", "issue_month"),
)

DIM_MANUFACTURER = DimensionSpec(
    "dim_manufacturer", MANUFACTURER_KEY, ("manufacturer",), "issue_month"
)
DIM_SUPPLIER = DimensionSpec(
    "dim_supplier", SUPPLIER_KEY, ("supplier", "supplier_tax_id"), "issue_month"
)
DIM_BRAND = DimensionSpec(
    "dim_brand", BRAND_KEY, ("brand",), "issue_month", renames={"brand": "brand_name"}
)
DIM_GROUP = DimensionSpec(
    "dim_group", GROUP_KEY, ("product_group", "subclass"), "issue_month"
)
DIM_PRODUCT = DimensionSpec(
    "dim_product", PRODUCT_KEY, ("ean", "product"), "issue_month"
)

DIMENSIONS = (DIM_MANUFACTURER, DIM_SUPPLIER, DIM_BRAND, DIM_GROUP, DIM_PRODUCT)
