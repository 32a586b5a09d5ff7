"""Column lists, types and fixed values shared by the operators."""

from __future__ import annotations

from pyspark.sql import types as T

# The thirteen columns a raw sales table must carry, in file order.
RAW_COLUMNS = [
    "order_id",
    "order_date",
    "product_id",
    "product_category",
    "price",
    "discount_percent",
    "quantity_sold",
    "customer_region",
    "payment_method",
    "rating",
    "review_count",
    "discounted_price",
    "total_revenue",
]

TEXT_COLUMNS = ["product_category", "customer_region", "payment_method"]

NUMBER_COLUMNS = [name for name in RAW_COLUMNS if name not in ("order_date", *TEXT_COLUMNS)]

#: Holds the whole line of a delimited file where it has too few or too many fields.
MALFORMED = "_malformed_line"

#: Where a raw row stands: its file, the block of the file that was read, and a number that rises within it.
PLACE = "_place"

DIMENSIONS = ["product_category", "customer_region", "payment_method"]

MONEY_COLUMNS = ["total_revenue", "gross_revenue", "discount_value"]

# Cell texts that mean "missing" in a delimited file.
MISSING_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# Fields a product-metrics record must have.
METRICS_REQUIRED_FIELDS = [
    "contract_version",
    "pipeline_version",
    "generated_at_utc",
    "gross_revenue",
    "north_star_nrr",
    "period_end",
    "period_start",
    "raw_row_count",
    "clean_row_count",
    "row_retention_rate",
    "rows_dropped",
    "total_revenue",
]

# Versions and text of the contract.
CONTRACT_VERSION = "1.0.0"
METRICS_VERSION = "1.0.0"
CONTRACT_DESCRIPTION = "Raw sales dataset contract expected by preprocessing pipeline."


def _clean_type(name: str) -> T.DataType:
    if name == "order_date":
        return T.TimestampNTZType()
    return T.StringType() if name in TEXT_COLUMNS else T.DoubleType()


CLEAN_SCHEMA = T.StructType([T.StructField(name, _clean_type(name)) for name in RAW_COLUMNS])

ALERT_SCHEMA = T.StructType(
    [
        T.StructField("order_date", T.TimestampNTZType()),
        T.StructField("product_category", T.StringType()),
        T.StructField("avg_discount_percent", T.DoubleType()),
        T.StructField("baseline_mean", T.DoubleType()),
        T.StructField("baseline_std", T.DoubleType()),
        T.StructField("z_score", T.DoubleType()),
        T.StructField("gross_revenue", T.DoubleType()),
        T.StructField("estimated_leakage_usd", T.DoubleType()),
        T.StructField("severity", T.StringType()),
    ]
)
