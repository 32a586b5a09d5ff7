"""Sales rows from a star schema of order lines, orders, parts, customers and regions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions import blank_missing
from tillroll.schema import RAW_COLUMNS

# Which dimension table a sales column needs; all other columns come from the order line.
_NEEDS = {
    "order_date": "orders",
    "payment_method": "orders",
    "product_category": "part",
    "product_brand": "part",
    "price": "part",
    "rating": "part",
    "discounted_price": "part",
    "total_revenue": "part",
    "customer_region": "region",
}

# The columns read from each table. Naming them saves a job per table that infers the schema.
TABLES = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, "
    "l_discount double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "part": "p_partkey bigint, p_brand string, p_type string, p_size int, p_retailprice double",
    "customer": "c_custkey bigint, c_nationkey int",
    "nation": "n_nationkey int, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}

# Every n-th order carries this defect in the raw table, per column and in order.
DEFECTS = {
    "order_date": [(101, "invalid")],
    "price": [(103, "-5"), (139, "abc"), (149, "inf")],
    "quantity_sold": [(107, "0")],
    "discount_percent": [(109, "120"), (113, "-20")],
    "rating": [(127, "7"), (131, "N/A")],
    "payment_method": [(137, None)],
}


def sales_view(
    spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None
) -> DataFrame:
    """The sales table over the star schema, all order lines.

    The dimensions are joined on their primary keys from the left, so a join whose columns
    are not asked for cannot change the rows and is left out. Which side is broadcast is
    left to Spark, which knows the sizes.
    """
    wanted = list(columns) if columns is not None else [*RAW_COLUMNS, "product_brand"]
    needed = {_NEEDS.get(name) for name in wanted}

    def table(name: str) -> DataFrame:
        return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")

    rows = table("lineitem")
    if needed & {"orders", "region"}:
        orders = table("orders")
        if "region" in needed:
            # Regions are brought to the orders first, so that the order lines, several times
            # as many, are not shuffled once more by customer.
            orders = (
                orders.join(table("customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
                .join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
                .join(table("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
            )
        rows = rows.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    if "part" in needed:
        rows = rows.join(table("part"), F.col("l_partkey") == F.col("p_partkey"), "left")

    discount = F.col("l_discount") * 100
    discounted = F.col("p_retailprice") * (1 - discount / 100)
    meaning = {
        "order_id": F.col("l_orderkey"),
        "order_date": F.col("o_orderdate").cast("timestamp_ntz"),
        "product_id": F.col("l_partkey"),
        "product_category": F.col("p_type"),
        "product_brand": F.col("p_brand"),
        "price": F.col("p_retailprice"),
        "discount_percent": discount,
        "quantity_sold": F.col("l_quantity"),
        "customer_region": F.col("r_name"),
        "payment_method": F.col("o_orderpriority"),
        "rating": F.col("p_size").cast("double") / 10,
        "review_count": F.col("l_linenumber").cast("double"),
        "discounted_price": discounted,
        "total_revenue": discounted * F.col("l_quantity"),
    }
    return rows.select(*[meaning[name].alias(name) for name in wanted])


def raw_sales_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as text, as a delimited file would give them, with recurring defects."""
    sales = sales_view(spark, sf_dir, RAW_COLUMNS)
    text = {}
    for name in RAW_COLUMNS:
        value = F.col(name)
        if name == "order_date":
            value = F.date_format(value, "yyyy-MM-dd")
        elif sales.schema[name].dataType.typeName() == "double":
            value = value.cast("decimal(18,4)")
        shown = value.cast("string")
        for every, defect in reversed(DEFECTS.get(name, [])):
            shown = F.when(F.col("order_id") % every == 0, F.lit(defect)).otherwise(shown)
        text[name] = shown
    # One text record per row, as a scan would deliver it. Without this step Spark would push
    # filters on parsed values below the formatting and format each value several times.
    record = F.struct(*[column.alias(name) for name, column in text.items()])
    return blank_missing(sales.select(F.inline(F.array(record))))
