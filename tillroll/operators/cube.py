"""A stored daily cube: slices by day and dimension without the sales rows.

A cell is one day and one value of each dimension. It keeps partial sums and counts, and the orders
that have a row in it as bitmaps over dense order numbers, 32,768 orders a bitmap. Sums add up and
bitmaps are united over any cells, so distinct orders of a slice are exact. Orders are numbered by
their first day, so that those of a day share few bitmaps; where days hold many rows per cell, the
cube is smaller than the sales by that factor.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions import money_sum, ratio_or_zero
from tillroll.operators.features import ensure_revenue_columns, in_slice
from tillroll.operators.totals import ORDERS, OVERALL, merged_totals, overall_part, partial_sums
from tillroll.schema import DIMENSIONS

#: Stores a table under a name and gives it back as stored.
Keep = Callable[[DataFrame, str], DataFrame]
CELL = ["order_date", *DIMENSIONS]


@dataclass(frozen=True)
class Cube:
    cells: DataFrame
    orders: DataFrame


def build_cube(sales: DataFrame, keep: Keep) -> Cube:
    """The cube of a sales table. ``keep`` stores its tables: order numbers, cells and bitmaps.

    Rows without a date or a dimension value have cells of their own, with that part null; rows
    without an order id count in the sums only. An order id that many rows share is one row a day,
    with the cells it has there, before anything is shuffled by it. Bitmaps are made where all orders
    of one have come together, so that none is shuffled or sorted.
    """
    rows = ensure_revenue_columns(sales).withColumn("order_date", F.to_date("order_date"))
    cells = keep(_dated(rows.groupBy(*CELL).agg(*partial_sums())), "cells")
    ordered = rows.where(F.col("order_id").isNotNull())
    days = ordered.groupBy("order_id", "order_date").agg(F.collect_set(F.struct(*DIMENSIONS)).alias("cells"))
    first = ordered.groupBy("order_id").agg(F.min("order_date").alias("first_day"))
    # Numbers are drawn once, when they are stored.
    numbers = keep(
        first.repartitionByRange("first_day", "order_id")
        .sortWithinPartitions("first_day", "order_id")
        .select("order_id", F.monotonically_increasing_id().alias("number")),
        "order_numbers",
    )
    bitmaps = (
        days.join(numbers, "order_id")
        .select("order_date", "number", F.bitmap_bucket_number("number").alias("bucket"), F.inline("cells"))
        .repartition(*CELL, "bucket")
        .groupBy(*CELL, "bucket")
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap"))
    )
    return Cube(cells, keep(_dated(bitmaps), "orders"))


def _dated(df: DataFrame) -> DataFrame:
    """With year and month, by which slices prune."""
    return df.withColumns({"year": F.year("order_date"), "month": F.month("order_date")})


def read_cube(spark: SparkSession, path: str) -> Cube:
    """A cube whose tables were kept under ``path``."""
    return Cube(spark.read.parquet(f"{path}/cells"), spark.read.parquet(f"{path}/orders"))


def slice_cube(cube: Cube, **bounds) -> Cube:
    """The cells of a slice; takes the keyword arguments of ``in_slice``."""
    return Cube(*[table.where(in_slice(table, **bounds)) for table in (cube.cells, cube.orders)])


def cube_totals(cube: Cube) -> DataFrame:
    """What ``sales_totals`` gives of the rows behind the cube, from its cells."""
    totals = merged_totals(cube.cells)
    keys = [F.struct(F.lit(name).alias("set_name"), F.col(name).alias("set_key")) for name in DIMENSIONS]
    whole = F.struct(F.lit(OVERALL).alias("set_name"), F.lit(None).cast("string").alias("set_key"))
    spread = cube.orders.select("bucket", "bitmap", F.inline(F.array(*keys, whole)))
    orders = _united(spread, "set_name", "set_key")
    matched = (F.col("dimension") == F.col("set_name")) & F.col("key").eqNullSafe(F.col("set_key"))
    counted = F.coalesce(ORDERS, F.lit(0).cast("bigint")).alias(ORDERS)
    return totals.join(orders, matched, "left").select(*totals.columns, counted)


def _united(orders: DataFrame, *keys: str) -> DataFrame:
    """Distinct orders per key: bitmaps of the same orders are united, then counted."""
    united = orders.groupBy(*keys, "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("n"))
    return united.groupBy(*keys).agg(F.sum("n").alias(ORDERS))


def cube_overall(cube: Cube) -> DataFrame:
    """The totals of all cells as one row, also where there are none."""
    orders = _united(cube.orders).select(F.coalesce(ORDERS, F.lit(0).cast("bigint")).alias(ORDERS))
    whole = merged_totals(cube.cells, by_dimension=False)
    return overall_part(whole.crossJoin(orders))


def cube_share(cube: Cube, **bounds) -> DataFrame:
    """Revenue and orders of a slice as a percentage of all cells, like ``slice_share``."""
    inside = F.coalesce(in_slice(cube.cells, **bounds), F.lit(False))
    sums = cube.cells.agg(
        money_sum("total_revenue_sum").alias("table_revenue"),
        money_sum(F.when(inside, F.col("total_revenue_sum"))).alias("slice_revenue"),
    )
    united = cube.orders.groupBy("bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("table_orders"),
        F.bitmap_count(
            F.bitmap_or_agg(F.when(F.coalesce(in_slice(cube.orders, **bounds), F.lit(False)), F.col("bitmap")))
        ).alias("slice_orders"),
    )
    orders = united.agg(
        *[F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name) for name in ("table_orders", "slice_orders")]
    )
    return sums.crossJoin(orders).select(
        "slice_revenue",
        "slice_orders",
        (ratio_or_zero(F.col("slice_revenue"), F.col("table_revenue")) * 100).alias("revenue_share_pct"),
        (ratio_or_zero(F.col("slice_orders"), F.col("table_orders")) * 100).alias("order_share_pct"),
    )
