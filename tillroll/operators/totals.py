"""Shared totals: the measures every report is cut from, overall or per dimension value.

Distinct orders are counted apart from the additive measures. In one aggregate Spark would
ship every sum buffer once per order id; apart, the additive part shuffles one row per group
and task, and the distinct part shuffles bare ids. That costs a second, narrow scan and
saves most of the shuffle. The distinct part is hashed by key *and* order id, so a key or an
id that holds a large share of the rows is spread or collapsed before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions import money_sum, ratio_or_zero
from tillroll.operators.features import ensure_revenue_columns
from tillroll.schema import DIMENSIONS

OVERALL = "overall"


ADDITIVE = {
    "row_count": lambda: F.count(F.lit(1)),
    "total_revenue": lambda: money_sum("total_revenue"),
    "gross_revenue": lambda: money_sum("gross_revenue"),
    "discount_value": lambda: money_sum("discount_value"),
    "total_units": lambda: money_sum("quantity_sold"),
    "avg_ticket": lambda: F.avg("total_revenue").cast("double"),
    "avg_rating": lambda: F.avg("rating"),
}
# The column a measure adds up or averages.
SOURCES = {
    "total_revenue": "total_revenue",
    "gross_revenue": "gross_revenue",
    "discount_value": "discount_value",
    "total_units": "quantity_sold",
    "avg_ticket": "total_revenue",
    "avg_rating": "rating",
}
ORDERS = "total_orders"


def _additive(names: Sequence[str]) -> list[Column]:
    return [ADDITIVE[name]().alias(name) for name in names if name != ORDERS]


def _order_count() -> Column:
    return F.count_distinct("order_id").alias(ORDERS)


def dimension_totals(df: DataFrame, dimension: str, *measures: str) -> DataFrame:
    """The named measures per non-null value of ``dimension``; ``avg_ticket`` is per row."""
    rows = ensure_revenue_columns(df).where(F.col(dimension).isNotNull())
    totals = rows.groupBy(dimension).agg(*_additive(measures))
    if ORDERS in measures:
        totals = totals.join(rows.groupBy(dimension).agg(_order_count()), dimension)
    return totals.select(dimension, *measures)


def overall_totals(df: DataFrame, *measures: str) -> DataFrame:
    """The named measures over the whole table, always exactly one row."""
    orders = df.agg(_order_count()) if ORDERS in measures else None
    additive = _additive(measures)
    if not additive:
        return orders
    totals = ensure_revenue_columns(df).agg(*additive)
    if orders is not None:
        totals = totals.crossJoin(orders)
    return totals.select(*measures)


def _sets(df: DataFrame, measures: list[Column]) -> DataFrame:
    """Group by each dimension and by nothing; the set and its key become plain columns."""
    grouped = df.groupingSets([[name] for name in DIMENSIONS] + [[]], *DIMENSIONS).agg(
        F.grouping_id().alias("set_id"), *measures
    )
    last = len(DIMENSIONS) - 1
    everything = (1 << len(DIMENSIONS)) - 1
    label = F.when(F.col("set_id") == everything, OVERALL)
    for position, name in enumerate(DIMENSIONS):
        label = label.when(F.col("set_id") == everything - (1 << (last - position)), name)
    shaped = grouped.withColumns({"dimension": label, "key": F.coalesce(*DIMENSIONS)})
    shaped = shaped.drop("set_id", *DIMENSIONS)
    return shaped.where((F.col("dimension") == OVERALL) | F.col("key").isNotNull())


def sales_totals(df: DataFrame, *measures: str) -> DataFrame:
    """Totals of all three dimensions and of the table, as rows ``(dimension, key, ...)``.

    Without names all measures are computed. The additive part first groups by the three
    dimensions together, so that the expansion into grouping sets runs over that small result
    and not over the rows.
    """
    measures = measures or (*ADDITIVE, ORDERS)
    rows = ensure_revenue_columns(df)
    totals = merged_totals(rows.groupBy(*DIMENSIONS).agg(*partial_sums(*measures)), *measures)
    if ORDERS not in measures:
        return totals
    orders = _orders_per_key(df).withColumnsRenamed({"dimension": "set_name", "key": "set_key"})
    matched = (F.col("dimension") == F.col("set_name")) & F.col("key").eqNullSafe(F.col("set_key"))
    return totals.join(orders, matched).select("dimension", "key", *measures)


def partial_sums(*measures: str) -> list[Column]:
    """Row count, and sum and count of every source column the measures need; aggregates that add up."""
    measures = measures or tuple(ADDITIVE)
    sums = [F.count(F.lit(1)).alias("row_count")]
    for source in {SOURCES[name]: None for name in measures if name in SOURCES}:
        sums.append(F.sum(source).alias(f"{source}_sum"))
        sums.append(F.count(source).alias(f"{source}_count"))
    return sums


def merged_totals(partials: DataFrame, *measures: str, by_dimension: bool = True) -> DataFrame:
    """Rows ``(dimension, key, ...)`` of the additive measures, from rows of ``partial_sums``."""
    measures = [name for name in measures or tuple(ADDITIVE) if name != ORDERS]
    merged = [_merged(name).alias(name) for name in measures]
    if by_dimension:
        return _sets(partials, merged)
    whole = partials.agg(*merged)
    return whole.select(F.lit(OVERALL).alias("dimension"), F.lit(None).cast("string").alias("key"), *measures)


def _orders_per_key(df: DataFrame) -> DataFrame:
    """Distinct orders per dimension value and overall.

    An order is one row with the values it has of each dimension, made by sorting the rows of a task
    where its orders are many. Spread into their keys these rows are only counted: no task holds a
    pair of order and key for each. Partial sets are merged by order, so neither a frequent key nor a
    frequent order id gathers in one task. Rows without an order id are one that does not count.
    """
    orders = df.groupBy("order_id").agg(*[F.collect_set(name).alias(name) for name in DIMENSIONS])

    def named(dimension: str, key: Column) -> Column:
        return F.struct(F.lit(dimension).alias("dimension"), key.alias("key"))

    keys = [F.transform(name, partial(named, name)) for name in DIMENSIONS]
    whole = F.array(named(OVERALL, F.lit(None).cast("string")))
    pairs = orders.select("order_id", F.inline(F.concat(*keys, whole)))
    return pairs.groupBy("dimension", "key").agg(F.count("order_id").alias(ORDERS))


def _merged(measure: str) -> Column:
    """A measure from partial sums and counts."""
    if measure == "row_count":
        return F.sum("row_count")
    source = SOURCES[measure]
    if measure.startswith("avg_"):
        return F.try_divide(F.sum(f"{source}_sum").cast("double"), F.sum(f"{source}_count"))
    return money_sum(f"{source}_sum")


def dimension_part(totals: DataFrame, dimension: str) -> DataFrame:
    """The rows of one dimension out of ``sales_totals``, shaped like ``dimension_totals``."""
    part = totals.where(F.col("dimension") == dimension).drop("dimension")
    return part.withColumnRenamed("key", dimension)


def overall_part(totals: DataFrame) -> DataFrame:
    """The table totals out of ``sales_totals``: one row, also when there were no rows at all."""
    whole = totals.where(F.col("dimension") == OVERALL)
    present = [name for name in (*ADDITIVE, ORDERS) if name in totals.columns]
    return whole.agg(
        *[
            F.max(name).alias(name)
            if name.startswith("avg_")
            else F.coalesce(F.max(name), F.lit(0)).alias(name)
            for name in present
        ]
    )


def retained_share() -> Column:
    """Net over gross revenue of a totals row, 0 without gross revenue."""
    return ratio_or_zero(F.col("total_revenue"), F.col("gross_revenue"))


def leakage() -> Column:
    """Revenue given away as discount in a totals row."""
    return F.col("gross_revenue") - F.col("total_revenue")
