"""Row-level revenue features and slicing of the sales table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions import a_number, ratio_or_zero, to_moment


MONTHS = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)
DAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def _names(names: Sequence[str]) -> Column:
    """Names to be looked up by number, which spares formatting a date in every row."""
    return F.array(*[F.lit(name) for name in names])


def ensure_revenue_columns(df: DataFrame) -> DataFrame:
    """Derive gross revenue and discount value where the table does not carry them."""
    if "gross_revenue" not in df.columns:
        df = df.withColumn("gross_revenue", a_number(F.col("price") * F.col("quantity_sold")))
    if "discount_value" not in df.columns:
        df = df.withColumn("discount_value", a_number(F.col("gross_revenue") - F.col("total_revenue")))
    return df


def build_features(df: DataFrame) -> DataFrame:
    """Add calendar parts, gross revenue, discount value and the three revenue ratios."""
    day = F.col("order_date")
    calendar = {
        "year": F.year(day),
        "month": F.month(day),
        "month_name": F.get(_names(MONTHS), F.month(day) - 1),
        "quarter": F.quarter(day),
        "day_of_week": F.get(_names(DAYS), F.weekday(day)),
        "is_weekend": F.coalesce(F.weekday(day) >= 5, F.lit(False)),
    }
    gross, net = F.col("gross_revenue"), F.col("total_revenue")
    ratios = {
        "net_revenue_retained": ratio_or_zero(net, gross),
        "revenue_per_unit": ratio_or_zero(net, F.col("quantity_sold")),
        "discount_impact_pct": ratio_or_zero(F.col("discount_value"), gross) * 100,
    }
    return (
        df.withColumn("order_date", to_moment(df, "order_date"))
        .withColumns(calendar)
        .withColumn("gross_revenue", a_number(F.col("price") * F.col("quantity_sold")))
        .withColumn("discount_value", a_number(gross - net))
        .withColumns(ratios)
    )


def in_slice(
    df: DataFrame,
    start: date | None = None,
    end: date | None = None,
    region: str | None = None,
    category: str | None = None,
    payment: str | None = None,
) -> Column:
    """Predicate of a slice: inclusive dates plus optional equality on each dimension.

    The dates bound the raw column, so the predicate reaches the file statistics; where the
    table has year and month (the partition columns of the processed table) they are bounded
    as well, which prunes whole partitions.
    """
    keep = F.lit(True)
    month_number = F.col("year") * 12 + F.col("month") if {"year", "month"} <= set(df.columns) else None
    if start is not None:
        keep = keep & (F.col("order_date") >= F.lit(start).cast("timestamp_ntz"))
        if month_number is not None:
            keep = keep & (month_number >= start.year * 12 + start.month)
    if end is not None:
        keep = keep & (F.col("order_date") < F.lit(end + timedelta(days=1)).cast("timestamp_ntz"))
        if month_number is not None:
            keep = keep & (month_number <= end.year * 12 + end.month)
    wanted = {"customer_region": region, "product_category": category, "payment_method": payment}
    for column, value in wanted.items():
        if value is not None:
            keep = keep & (F.col(column) == value)
    return keep


def slice_sales(df: DataFrame, **bounds) -> DataFrame:
    """Rows of the slice; takes the keyword arguments of ``in_slice``."""
    return df.where(in_slice(df, **bounds))


def date_bounds(df: DataFrame) -> DataFrame:
    """First and last order date, one row."""
    return df.agg(
        F.min("order_date").alias("first_order_date"), F.max("order_date").alias("last_order_date")
    )


def dimension_values(df: DataFrame, dimension: str) -> DataFrame:
    """Sorted distinct non-null values of one column."""
    return df.select(dimension).where(F.col(dimension).isNotNull()).distinct().orderBy(dimension)
