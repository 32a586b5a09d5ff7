"""Per-dimension report tables, monthly trends, rankings and the quality audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions import money_sum, ratio_or_zero, unpivot_record
from tillroll.operators.kpis import kpi_summary
from tillroll.operators.totals import dimension_part, dimension_totals, overall_part


def _largest_first(metric: str, key: str) -> list[Column]:
    """Descending by metric with nulls last; equal metrics are ordered by key."""
    return [F.desc_nulls_last(metric), F.asc(key)]


def _part(df: DataFrame, totals: DataFrame | None, dimension: str, *measures: str) -> DataFrame:
    """The measures per dimension value, from the rows or from stored ``sales_totals``."""
    if totals is None:
        return dimension_totals(df, dimension, *measures)
    return dimension_part(totals, dimension).select(dimension, *measures)


def category_performance(df: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Revenue, units, distinct orders, mean rating and discount per category."""
    part = _part(
        df,
        totals,
        "product_category",
        "total_revenue",
        "total_units",
        "total_orders",
        "avg_rating",
        "discount_value",
    )
    return part.orderBy(*_largest_first("total_revenue", "product_category"))


def _ticket_report(df: DataFrame, totals: DataFrame | None, dimension: str) -> DataFrame:
    part = _part(df, totals, dimension, "total_revenue", "total_orders", "avg_ticket")
    return part.orderBy(*_largest_first("total_revenue", dimension))


def regional_performance(df: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Revenue, distinct orders and mean revenue per row of each region."""
    return _ticket_report(df, totals, "customer_region")


def payment_performance(df: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Revenue, distinct orders and mean revenue per row of each payment method."""
    return _ticket_report(df, totals, "payment_method")


def revenue_by(df: DataFrame, dimension: str, totals: DataFrame | None = None) -> DataFrame:
    """Revenue per value of a dimension."""
    return _part(df, totals, dimension, "total_revenue").orderBy(dimension)


def leakage_by_category(df: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Gross, net and discount value per category, largest discount first."""
    part = _part(
        df, totals, "product_category", "gross_revenue", "total_revenue", "discount_value"
    )
    return part.orderBy(*_largest_first("discount_value", "product_category"))


def payment_ticket_ranking(df: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Payment methods by mean revenue per row, weakest first."""
    part = _part(df, totals, "payment_method", "avg_ticket", "total_revenue")
    return part.orderBy(F.asc_nulls_last("avg_ticket"), "payment_method")


def rank_discount_opportunities(
    df: DataFrame, top_n: int = 10, totals: DataFrame | None = None
) -> DataFrame:
    """The ``top_n`` categories by discount value, with discount over revenue."""
    ranked = leakage_by_category(df, totals).limit(top_n)
    ratio = ratio_or_zero(F.col("discount_value"), F.col("total_revenue"))
    return ranked.select(
        "product_category",
        "total_revenue",
        "discount_value",
        ratio.alias("discount_to_revenue_ratio"),
    )


def top_categories_by_sales(
    df: DataFrame, top_n: int = 10, totals: DataFrame | None = None
) -> DataFrame:
    """The ``top_n`` categories by revenue."""
    part = _part(df, totals, "product_category", "total_revenue")
    return part.orderBy(*_largest_first("total_revenue", "product_category")).limit(top_n)


def sales_trend_over_time(df: DataFrame) -> DataFrame:
    """Revenue per month at the first of the month; months without sales do not appear."""
    monthly = df.where(F.col("order_date").isNotNull()).groupBy(
        F.trunc(F.to_date("order_date"), "MM").alias("year_month")
    )
    return monthly.agg(money_sum("total_revenue").alias("total_revenue")).orderBy("year_month")


def monthly_trend(df: DataFrame, months: DataFrame | None = None) -> DataFrame:
    """Revenue per month at the last day, with 0 for months without sales in between.

    ``months`` is the result of ``sales_trend_over_time`` where it is stored. Each month is stretched up to the one before its successor. The window has no partition
    key, but runs over months, of which the calendar holds fewer than 120,000.
    """
    months = sales_trend_over_time(df) if months is None else months
    following = F.lead("year_month").over(Window.orderBy("year_month"))
    last = F.coalesce(F.add_months(following, -1), F.col("year_month"))
    stretched = months.withColumn("last_month", last).select(
        "year_month",
        "total_revenue",
        F.explode(F.expr("sequence(year_month, last_month, interval 1 month)")).alias("month"),
    )
    revenue = F.when(F.col("month") == F.col("year_month"), F.col("total_revenue")).otherwise(0.0)
    return stretched.select(
        F.last_day("month").alias("month_end"), revenue.alias("total_revenue")
    ).orderBy("month_end")


def _is_missing(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    missing = column.isNull()
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        missing = missing | F.isnan(column)
    return missing.cast("bigint")


def data_quality_audit(df: DataFrame) -> DataFrame:
    """Row count, nulls (and NaN) over all columns, repeated order ids and values out of range.

    The sums are one buffer per task. Distinct order ids are counted apart, so that bare ids are
    shuffled and no sums with them; a null id is one value like any other.
    """
    missing = sum((_is_missing(field) for field in df.schema), F.lit(0))
    sums = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.sum(missing), F.lit(0)).alias("null_values"),
        F.count_if(~F.col("discount_percent").between(0, 100)).alias("discount_out_of_range"),
        F.count_if(~F.col("rating").between(0, 5)).alias("rating_out_of_range"),
    )
    ids = df.select("order_id").distinct().agg(F.count(F.lit(1)).alias("ids"))
    duplicated = F.col("row_count") - F.col("ids")
    record = sums.crossJoin(ids).withColumn("duplicated_order_id", duplicated)
    checks = [
        "row_count",
        "null_values",
        "duplicated_order_id",
        "discount_out_of_range",
        "rating_out_of_range",
    ]
    return unpivot_record(record, [(name, name) for name in checks], "check", "bigint")


def build_executive_tables(
    df: DataFrame, totals: DataFrame | None = None, months: DataFrame | None = None
) -> dict[str, DataFrame]:
    """The six report tables as lazy plans.

    Pass stored ``sales_totals`` when several of them will run: four of the six are then cut
    from that small table instead of scanning the sales rows. Stored ``months`` do the same
    for the monthly trend.
    """
    overall = None if totals is None else overall_part(totals)
    return {
        "kpi_summary": kpi_summary(df, overall),
        "category_performance": category_performance(df, totals),
        "regional_performance": regional_performance(df, totals),
        "payment_performance": payment_performance(df, totals),
        "monthly_trend": monthly_trend(df, months),
        "data_quality_audit": data_quality_audit(df),
    }
