"""Everything a reader sees for one slice of the processed table."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.cube import (
    Cube,
    build_cube,
    cube_overall,
    cube_share,
    cube_totals,
    slice_cube,
)
from tillroll.operators.features import build_features, dimension_values, slice_sales
from tillroll.operators.kpis import kpi_summary, slice_share, summarize_kpis
from tillroll.operators.recommendations import build_actionable_recommendations
from tillroll.operators.recovery import recovery_display, simulate_leakage_recovery
from tillroll.operators.reports import (
    build_executive_tables,
    category_performance,
    monthly_trend,
    payment_performance,
    regional_performance,
    revenue_by,
    sales_trend_over_time,
    top_categories_by_sales,
)
from tillroll.operators.spikes import alerts_from_profile, discount_profile
from tillroll.operators.totals import overall_part, sales_totals
from tillroll.plans.pipeline import store
from tillroll.schema import DIMENSIONS


def slice_report(
    sales: DataFrame,
    out_path: str,
    *,
    start: date | None = None,
    end: date | None = None,
    region: str | None = None,
    category: str | None = None,
    payment: str | None = None,
    recovery_rates: Mapping[str, float] | DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The report tables of a slice.

    ``sales`` is the processed table as stored, so that the slice prunes its partitions. Totals per
    dimension, revenue per month and the discount profile of the slice are stored under
    ``out_path``, one scan each, and all tables but the share and the audit are lazy plans over them;
    the slice itself, which may be large, is not kept.
    """
    bounds = {
        "start": start,
        "end": end,
        "region": region,
        "category": category,
        "payment": payment,
    }
    rows = build_features(slice_sales(sales, **bounds))
    totals = store(sales_totals(rows), f"{out_path}/sales_totals")
    months = store(sales_trend_over_time(rows), f"{out_path}/monthly_revenue")
    profile = store(discount_profile(rows), f"{out_path}/discount_profile")
    overall = overall_part(totals)
    rates = {} if recovery_rates is None else recovery_rates
    breakdown = simulate_leakage_recovery(rows, rates, totals)
    return {
        "share_of_total": slice_share(sales, **bounds),
        "kpis": summarize_kpis(rows, overall),
        "revenue_by_region": revenue_by(rows, "customer_region", totals),
        "revenue_by_payment": revenue_by(rows, "payment_method", totals),
        "top_categories": top_categories_by_sales(rows, totals=totals),
        "recommendations": build_actionable_recommendations(rows, totals=totals),
        "discount_spikes": alerts_from_profile(profile),
        "recovery": recovery_display(breakdown),
        **build_executive_tables(rows, totals, months),
    }


def store_cube(sales: DataFrame, out_path: str) -> Cube:
    """Store the cube of the processed table under ``out_path``; ``read_cube`` reads it again.

    Cells and bitmaps are partitioned by year and month, as the sales are.
    """

    def keep(df: DataFrame, name: str) -> DataFrame:
        path = f"{out_path}/{name}"
        if "month" not in df.columns:
            return store(df, path)
        spread = df.hint("rebalance", F.col("year"), F.col("month"))
        spread.write.mode("overwrite").partitionBy("year", "month").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    return build_cube(sales, keep)


def cube_report(cube: Cube, **bounds) -> dict[str, DataFrame]:
    """The report tables of a slice that follow from the cube, without a look at the sales rows.

    Equal to those of ``slice_report``. Discount spikes, the audit and the profile need the rows and
    are not among them.
    """
    part = slice_cube(cube, **bounds)
    totals = cube_totals(part)
    overall = cube_overall(part)
    revenue = part.cells.select("order_date", F.col("total_revenue_sum").alias("total_revenue"))
    months = sales_trend_over_time(revenue)
    return {
        "share_of_total": cube_share(cube, **bounds),
        "kpis": summarize_kpis(part.cells, overall),
        "kpi_summary": kpi_summary(part.cells, overall),
        "category_performance": category_performance(part.cells, totals),
        "regional_performance": regional_performance(part.cells, totals),
        "payment_performance": payment_performance(part.cells, totals),
        "revenue_by_region": revenue_by(part.cells, "customer_region", totals),
        "revenue_by_payment": revenue_by(part.cells, "payment_method", totals),
        "top_categories": top_categories_by_sales(part.cells, totals=totals),
        "recommendations": build_actionable_recommendations(part.cells, totals=totals),
        "monthly_trend": monthly_trend(revenue, months),
    }


def filter_choices(sales: DataFrame) -> dict[str, DataFrame]:
    """The values a reader can pick per dimension."""
    return {name: dimension_values(sales, name) for name in DIMENSIONS}
