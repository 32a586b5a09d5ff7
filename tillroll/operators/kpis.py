"""One-row business records and their long forms."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions import money_sum, ratio_or_zero, unpivot_record
from tillroll.operators.cleaning import MARK, row_accounting
from tillroll.operators.features import date_bounds, ensure_revenue_columns, in_slice
from tillroll.operators.totals import (
    dimension_part,
    leakage,
    overall_part,
    overall_totals,
    retained_share,
)
from tillroll.schema import CONTRACT_VERSION, METRICS_VERSION


def _ticket_per_order() -> Column:
    return ratio_or_zero(F.col("total_revenue"), F.col("total_orders"))


def summarize_kpis(df: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Revenue, distinct orders, units, revenue per order, mean rating and revenue retained.

    ``totals`` is the overall row when it has been computed already.
    """
    whole = totals
    if whole is None:
        whole = overall_totals(
            df,
            "row_count",
            "total_revenue",
            "gross_revenue",
            "total_units",
            "total_orders",
            "avg_rating",
        )
    rating = F.when(F.col("row_count") == 0, 0.0).otherwise(F.col("avg_rating"))
    return whole.select(
        "total_revenue",
        "total_orders",
        "total_units",
        _ticket_per_order().alias("avg_ticket"),
        rating.alias("avg_rating"),
        retained_share().alias("net_revenue_retained"),
    )


def kpi_summary(df: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """The KPIs as six ``(metric, value)`` rows; units are cut to whole numbers."""
    record = summarize_kpis(df, totals).withColumn(
        "total_units", F.col("total_units").cast("bigint")
    )
    fields = [
        ("total_revenue", "total_revenue"),
        ("total_orders", "total_orders"),
        ("total_units", "total_units"),
        ("avg_ticket", "avg_ticket"),
        ("avg_rating", "avg_rating"),
        ("north_star_nrr", "net_revenue_retained"),
    ]
    return unpivot_record(record, fields, "metric", "double")


def calculate_business_impact(
    df: DataFrame, recovery_rate: float = 0.05, totals: DataFrame | None = None
) -> DataFrame:
    """Net, gross, leakage, share retained, and the uplift if part of the leakage came back."""
    whole = totals
    if whole is None:
        whole = overall_totals(df, "total_revenue", "gross_revenue")
    return whole.select(
        "total_revenue",
        "gross_revenue",
        leakage().alias("discount_leakage"),
        retained_share().alias("retained_ratio"),
        (leakage() * F.lit(float(recovery_rate))).alias("expected_uplift"),
    )


def build_executive_summary(df: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """The business impact at 5 % recovery as five ``(metric, value)`` rows."""
    fields = [
        ("north_star_net_revenue_retained", "retained_ratio"),
        ("total_revenue", "total_revenue"),
        ("gross_revenue", "gross_revenue"),
        ("discount_leakage", "discount_leakage"),
        ("expected_uplift_5pct_recovery", "expected_uplift"),
    ]
    return unpivot_record(
        calculate_business_impact(df, totals=totals), fields, "metric", "double"
    )


def metrics_summary(df: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """The headline record: net, gross, leakage, revenue retained, orders, revenue per order."""
    whole = totals
    if whole is None:
        whole = overall_totals(df, "total_revenue", "gross_revenue", "total_orders")
    return whole.select(
        "total_revenue",
        "gross_revenue",
        leakage().alias("discount_leakage"),
        retained_share().alias("north_star_nrr"),
        "total_orders",
        _ticket_per_order().alias("avg_ticket"),
    )


def collect_product_metrics(
    raw: DataFrame | int,
    clean: DataFrame | int | None,
    featured: DataFrame,
    *,
    contract_version: str = CONTRACT_VERSION,
    pipeline_version: str = "unknown",
    generated_at: datetime | None = None,
    totals: DataFrame | None = None,
) -> DataFrame:
    """The product-metrics record, one row.

    A row count known already may stand in for a table. Where ``clean`` is None, ``raw`` is the
    result of ``retention``, which counts both tables in one pass. Stored ``sales_totals`` leave only
    the date bounds to be read from the featured rows.
    """
    generated_at = generated_at or datetime.now(UTC)
    if totals is None:
        # Categories are few, so counting them along with the sums ships little.
        record = ensure_revenue_columns(featured).agg(
            money_sum("total_revenue").alias("total_revenue"),
            money_sum("gross_revenue").alias("gross_revenue"),
            F.count_distinct("product_category").alias("unique_categories"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
        )
        record = record.crossJoin(overall_totals(featured, "total_orders"))
    else:
        categories = dimension_part(totals, "product_category")
        record = (
            overall_part(totals)
            .crossJoin(categories.agg(F.count(F.lit(1)).alias("unique_categories")))
            .crossJoin(date_bounds(featured))
        )
    counted = {"raw_rows": raw, "clean_rows": clean}
    if clean is None:
        counted = {}
        record = record.crossJoin(
            raw.select(
                F.col("raw_row_count").alias("raw_rows"), F.col("clean_row_count").alias("clean_rows")
            )
        )
    for name, rows in counted.items():
        if isinstance(rows, int):
            record = record.withColumn(name, F.lit(rows).cast("bigint"))
        else:
            record = record.crossJoin(rows.agg(F.count(F.lit(1)).alias(name)))
    return _metrics_record(record, contract_version, pipeline_version, generated_at)


def marked_product_metrics(
    marked: DataFrame,
    *,
    contract_version: str = CONTRACT_VERSION,
    pipeline_version: str = "unknown",
    generated_at: datetime | None = None,
) -> DataFrame:
    """The same record from one pass over the rows of ``marked_sales_data``.

    Parsing raw rows costs far more than the sum buffers, here empty ones, that travel with the
    distinct order ids. ``marked`` needs ``order_id`` and ``product_category``.
    """
    record = ensure_revenue_columns(marked).agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(MARK).alias("clean_rows"),
        money_sum("total_revenue").alias("total_revenue"),
        money_sum("gross_revenue").alias("gross_revenue"),
        F.count_distinct("product_category").alias("unique_categories"),
        F.count_distinct("order_id").alias("total_orders"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )
    return _metrics_record(record, contract_version, pipeline_version, generated_at or datetime.now(UTC))


def _metrics_record(
    record: DataFrame, contract_version: str, pipeline_version: str, generated_at: datetime
) -> DataFrame:
    accounting = row_accounting(F.col("raw_rows"), F.col("clean_rows"))
    return record.select(
        F.lit(METRICS_VERSION).alias("metrics_version"),
        F.lit(contract_version).alias("contract_version"),
        F.lit(pipeline_version).alias("pipeline_version"),
        F.lit(generated_at.isoformat()).alias("generated_at_utc"),
        *[column.alias(name) for name, column in accounting.items()],
        "total_revenue",
        "gross_revenue",
        leakage().alias("discount_leakage"),
        retained_share().alias("north_star_nrr"),
        F.col("total_orders").alias("unique_orders"),
        "unique_categories",
        _iso_day("first_order_date").alias("period_start"),
        _iso_day("last_order_date").alias("period_end"),
    )


def _iso_day(name: str) -> Column:
    return F.coalesce(F.date_format(name, "yyyy-MM-dd"), F.lit(""))


def slice_share(df: DataFrame, **bounds) -> DataFrame:
    """Revenue and orders of a slice as a percentage of the whole table.

    Sums and order counts go apart: the sums ship one row per task, the orders bare pairs of id
    and side, which are deduplicated before the shuffle.
    """
    inside = F.coalesce(in_slice(df, **bounds), F.lit(False))
    sums = df.agg(
        money_sum("total_revenue").alias("table_revenue"),
        money_sum(F.when(inside, F.col("total_revenue"))).alias("slice_revenue"),
    )
    orders = (
        df.where(F.col("order_id").isNotNull())
        .select("order_id", inside.alias("inside"))
        .distinct()
        .agg(
            F.count_distinct("order_id").alias("table_orders"),
            F.count_if("inside").alias("slice_orders"),
        )
    )
    return sums.crossJoin(orders).select(
        "slice_revenue",
        "slice_orders",
        (ratio_or_zero(F.col("slice_revenue"), F.col("table_revenue")) * 100).alias(
            "revenue_share_pct"
        ),
        (ratio_or_zero(F.col("slice_orders"), F.col("table_orders")) * 100).alias(
            "order_share_pct"
        ),
    )
