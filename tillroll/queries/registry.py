"""Every operator as a query over the star-schema tables.

Money columns are carried as DECIMAL here, so that sums can be compared digit by digit with
another engine; means, deviations and scores are rounded to six places for the same reason.
The operators themselves do neither.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions import exact_money
from tillroll.operators import cube as cubes
from tillroll.operators import features as fe
from tillroll.operators import kpis, profiling, recommendations, recovery, reports, spikes
from tillroll.operators import totals as tt
from tillroll.operators import validation
from tillroll.functions.coerce import ID_COLUMNS
from tillroll.operators.cleaning import clean_sales_data, marked_sales_data, retention
from tillroll.operators.inspection import integral_ids
from tillroll.schema import DIMENSIONS, RAW_COLUMNS
from tillroll.sources.scratch import Scratch
from tillroll.sources.star import DEFECTS, raw_sales_view, sales_view

Query = Callable[[SparkSession, str], DataFrame]

SLICE = {
    "start": date(1996, 3, 1),
    "end": date(1998, 10, 31),
    "region": "ASIA",
}
GENERATED_AT = datetime(2024, 1, 1, tzinfo=UTC)
OVERRIDES = {"STANDARD": 0.2, "LARGE": 1.5, "SMALL": -0.1, "ABSENT": 0.7}
DEFAULT_RATE = 0.05
PROFILE_COLUMNS = [
    "order_id",
    "product_id",
    "price",
    "discount_percent",
    "quantity_sold",
    "rating",
    "review_count",
    "discounted_price",
    "total_revenue",
    "year",
    "month",
    "quarter",
    "gross_revenue",
    "discount_value",
    "net_revenue_retained",
    "revenue_per_unit",
    "discount_impact_pct",
]
BUNDLE_EXTRA = ["order_id", "order_date", "discount_percent", "rating", *DIMENSIONS]
HISTOGRAM_BINS = 20
#: From here on a DOUBLE does not hold every whole number.
LARGE_ID = 2**53
DENSITY_POINTS = 51

MEASURES = ["price", "quantity_sold", "total_revenue"]
BUNDLE_COLUMNS = [*BUNDLE_EXTRA, *MEASURES, "gross_revenue", "discount_value"]


def _sales(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The revenue measures and the given columns of the sales table, money as DECIMAL."""
    view = sales_view(spark, sf_dir, [*columns, *MEASURES])
    return exact_money(fe.ensure_revenue_columns(view))


def _processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of the cleaned raw table, whose ids are whole numbers by its making."""
    raw = raw_sales_view(spark, sf_dir)
    return fe.build_features(clean_sales_data(raw, integral=ID_COLUMNS))


def _profiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of the sales table, without a rating on the orders that lack one."""
    every = next(every for every, defect in DEFECTS["rating"] if defect == "N/A")
    view = sales_view(spark, sf_dir, RAW_COLUMNS)
    rated = F.when(F.col("order_id") % every != 0, F.col("rating"))
    return fe.build_features(view.withColumn("rating", rated))


def _rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({name: F.round(name, places) for name in columns})


def _wide(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("bigint") for name in columns})


def clean_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_sales_view(spark, sf_dir)
    return clean_sales_data(raw, integral=integral_ids(raw))


def large_order_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct orders of the cleaned table where ids are too large for a DOUBLE."""
    raw = raw_sales_view(spark, sf_dir)
    large = F.lit(LARGE_ID) + F.floor(F.col("order_id").cast("bigint") / 2)
    raw = raw.withColumn("order_id", large.cast("string"))
    clean = clean_sales_data(raw, integral=integral_ids(raw))
    return clean.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("order_id").alias("orders"),
        F.min("order_id").alias("lowest"),
        F.max("order_id").alias("highest"),
    )


def clean_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retention(raw_sales_view(spark, sf_dir))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = sales_view(spark, sf_dir).drop("product_brand")
    return _wide(fe.build_features(view), "year", "month", "quarter")


def schema_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.schema_violations(raw_sales_view(spark, sf_dir))


def schema_violations_minimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.schema_violations(raw_sales_view(spark, sf_dir), "minimal")


def violating_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.violating_rows(raw_sales_view(spark, sf_dir))


def quality_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.gate_counts(clean_sales_data(raw_sales_view(spark, sf_dir)))


def quality_gates_unclean(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_sales_view(spark, sf_dir)
    names = ["discount_percent", "rating", "quantity_sold", "price"]
    numbers = {name: F.col(name).try_cast("double") for name in names}
    return validation.gate_counts(raw.withColumns(numbers))


def dq_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.data_quality_audit(_processed(spark, sf_dir))


def kpi_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _sales(spark, sf_dir, "order_id", "rating")
    return _rounded(kpis.summarize_kpis(rows), "avg_rating")


def kpi_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _sales(spark, sf_dir, "order_id", "rating")
    return _rounded(kpis.kpi_summary(rows), "value")


def business_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.calculate_business_impact(_sales(spark, sf_dir), 0.1)


def executive_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.build_executive_summary(_sales(spark, sf_dir))


def product_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_sales_view(spark, sf_dir)
    marked = marked_sales_data(raw, "order_id", "product_category", integral=ID_COLUMNS)
    rows = exact_money(fe.ensure_revenue_columns(marked))
    return kpis.marked_product_metrics(rows, generated_at=GENERATED_AT)


def summary_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.metrics_summary(_sales(spark, sf_dir, "order_id"))


def category_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _sales(spark, sf_dir, "order_id", "product_category", "rating")
    return _rounded(reports.category_performance(rows), "avg_rating")


def regional_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _sales(spark, sf_dir, "order_id", "customer_region")
    return _rounded(reports.regional_performance(rows), "avg_ticket")


def payment_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _sales(spark, sf_dir, "order_id", "payment_method")
    return _rounded(reports.payment_performance(rows), "avg_ticket")


def executive_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shared totals behind the report bundle: three dimensions and the table at once."""
    rows = _sales(spark, sf_dir, "order_id", "rating", *DIMENSIONS)
    return _rounded(tt.sales_totals(rows), "avg_ticket", "avg_rating")


def revenue_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.revenue_by(_sales(spark, sf_dir, "customer_region"), "customer_region")


def revenue_by_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.revenue_by(_sales(spark, sf_dir, "payment_method"), "payment_method")


def leakage_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.leakage_by_category(_sales(spark, sf_dir, "product_category"))


def slice_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = sales_view(spark, sf_dir, ["order_id", "order_date", "total_revenue", *DIMENSIONS])
    return fe.slice_sales(view, **SLICE)


def slice_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _sales(spark, sf_dir, "order_id", "order_date", "rating", "customer_region")
    return _rounded(kpis.summarize_kpis(fe.slice_sales(rows, **SLICE)), "avg_rating")


def slice_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _sales(spark, sf_dir, "order_id", "order_date", "customer_region")
    return kpis.slice_share(rows, **SLICE)


def _cube(spark: SparkSession, sf_dir: str) -> cubes.Cube:
    rows = _sales(spark, sf_dir, "order_id", "order_date", "rating", *DIMENSIONS)
    return cubes.build_cube(rows, Scratch(spark, "cube").keep)


def slice_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KPIs and share of a slice, answered by the stored daily cube."""
    cube = _cube(spark, sf_dir)
    part = cubes.slice_cube(cube, **SLICE)
    record = kpis.summarize_kpis(part.cells, cubes.cube_overall(part))
    return _rounded(record, "avg_rating").crossJoin(cubes.cube_share(cube, **SLICE))


def slice_cube_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of the slice per dimension value and overall, answered by the stored daily cube."""
    part = cubes.slice_cube(_cube(spark, sf_dir), **SLICE)
    return _rounded(cubes.cube_totals(part), "avg_ticket", "avg_rating")


def dimension_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fe.dimension_values(sales_view(spark, sf_dir, ["payment_method"]), "payment_method")


def date_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fe.date_bounds(sales_view(spark, sf_dir, ["order_date"]))


def monthly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.sales_trend_over_time(_sales(spark, sf_dir, "order_date"))


def monthly_trend_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.monthly_trend(_sales(spark, sf_dir, "order_date"))


def _bundle(rows: DataFrame) -> DataFrame:
    """The six report tables as rows of table, key, metric and value."""
    keys = {
        "kpi_summary": "metric",
        "category_performance": "product_category",
        "regional_performance": "customer_region",
        "payment_performance": "payment_method",
        "monthly_trend": "month_end",
        "data_quality_audit": "check",
    }
    out = None
    for name, table in reports.build_executive_tables(rows, tt.sales_totals(rows)).items():
        measures = [c for c in table.columns if c != keys[name]]
        entries = [
            F.struct(F.lit(c).alias("metric"), F.round(F.col(c).cast("double"), 6).alias("value"))
            for c in measures
        ]
        part = table.select(
            F.lit(name).alias("table"),
            F.col(keys[name]).cast("string").alias("key"),
            F.inline(F.array(*entries)),
        )
        out = part if out is None else out.unionByName(part)
    return out


def executive_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bundle(_sales(spark, sf_dir, *BUNDLE_EXTRA))


def slice_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bundle(fe.slice_sales(_sales(spark, sf_dir, *BUNDLE_EXTRA), **SLICE))


def top_discount_opportunities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.rank_discount_opportunities(_sales(spark, sf_dir, "product_category"), 4)


def top_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _sales(spark, sf_dir, "product_brand")
    return reports.top_categories_by_sales(
        rows.withColumnRenamed("product_brand", "product_category")
    )


def payment_ticket_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _sales(spark, sf_dir, "payment_method")
    return _rounded(reports.payment_ticket_ranking(rows), "avg_ticket")


def _spike_rows(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    return exact_money(
        fe.ensure_revenue_columns(
            sales_view(spark, sf_dir, ["order_date", "discount_percent", key, *MEASURES])
        )
    )


def _shown_alerts(alerts: DataFrame) -> DataFrame:
    means = ["avg_discount_percent", "baseline_mean", "baseline_std", "z_score"]
    return _rounded(_rounded(alerts, *means), "estimated_leakage_usd", places=4)


def discount_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _spike_rows(spark, sf_dir, "product_category")
    return _rounded(spikes.discount_profile(rows), "avg_discount_percent")


def scored_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _spike_rows(spark, sf_dir, "customer_region")
    profile = spikes.discount_profile(rows, "customer_region", "month")
    return _shown_alerts(spikes.score_profile(profile, "customer_region"))


def scored_profile_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _spike_rows(spark, sf_dir, "payment_method")
    profile = spikes.discount_profile(rows, "payment_method", "day")
    return _shown_alerts(spikes.score_profile(profile, "payment_method"))


def discount_spikes_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _spike_rows(spark, sf_dir, "product_category")
    return _shown_alerts(spikes.detect_discount_spikes(rows))


def discount_spikes_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _spike_rows(spark, sf_dir, "customer_region")
    return _shown_alerts(spikes.detect_discount_spikes(rows, key="customer_region"))


def discount_spikes_brand_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _spike_rows(spark, sf_dir, "product_brand")
    return _shown_alerts(
        spikes.detect_discount_spikes(rows, key="product_brand", grain="month", by_rank=True)
    )


def alert_severity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _spike_rows(spark, sf_dir, "customer_region")
    alerts = spikes.detect_discount_spikes(rows, key="customer_region")
    return spikes.severity_counts(alerts)


def alert_run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _spike_rows(spark, sf_dir, "customer_region")
    summary = spikes.alert_summary(spikes.detect_discount_spikes(rows, key="customer_region"))
    per_severity = F.col("severity_counts")
    return summary.select(
        "status",
        "alerts_count",
        *[
            F.coalesce(F.try_element_at(per_severity, F.lit(name)), F.lit(0)).alias(name)
            for name in ("medium", "high", "critical")
        ],
    )


def alert_export_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _spike_rows(spark, sf_dir, "product_category")
    return _shown_alerts(spikes.as_export_rows(spikes.detect_discount_spikes(rows)))


def recommendations_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_money(_processed(spark, sf_dir))
    return recommendations.build_actionable_recommendations(rows)


def recommendations_no_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No discount, no category and no payment method: no rule has anything to say."""
    rows = _sales(spark, sf_dir, "order_id", *DIMENSIONS)
    nothing = F.lit(None).cast("string")
    calm = rows.withColumns(
        {
            "total_revenue": F.col("gross_revenue"),
            "discount_value": F.col("gross_revenue") - F.col("gross_revenue"),
            "product_category": nothing,
            "payment_method": nothing,
        }
    )
    return recommendations.build_actionable_recommendations(calm)


def recommendations_low_nrr(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_money(_processed(spark, sf_dir))
    return recommendations.build_actionable_recommendations(rows, nrr_floor=0.96)


def scenario_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sales_view(spark, sf_dir, ["product_category"])
    return recovery.recovery_rates(rows, DEFAULT_RATE, OVERRIDES)


def _breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recovery.simulate_leakage_recovery(_sales(spark, sf_dir, "product_category"), OVERRIDES)


def scenario_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_breakdown(spark, sf_dir), "expected_uplift", "simulated_revenue")


def scenario_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = recovery.recovery_display(_breakdown(spark, sf_dir))
    return _rounded(shown, "expected_uplift", "simulated_revenue")


def scenario_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rate for every category from default and overrides, then the breakdown at these rates."""
    rows = _sales(spark, sf_dir, "product_category")
    leaks = reports.leakage_by_category(rows)
    rates = recovery.recovery_rates(leaks, DEFAULT_RATE, OVERRIDES)
    breakdown = recovery.recovery_breakdown(leaks, rates)
    return _rounded(breakdown, "expected_uplift", "simulated_revenue")


def scenario_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = recovery.recovery_totals(_breakdown(spark, sf_dir))
    return _rounded(_rounded(record, *record.columns, places=4), "baseline_nrr", "simulated_nrr")


def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.column_profile(_profiled(spark, sf_dir))


def numeric_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = profiling.describe_numeric(_profiled(spark, sf_dir).select(PROFILE_COLUMNS))
    # Seven places: means over 60,000 rows of hundredths end in a 5 at the seventh.
    rounded = _rounded(summary, "std", "min", "p25", "p50", "p75", "max")
    return _rounded(rounded, "mean", places=7)


def timestamp_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.describe_timestamps(sales_view(spark, sf_dir, ["order_date"]))


def correlation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(profiling.correlation_matrix(_profiled(spark, sf_dir), PROFILE_COLUMNS), "r")


def price_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    bins = profiling.histogram(sales_view(spark, sf_dir, ["price"]), "price", HISTOGRAM_BINS)
    return _rounded(bins, "low", "high")


def price_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    curve = profiling.density(
        sales_view(spark, sf_dir, ["price"]), "price", HISTOGRAM_BINS, DENSITY_POINTS
    )
    return _rounded(_rounded(curve, "x"), "density", places=9)


def price_histogram_auto(spark: SparkSession, sf_dir: str) -> DataFrame:
    bins = profiling.histogram(sales_view(spark, sf_dir, ["price"]), "price")
    return _rounded(bins, "low", "high")


def price_density_auto(spark: SparkSession, sf_dir: str) -> DataFrame:
    curve = profiling.density(sales_view(spark, sf_dir, ["price"]), "price", points=DENSITY_POINTS)
    return _rounded(_rounded(curve, "x"), "density", places=9)


def all_queries() -> dict[str, Query]:
    return {
        "clean_sales": clean_sales,
        "large_order_ids": large_order_ids,
        "clean_retention": clean_retention,
        "features": features,
        "schema_violations": schema_violations,
        "schema_violations_minimal": schema_violations_minimal,
        "violating_rows": violating_rows,
        "quality_gates": quality_gates,
        "quality_gates_unclean": quality_gates_unclean,
        "dq_audit": dq_audit,
        "kpi_record": kpi_record,
        "kpi_summary": kpi_summary,
        "business_impact": business_impact,
        "executive_summary": executive_summary,
        "product_metrics": product_metrics,
        "summary_metrics": summary_metrics,
        "category_performance": category_performance,
        "regional_performance": regional_performance,
        "payment_performance": payment_performance,
        "executive_tables": executive_tables,
        "revenue_by_region": revenue_by_region,
        "revenue_by_payment": revenue_by_payment,
        "leakage_by_category": leakage_by_category,
        "slice_rows": slice_rows,
        "slice_kpis": slice_kpis,
        "slice_share": slice_share,
        "slice_cube": slice_cube,
        "slice_cube_totals": slice_cube_totals,
        "dimension_values": dimension_values,
        "date_bounds": date_bounds,
        "monthly_trend": monthly_trend,
        "monthly_trend_filled": monthly_trend_filled,
        "top_discount_opportunities": top_discount_opportunities,
        "top_categories": top_categories,
        "payment_ticket_ranking": payment_ticket_ranking,
        "discount_profile": discount_profile,
        "scored_profile": scored_profile,
        "scored_profile_day": scored_profile_day,
        "discount_spikes_daily": discount_spikes_daily,
        "discount_spikes_region": discount_spikes_region,
        "discount_spikes_brand_month": discount_spikes_brand_month,
        "alert_severity_counts": alert_severity_counts,
        "alert_run_status": alert_run_status,
        "alert_export_rows": alert_export_rows,
        "recommendations": recommendations_default,
        "recommendations_low_nrr": recommendations_low_nrr,
        "recommendations_no_risk": recommendations_no_risk,
        "executive_bundle": executive_bundle,
        "slice_bundle": slice_bundle,
        "scenario_run": scenario_run,
        "scenario_rates": scenario_rates,
        "scenario_breakdown": scenario_breakdown,
        "scenario_display": scenario_display,
        "scenario_totals": scenario_totals,
        "column_profile": column_profile,
        "numeric_describe": numeric_describe,
        "timestamp_describe": timestamp_describe,
        "correlation_matrix": correlation_matrix,
        "price_histogram": price_histogram,
        "price_density": price_density,
        "price_histogram_auto": price_histogram_auto,
        "price_density_auto": price_density_auto,
    }
