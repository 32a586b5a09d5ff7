"""What a category would earn if a share of its discount leakage were recovered."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions import clip, money_sum, ratio_or_zero
from tillroll.operators.features import dimension_values
from tillroll.operators.reports import leakage_by_category

RATES_FIELDS = "product_category: string, recovery_rate: double"


def check_default_rate(rate: float) -> None:
    if not 0 <= rate <= 1:
        raise ValueError("The default recovery rate must lie between 0 and 1.")


def rates_table(spark: SparkSession, rates: Mapping[str, float]) -> DataFrame:
    """The rates as a literal table; a rates table of any size can be passed instead."""
    entries = [
        F.struct(F.lit(name).alias("product_category"), F.lit(float(rate)).alias("recovery_rate"))
        for name, rate in rates.items()
    ]
    listed = F.array(*entries).cast(f"array<struct<{RATES_FIELDS}>>")
    return spark.range(0, 1, 1, 1).select(F.inline(listed))


def unique_rates(rates: DataFrame) -> DataFrame:
    """The rates, one row per category; a repeated category or a rate of NaN is an error.

    The check is part of the plan, so that a table of any size is checked where it is used.
    """
    grouped = rates.groupBy("product_category").agg(
        F.min("recovery_rate").alias("rate"), F.count(F.lit(1)).alias("times")
    )
    named = F.coalesce("product_category", F.lit("null"))
    repeated = F.raise_error(F.concat(F.lit("Several recovery rates for category "), named))
    undefined = F.raise_error(F.concat(F.lit("The recovery rate is NaN for category "), named))
    checked = (
        F.when(F.col("times") > 1, repeated.cast("double"))
        .when(F.isnan("rate"), undefined.cast("double"))
        .otherwise(F.col("rate"))
    )
    return grouped.select("product_category", checked.alias("recovery_rate"))


def recovery_rates(
    df: DataFrame, default_rate: float, overrides: Mapping[str, float] | DataFrame | None = None
) -> DataFrame:
    """A rate for every category present: the override where there is one, else the default."""
    check_default_rate(default_rate)
    categories = dimension_values(df, "product_category")
    if overrides is None:
        return categories.withColumn("recovery_rate", F.lit(float(default_rate)))
    if not isinstance(overrides, DataFrame):
        overrides = rates_table(df.sparkSession, overrides)
    rate = F.coalesce("recovery_rate", F.lit(float(default_rate)))
    return categories.join(unique_rates(overrides), "product_category", "left").select(
        "product_category", rate.alias("recovery_rate")
    )


def simulate_leakage_recovery(
    df: DataFrame,
    rates: Mapping[str, float] | DataFrame,
    totals: DataFrame | None = None,
) -> DataFrame:
    """Per category: leakage, rate (0 when missing, limited to [0, 1]), uplift, new revenue."""
    return recovery_breakdown(leakage_by_category(df, totals), rates)


def recovery_breakdown(leaks: DataFrame, rates: Mapping[str, float] | DataFrame) -> DataFrame:
    """The same, from a ``leakage_by_category`` table that has been computed already."""
    if not isinstance(rates, DataFrame):
        rates = rates_table(leaks.sparkSession, rates)
    categories = leaks.withColumnRenamed("discount_value", "discount_leakage")
    rate = clip(F.coalesce("recovery_rate", F.lit(0.0)), 0.0, 1.0)
    uplift = F.col("discount_leakage") * F.col("recovery_rate")
    return (
        categories.join(unique_rates(rates), "product_category", "left")
        .withColumn("recovery_rate", rate)
        .withColumn("expected_uplift", uplift)
        .withColumn("simulated_revenue", F.col("total_revenue") + F.col("expected_uplift"))
        .orderBy(F.desc_nulls_last("discount_leakage"), "product_category")
    )


def recovery_totals(breakdown: DataFrame) -> DataFrame:
    """Baseline and simulated revenue and revenue retained, summed over the breakdown."""
    sums = breakdown.agg(
        money_sum("total_revenue").alias("baseline_revenue"),
        money_sum("gross_revenue").alias("gross_revenue"),
        money_sum("expected_uplift").alias("total_uplift"),
    ).withColumn("simulated_revenue", F.col("baseline_revenue") + F.col("total_uplift"))
    gross = F.col("gross_revenue")
    return sums.select(
        "baseline_revenue",
        "gross_revenue",
        ratio_or_zero(F.col("baseline_revenue"), gross).alias("baseline_nrr"),
        "simulated_revenue",
        ratio_or_zero(F.col("simulated_revenue"), gross).alias("simulated_nrr"),
        "total_uplift",
    )


def recovery_display(breakdown: DataFrame) -> DataFrame:
    """The columns shown to a reader, with the rate in percent."""
    return breakdown.select(
        "product_category",
        "discount_leakage",
        (F.col("recovery_rate") * 100).alias("recovery_rate"),
        "expected_uplift",
        "simulated_revenue",
    )
