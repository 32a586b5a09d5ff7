"""Z-score alerts on discount spikes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions import clip, deviation_or_zero, money_sum, ratio_or_zero, to_moment
from tillroll.operators.features import ensure_revenue_columns
from tillroll.schema import ALERT_SCHEMA

# Upper z limits of the first two severities.
MEDIUM_LIMIT = 3.5
HIGH_LIMIT = 5.0

GRAINS = ("exact", "day", "month")


def check_alert_parameters(z_threshold: float, min_observations: int) -> None:
    """Limits the alert job puts on its arguments."""
    if z_threshold <= 0:
        raise ValueError("z_threshold must be greater than 0.")
    if min_observations < 2:
        raise ValueError("min_observations must be at least 2.")


def discount_profile(
    df: DataFrame, key: str = "product_category", grain: str = "exact"
) -> DataFrame:
    """Mean discount and gross revenue per key and moment.

    The ``exact`` grain groups by the timestamp as it is; ``day`` and ``month`` truncate it.
    """
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {', '.join(GRAINS)}")
    moment = to_moment(df, "order_date")
    if grain == "day":
        moment = F.to_date(moment).cast("timestamp_ntz")
    elif grain == "month":
        moment = F.trunc(F.to_date(moment), "MM").cast("timestamp_ntz")
    rows = ensure_revenue_columns(df.withColumn("order_date", moment)).where(
        F.col("order_date").isNotNull() & F.col(key).isNotNull()
    )
    return rows.groupBy(key, "order_date").agg(
        F.avg("discount_percent").alias("avg_discount_percent"),
        money_sum("gross_revenue").alias("gross_revenue"),
    )


def score_profile(profile: DataFrame, key: str = "product_category") -> DataFrame:
    """Attach each key's baseline, the z-score and the estimated leakage to every moment.

    The baseline is aggregated and joined back. A window over the key would hold all moments
    of one key in one task, and with exact timestamps their number has no limit. Both sides
    read the revenue sum, whatever columns are asked for later: then both need the same aggregate,
    and Spark runs that shuffle once. The filter of the baseline drops nothing that counts (a
    moment without a mean discount adds nothing to the statistics); the other one is always true.
    """
    moments = profile.where(F.col("gross_revenue") >= F.lit(float("-inf")))
    measured = F.col("avg_discount_percent").isNotNull() | (F.col("gross_revenue") != 0)
    baseline = (
        profile.where(measured)
        .groupBy(key)
        .agg(
            F.avg("avg_discount_percent").alias("baseline_mean"),
            deviation_or_zero("avg_discount_percent").alias("baseline_std"),
            F.count("avg_discount_percent").alias("obs_count"),
        )
    )
    gap = F.col("avg_discount_percent") - F.col("baseline_mean")
    return (
        moments.join(baseline, key, "left")
        .withColumn("obs_count", F.coalesce("obs_count", F.lit(0)))
        .withColumn("z_score", ratio_or_zero(gap, F.col("baseline_std")))
        .withColumn("estimated_leakage_usd", F.col("gross_revenue") * (clip(gap, low=0.0) / 100.0))
    )


def severity(z_score: Column) -> Column:
    """Right-closed bins: up to 3.5 medium, up to 5 high, above critical."""
    return (
        F.when(z_score <= MEDIUM_LIMIT, "medium")
        .when(z_score <= HIGH_LIMIT, "high")
        .otherwise("critical")
    )


def detect_discount_spikes(
    df: DataFrame,
    *,
    z_threshold: float = 2.5,
    min_observations: int = 5,
    key: str = "product_category",
    grain: str = "exact",
    by_rank: bool = False,
) -> DataFrame:
    """Moments whose mean discount lies ``z_threshold`` deviations above the key's baseline.

    Alerts come by severity as descending text (medium, high, critical) and then by leakage;
    ``by_rank`` puts the most severe first instead.
    """
    profile = discount_profile(df, key, grain)
    return alerts_from_profile(
        profile,
        z_threshold=z_threshold,
        min_observations=min_observations,
        key=key,
        by_rank=by_rank,
    )


def alerts_from_profile(
    profile: DataFrame,
    *,
    z_threshold: float = 2.5,
    min_observations: int = 5,
    key: str = "product_category",
    by_rank: bool = False,
) -> DataFrame:
    """The alert step of ``detect_discount_spikes`` on a discount profile stored earlier."""
    if z_threshold >= MEDIUM_LIMIT:
        raise ValueError(f"z_threshold must be below {MEDIUM_LIMIT}, the limit of 'medium'.")
    alerts = (
        score_profile(profile, key)
        .where((F.col("obs_count") >= min_observations) & (F.col("z_score") >= z_threshold))
        .withColumn("severity", severity(F.col("z_score")))
    )
    rank = F.array_position(F.array(*map(F.lit, ("critical", "high", "medium"))), F.col("severity"))
    first = F.asc(rank) if by_rank else F.desc("severity")
    names = [key if name == "product_category" else name for name in ALERT_SCHEMA.names]
    return alerts.select(*names).orderBy(first, F.desc_nulls_last("estimated_leakage_usd"), key, "order_date")


def severity_counts(alerts: DataFrame) -> DataFrame:
    """Number of alerts per severity."""
    return alerts.groupBy("severity").agg(F.count(F.lit(1)).alias("alerts")).orderBy("severity")


def alert_summary(alerts: DataFrame) -> DataFrame:
    """One row: number of alerts, a map of counts per severity, and ``ok`` or ``attention``."""
    per_severity = alerts.groupBy("severity").agg(F.count(F.lit(1)).alias("alerts"))
    # At most three severities exist, so the list stays at three entries.
    entries = F.sort_array(F.collect_list(F.struct("severity", "alerts")))
    return per_severity.agg(
        F.coalesce(F.sum("alerts"), F.lit(0)).alias("alerts_count"),
        F.map_from_entries(entries).alias("severity_counts"),
    ).withColumn("status", F.when(F.col("alerts_count") == 0, "ok").otherwise("attention"))


def as_export_rows(df: DataFrame) -> DataFrame:
    """The same rows with the order date as ISO text."""
    return df.withColumn("order_date", F.date_format("order_date", "yyyy-MM-dd"))
