"""The alert run: processed table to alerts and a run summary."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import __version__
from tillroll.operators.spikes import (
    alert_summary,
    alerts_from_profile,
    as_export_rows,
    check_alert_parameters,
    detect_discount_spikes,
    discount_profile,
)
from tillroll.plans.pipeline import store
from tillroll.schema import ALERT_SCHEMA
from tillroll.sources.readers import read_or_compute, read_processed
from tillroll.sources.writers import export_discount_spike_alerts, save_record


def run_alerts(
    spark: SparkSession,
    in_path: str,
    out_path: str,
    *,
    z_threshold: float = 2.5,
    min_observations: int = 5,
    grain: str = "exact",
    in_format: str = "parquet",
    pipeline_version: str = __version__,
    generated_at: datetime | None = None,
) -> dict[str, str]:
    """Detect spikes, write the alerts, and sum them up from what was written."""
    check_alert_parameters(z_threshold, min_observations)
    generated_at = generated_at or datetime.now(UTC)
    sales = read_processed(spark, in_path, in_format)
    profile = store(discount_profile(sales, grain=grain), f"{out_path}/discount_profile")
    alerts = alerts_from_profile(
        profile, z_threshold=z_threshold, min_observations=min_observations
    )
    paths = {"alerts": f"{out_path}/alerts", "summary": f"{out_path}/alerts_summary"}
    export_discount_spike_alerts(alerts, paths["alerts"])
    stored = spark.read.schema(ALERT_SCHEMA).parquet(paths["alerts"])
    parameters = F.struct(
        F.lit(float(z_threshold)).alias("z_threshold"),
        F.lit(int(min_observations)).alias("min_observations"),
    )
    summary = alert_summary(stored).select(
        F.lit(pipeline_version).alias("pipeline_version"),
        F.lit(generated_at.isoformat()).alias("generated_at_utc"),
        "status",
        F.lit(in_path).alias("input_dataset"),
        F.lit(paths["alerts"]).alias("alerts_output"),
        parameters.alias("parameters"),
        "alerts_count",
        "severity_counts",
    )
    save_record(summary, paths["summary"])
    return paths


def discount_spike_rows(spark: SparkSession, alerts_path: str, sales: DataFrame) -> DataFrame:
    """Alerts for export: those stored under ``alerts_path``, or computed now from ``sales``."""
    alerts = read_or_compute(
        spark, alerts_path, ALERT_SCHEMA, lambda: detect_discount_spikes(sales)
    )
    return as_export_rows(alerts)
