"""The recovery run: what recovering part of the leakage would earn per category."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import __version__
from tillroll.operators.recovery import (
    check_default_rate,
    recovery_breakdown,
    recovery_rates,
    recovery_totals,
)
from tillroll.operators.reports import leakage_by_category
from tillroll.plans.pipeline import store
from tillroll.sources.readers import read_processed
from tillroll.sources.writers import save_record


def run_scenario(
    spark: SparkSession,
    in_path: str,
    out_path: str,
    *,
    recovery_rate: float = 0.05,
    overrides: Mapping[str, float] | DataFrame | None = None,
    in_format: str = "parquet",
    pipeline_version: str = __version__,
    generated_at: datetime | None = None,
) -> dict[str, str]:
    """Write the breakdown per category, and its totals as a one-record summary."""
    generated_at = generated_at or datetime.now(UTC)
    sales = read_processed(spark, in_path, in_format)
    check_default_rate(recovery_rate)
    paths = {
        "breakdown": f"{out_path}/scenario_breakdown",
        "summary": f"{out_path}/scenario_summary",
    }
    # The sales rows are read once; rates and breakdown start from the stored categories.
    leaks = store(leakage_by_category(sales), f"{out_path}/shared/leakage_by_category")
    rates = recovery_rates(leaks, recovery_rate, overrides)
    breakdown = store(recovery_breakdown(leaks, rates), paths["breakdown"])
    named = overrides if isinstance(overrides, Mapping) else {}
    listed = F.map_from_arrays(
        F.array(*[F.lit(name) for name in named]).cast("array<string>"),
        F.array(*[F.lit(float(rate)) for rate in named.values()]).cast("array<double>"),
    )
    summary = recovery_totals(breakdown).select(
        F.lit(pipeline_version).alias("pipeline_version"),
        F.lit(generated_at.isoformat()).alias("generated_at_utc"),
        F.lit(in_path).alias("input_dataset"),
        F.lit(paths["breakdown"]).alias("output_breakdown"),
        F.lit(float(recovery_rate)).alias("recovery_rate_default"),
        listed.alias("category_overrides"),
        "baseline_revenue",
        "gross_revenue",
        "baseline_nrr",
        "simulated_revenue",
        "simulated_nrr",
        "total_uplift",
    )
    save_record(summary, paths["summary"])
    return paths
