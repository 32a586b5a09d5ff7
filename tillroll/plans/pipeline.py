"""The full batch run: raw table to clean table, reports, metrics and alerts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession

from tillroll import __version__
from tillroll.functions.coerce import ID_COLUMNS, ISO_DATE
from tillroll.operators.cleaning import clean_sales_data
from tillroll.operators.contracts import enforce_raw_contract
from tillroll.operators.features import build_features
from tillroll.operators.inspection import (
    Inspection,
    candidate_formats,
    decoded,
    inspect_raw,
    inspected_columns,
    inspection_counts,
    probable,
)
from tillroll.operators.kpis import build_executive_summary, collect_product_metrics
from tillroll.operators.profiling import basic_eda
from tillroll.operators.recommendations import build_actionable_recommendations
from tillroll.operators.reports import (
    build_executive_tables,
    rank_discount_opportunities,
    sales_trend_over_time,
    top_categories_by_sales,
)
from tillroll.operators.spikes import alerts_from_profile, discount_profile
from tillroll.operators.totals import overall_part, sales_totals
from tillroll.operators.validation import gate_rules, raise_on_gate, violating_rows
from tillroll.schema import CONTRACT_VERSION
from tillroll.sources.readers import load_raw_sales_data, read_clean_table
from tillroll.sources.runs import discard, new_run, publish
from tillroll.sources.writers import (
    export_contract_snapshot,
    export_discount_spike_alerts,
    save_processed_data,
    save_product_metrics,
    save_reports,
    save_table,
)

VIOLATION_MODES = ("fail", "report")


def store(df: DataFrame, path: str) -> DataFrame:
    """Write an intermediate table beside the output and go on from the stored copy."""
    save_table(df, path)
    return df.sparkSession.read.parquet(path)


def write_inspected(raw: DataFrame, path: str, date_format: str = ISO_DATE) -> Inspection:
    """Write the clean table and inspect the raw one, in a single scan of it.

    The counts are observed while the rows pass on their way to the clean table. Date format and id
    types are guessed before, from the first date and as whole numbers; where the observed column says
    otherwise, the clean table is written once more. A lost executor may let rows be counted twice;
    the rows written tell, and then the raw table is inspected by a scan of its own.
    """
    formats = candidate_formats(raw, date_format)
    guess = (probable(raw, formats), tuple(ID_COLUMNS))
    seen = Observation()
    counts = inspection_counts(raw, formats, gate_rules)
    watched = inspected_columns(raw, formats)
    added = [name for name in watched.columns if name not in raw.columns]
    clean = clean_sales_data(watched.observe(seen, *counts), *guess).drop(*added)
    written = _write_counted(clean, path)
    # A plan that turns out empty is replaced as a whole, counts included.
    found = decoded(seen.get, formats) if written else inspect_raw(raw, date_format, gate_rules)
    if (found.date_format, found.integral) != guess:
        written = _write_counted(clean_sales_data(raw, found.date_format, found.integral), path)
    if found.clean_rows != written:
        found = inspect_raw(raw, date_format, gate_rules)
    return found


def _write_counted(clean: DataFrame, path: str) -> int:
    """Store the clean table; the rows in it, by the footers of its files."""
    save_processed_data(clean, path)
    return clean.sparkSession.read.schema(clean.schema).parquet(path).count()


def run_pipeline(
    spark: SparkSession,
    in_path: str,
    out_path: str,
    *,
    on_violation: str = "fail",
    multi_line: bool = False,
    date_format: str = ISO_DATE,
    with_profile: bool = True,
    pipeline_version: str = __version__,
    generated_at: datetime | None = None,
) -> dict[str, str]:
    """Read, check, clean and store the sales table, then write every report from it.

    With ``on_violation="fail"`` the raw table is inspected first and nothing is written where it
    breaks a rule or a gate. With ``"report"`` it is read once, on its way into the clean table, and
    once more only to list broken rows. The reports read the stored clean table; those that need
    per-dimension totals share one stored result.

    All outputs go into a folder of the run and are published together when the last one is
    written: a run that fails or is stopped leaves what readers see as it was. Give ``out_path`` to
    the readers and to the other jobs to follow the newest whole run, or the returned paths to keep
    to this one. ``date_format="auto"`` takes the format that the dates follow. ``multi_line`` is for
    files with line breaks inside quotes.
    """
    if on_violation not in VIOLATION_MODES:
        raise ValueError(f"on_violation must be one of {', '.join(VIOLATION_MODES)}")
    run = new_run(out_path)
    paths = {name: run.path(name) for name in ("contract", "processed", "tables", "metrics", "alerts")}
    raw = load_raw_sales_data(spark, in_path, multi_line)
    enforce_raw_contract(raw)
    if on_violation == "fail":
        found = inspect_raw(raw, date_format, gate_rules)
        if found.broken:
            listing = ", ".join(f"{name}: {count}" for name, count in found.broken.items())
            raise ValueError(f"Raw data failed the schema check ({listing})")
        raise_on_gate(found.gates)
        clean = clean_sales_data(raw, found.date_format, found.integral)
        save_processed_data(clean, paths["processed"])
    else:
        try:
            found = write_inspected(raw, paths["processed"], date_format)
            raise_on_gate(found.gates)
        except ValueError:
            discard(spark, run)
            raise
        if found.broken:
            placed = load_raw_sales_data(spark, in_path, multi_line, with_place=True)
            paths["violations"] = save_table(violating_rows(placed), run.path("violations"))
    export_contract_snapshot(spark, paths["contract"], CONTRACT_VERSION)

    featured = build_features(read_clean_table(spark, paths["processed"]))
    totals = store(sales_totals(featured), run.path("shared/sales_totals"))
    overall = overall_part(totals)
    months = store(sales_trend_over_time(featured), run.path("shared/monthly_revenue"))
    reports = {
        "executive_summary": build_executive_summary(featured, overall),
        "discount_opportunities": rank_discount_opportunities(featured, totals=totals),
        "actionable_recommendations": build_actionable_recommendations(featured, totals=totals),
        "sales_trend_over_time": months.orderBy("year_month"),
        "top_categories_by_sales": top_categories_by_sales(featured, totals=totals),
        **build_executive_tables(featured, totals, months),
    }
    if with_profile:
        reports |= basic_eda(featured)
    save_reports(reports, paths["tables"])
    metrics = collect_product_metrics(
        found.raw_rows,
        found.clean_rows,
        featured,
        pipeline_version=pipeline_version,
        generated_at=generated_at,
        totals=totals,
    )
    save_product_metrics(metrics, paths["metrics"])
    profile = store(discount_profile(featured), run.path("shared/discount_profile"))
    export_discount_spike_alerts(alerts_from_profile(profile), paths["alerts"])
    publish(spark, run, paths)
    return paths
