import json
from datetime import UTC, date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from samples import DECISION, DIRTY, TABLES, discount_days, featured, raw, record, typed, values
from tillroll.operators import reports, spikes, validation
from tillroll.plans import pipeline
from tillroll.plans.alert_run import discount_spike_rows, run_alerts
from tillroll.plans.pipeline import run_pipeline
from tillroll.plans.recovery_run import run_scenario
from tillroll.plans.slice_report import filter_choices, slice_report
from tillroll.schema import ALERT_SCHEMA, CLEAN_SCHEMA, RAW_COLUMNS
from tillroll.sources import readers, runs, writers

MOMENT = datetime(2024, 5, 1, tzinfo=UTC)


def write_csv(path: Path, lines, columns=RAW_COLUMNS) -> str:
    path.write_text("\n".join([",".join(columns), *lines]) + "\n", encoding="utf-8")
    return str(path)


def json_record(path: str) -> dict:
    (part,) = Path(path).glob("part-*")
    (line,) = part.read_text(encoding="utf-8").splitlines()
    return json.loads(line)


def test_csv_is_read_as_text_by_header_name(spark, tmp_path):
    columns = ["extra", *reversed(RAW_COLUMNS)]
    line = 'x,180,90,50,N/A,"Card, ""gold""",NA,2,10,100.0,Home,10,2024-01-15,1'
    table = readers.load_raw_sales_data(spark, write_csv(tmp_path / "in.csv", [line], columns))
    row = record(table)
    assert row["order_id"] == "1"
    assert row["rating"] is None and row["customer_region"] is None
    assert row["payment_method"] == 'Card, "gold"'
    assert set(kind for _, kind in table.dtypes) == {"string"}


def test_a_directory_of_csv_files_is_one_table(spark, tmp_path):
    for number, line in enumerate(TABLES):
        write_csv(tmp_path / f"{number}.csv", [line])
    assert readers.load_raw_sales_data(spark, str(tmp_path)).count() == 3


def test_missing_files_are_reported(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.load_raw_sales_data(spark, str(tmp_path / "absent.csv"))
    with pytest.raises(FileNotFoundError):
        readers.read_processed(spark, str(tmp_path / "absent"))
    with pytest.raises(ValueError, match="format"):
        readers.read_processed(spark, str(tmp_path), "orc")


def test_clean_table_round_trip(spark, tmp_path):
    clean = typed(spark, TABLES)
    path = writers.save_processed_data(clean, str(tmp_path / "clean"))
    stored = readers.read_clean_table(spark, path)
    assert sorted(p.name for p in (tmp_path / "clean" / "year=2024").iterdir()) == ["month=1", "month=2"]
    assert sorted(values(stored.drop("year", "month"))) == sorted(values(clean))
    plan = stored.where("year = 2024 and month = 1")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_clean_csv_round_trip(spark, tmp_path):
    clean = typed(spark, [*TABLES, "4,2024-03-01,1,,1,1,1,,,,1,1,1"])
    path = writers.save_processed_csv(clean, str(tmp_path / "clean"))
    stored = readers.read_processed(spark, path, "csv")
    assert stored.schema.simpleString() == CLEAN_SCHEMA.simpleString()
    assert sorted(values(stored), key=str) == sorted(values(clean), key=str)


def test_read_or_compute(spark, tmp_path):
    alerts = spikes.detect_discount_spikes(discount_days(spark, [10] * 8 + [46]))
    path = str(tmp_path / "alerts")
    computed = readers.read_or_compute(spark, path, ALERT_SCHEMA, lambda: alerts)
    assert values(computed) == values(alerts)
    writers.export_discount_spike_alerts(alerts.where("false"), path)
    stored = readers.read_or_compute(spark, path, ALERT_SCHEMA, lambda: alerts)
    assert values(stored) == []


def test_export_rows_have_text_dates(spark, tmp_path):
    sales = discount_days(spark, [10] * 8 + [46])
    row = record(discount_spike_rows(spark, str(tmp_path / "none"), sales))
    assert row["order_date"] == "2024-01-09"


def test_contract_snapshot_file(spark, tmp_path):
    path = writers.export_contract_snapshot(spark, str(tmp_path / "contract"))
    stored = json_record(path)
    assert stored["contract_version"] == "1.0.0"
    assert stored["required_columns"] == sorted(RAW_COLUMNS)


def test_pipeline_end_to_end(spark, tmp_path):
    source = write_csv(tmp_path / "raw.csv", DECISION)
    paths = run_pipeline(
        spark, source, str(tmp_path / "out"), pipeline_version="7", generated_at=MOMENT
    )
    stored = readers.read_clean_table(spark, paths["processed"])
    assert stored.count() == 4
    expected = reports.build_executive_tables(featured(spark, DECISION))

    def table(name):
        return spark.read.parquet(f"{paths['tables']}/{name}")

    for name in ("category_performance", "regional_performance", "payment_performance"):
        assert values(table(name)) == [
            tuple(pytest.approx(v) if isinstance(v, float) else v for v in row)
            for row in values(expected[name])
        ]
    assert {r["check"]: r["value"] for r in table("data_quality_audit").collect()}["row_count"] == 4
    assert [r["decision_rule"] for r in table("actionable_recommendations").collect()][0] == "NRR below 90%"
    assert dict(values(table("executive_summary")))["gross_revenue"] == 860.0
    for name in ("sales_trend_over_time", "monthly_trend", "numeric_describe", "price_histogram"):
        assert table(name).count() > 0
    metrics = json_record(paths["metrics"])
    assert metrics["pipeline_version"] == "7"
    assert metrics["raw_row_count"] == metrics["clean_row_count"] == 4
    assert metrics["total_revenue"] == pytest.approx(729.0)
    assert metrics["period_end"] == "2024-02-18"
    assert spark.read.schema(ALERT_SCHEMA).parquet(paths["alerts"]).count() == 0
    assert json_record(paths["contract"])["required_columns"]


def test_pipeline_stops_on_violations_or_reports_them(spark, tmp_path):
    source = write_csv(tmp_path / "raw.csv", DIRTY)
    with pytest.raises(ValueError, match="schema check"):
        run_pipeline(spark, source, str(tmp_path / "failed"))
    assert not (tmp_path / "failed").exists()
    paths = run_pipeline(
        spark, source, str(tmp_path / "out"), on_violation="report", with_profile=False
    )
    assert readers.read_clean_table(spark, paths["processed"]).count() == 1
    assert spark.read.parquet(paths["violations"]).count() == 3
    metrics = json_record(paths["metrics"])
    assert (metrics["raw_row_count"], metrics["clean_row_count"], metrics["rows_dropped"]) == (3, 1, 2)
    with pytest.raises(ValueError, match="on_violation"):
        run_pipeline(spark, source, str(tmp_path / "out"), on_violation="ignore")


def test_pipeline_refuses_empty_results(spark, tmp_path):
    with pytest.raises(ValueError, match="must not be empty"):
        run_pipeline(spark, write_csv(tmp_path / "none.csv", []), str(tmp_path / "a"))
    unusable = write_csv(tmp_path / "bad.csv", DIRTY[1:])
    with pytest.raises(ValueError, match="Quality gate failed"):
        run_pipeline(spark, unusable, str(tmp_path / "b"), on_violation="report")


def spike_table(spark, tmp_path):
    rows = discount_days(spark, [10] * 8 + [46])
    whole = rows.withColumns({"order_id": F.lit(1.0), "rating": F.lit(4.0)})
    return writers.save_processed_data(whole, str(tmp_path / "sales"))


def test_alert_run(spark, tmp_path):
    source = spike_table(spark, tmp_path)
    paths = run_alerts(
        spark, source, str(tmp_path / "out"), pipeline_version="7", generated_at=MOMENT
    )
    assert spark.read.parquet(paths["alerts"]).count() == 1
    assert json_record(paths["summary"]) == {
        "pipeline_version": "7",
        "generated_at_utc": MOMENT.isoformat(),
        "status": "attention",
        "input_dataset": source,
        "alerts_output": paths["alerts"],
        "parameters": {"z_threshold": 2.5, "min_observations": 5},
        "alerts_count": 1,
        "severity_counts": {"medium": 1},
    }
    quiet = run_alerts(spark, source, str(tmp_path / "quiet"), min_observations=50)
    assert json_record(quiet["summary"])["status"] == "ok"
    with pytest.raises(ValueError, match="min_observations"):
        run_alerts(spark, source, str(tmp_path / "out"), min_observations=1)


def test_scenario_run(spark, tmp_path):
    source = writers.save_processed_data(typed(spark, TABLES), str(tmp_path / "sales"))
    paths = run_scenario(
        spark, source, str(tmp_path / "out"), recovery_rate=0.1, overrides={"Home": 0.5}, generated_at=MOMENT
    )
    found = {r["product_category"]: r["recovery_rate"] for r in spark.read.parquet(paths["breakdown"]).collect()}
    assert found == {"Electronics": 0.1, "Home": 0.5}
    summary = json_record(paths["summary"])
    assert summary["category_overrides"] == {"Home": 0.5}
    assert summary["total_uplift"] == pytest.approx(15.2)
    plain = run_scenario(spark, source, str(tmp_path / "plain"))
    assert json_record(plain["summary"])["category_overrides"] == {}
    with pytest.raises(ValueError, match="between 0 and 1"):
        run_scenario(spark, source, str(tmp_path / "bad"), recovery_rate=2)


def test_slice_report(spark, tmp_path):
    path = writers.save_processed_data(typed(spark, TABLES), str(tmp_path / "sales"))
    sales = readers.read_clean_table(spark, path)
    report = slice_report(
        sales,
        str(tmp_path / "report"),
        start=date(2024, 1, 1),
        end=date(2024, 2, 12),
        recovery_rates={"Home": 0.5},
    )
    stored = sorted(p.name for p in (tmp_path / "report").iterdir())
    assert stored == ["discount_profile", "monthly_revenue", "sales_totals"]
    assert record(report["kpis"])["total_revenue"] == 276.0
    assert record(report["share_of_total"])["revenue_share_pct"] == pytest.approx(276 / 504 * 100)
    assert values(report["category_performance"]) == [
        ("Electronics", 180.0, 2.0, 1, 4.8, 20.0),
        ("Home", 96.0, 1.0, 1, 4.1, 24.0),
    ]
    assert values(report["revenue_by_region"]) == [("North", 180.0), ("South", 96.0)]
    assert values(report["recovery"])[0] == ("Home", 24.0, 50.0, 12.0, 108.0)
    assert values(report["discount_spikes"]) == []
    assert dict(values(report["data_quality_audit"]))["row_count"] == 2
    empty = slice_report(sales, str(tmp_path / "none"), region="Nowhere")
    assert record(empty["kpis"])["total_revenue"] == 0.0
    assert values(empty["monthly_trend"]) == []
    choices = filter_choices(sales)
    assert values(choices["payment_method"]) == [("Card",), ("Pix",)]


LONG_LINE = "7,2024-01-15,10,Home,100.0,10,2,North,Card,4.8,50,90.0,180.0,too,many"
SHORT_LINE = "8,2024-01-15,10,Home"
BROKEN = '9,2024-01-15,10,"Home\nand garden",100.0,10,2,North,Card,4.8,50,90.0,180.0'


@pytest.mark.parametrize("line", [LONG_LINE, SHORT_LINE, BROKEN])
def test_malformed_lines_stop_the_run(spark, tmp_path, line):
    source = write_csv(tmp_path / "raw.csv", [*DECISION, line])
    with pytest.raises(ValueError, match="row_malformed"):
        run_pipeline(spark, source, str(tmp_path / "out"), with_profile=False)
    assert not (tmp_path / "out" / "processed").exists()


def test_malformed_lines_are_listed_and_counted(spark, tmp_path):
    source = write_csv(tmp_path / "raw.csv", [*DECISION, LONG_LINE, SHORT_LINE])
    paths = run_pipeline(
        spark, source, str(tmp_path / "out"), on_violation="report", with_profile=False
    )
    listed = spark.read.parquet(paths["violations"]).where("rule = 'row_malformed'")
    assert sorted(r["value"] for r in listed.collect()) == [LONG_LINE, SHORT_LINE]
    metrics = json_record(paths["metrics"])
    assert (metrics["raw_row_count"], metrics["clean_row_count"]) == (6, 4)
    assert readers.read_clean_table(spark, paths["processed"]).count() == 4


def test_quoted_line_breaks_are_kept_where_asked_for(spark, tmp_path):
    source = write_csv(tmp_path / "raw.csv", [*DECISION, BROKEN])
    paths = run_pipeline(
        spark, source, str(tmp_path / "out"), multi_line=True, with_profile=False
    )
    stored = readers.read_clean_table(spark, paths["processed"])
    assert stored.count() == 5
    assert stored.where("product_category = 'Home\nand garden'").count() == 1


def test_a_failed_gate_leaves_the_processed_table(spark, tmp_path, monkeypatch):
    source = write_csv(tmp_path / "raw.csv", DECISION)
    out = str(tmp_path / "out")
    paths = run_pipeline(spark, source, out, with_profile=False)
    before = sorted(values(readers.read_clean_table(spark, paths["processed"])))
    strict = lambda value=F.col: [
        validation.Rule("quantity_sold_too_small", "quantity_sold", value("quantity_sold") < 2)
    ]
    monkeypatch.setattr(validation, "gate_rules", strict)
    monkeypatch.setattr(pipeline, "gate_rules", strict)
    other = write_csv(tmp_path / "other.csv", DECISION[:2])
    with pytest.raises(ValueError, match="quantity_sold_too_small"):
        run_pipeline(spark, other, out, with_profile=False)
    assert sorted(values(readers.read_clean_table(spark, paths["processed"]))) == before


def test_an_unfinished_write_is_not_an_empty_table(spark, tmp_path):
    alerts = spikes.detect_discount_spikes(discount_days(spark, [10] * 8 + [46]))
    path = tmp_path / "alerts"
    (path / "_temporary" / "0").mkdir(parents=True)
    found = readers.read_or_compute(spark, str(path), ALERT_SCHEMA, lambda: alerts)
    assert values(found) == values(alerts)


def test_clean_csv_takes_whole_dates_only(spark, tmp_path):
    line = "1,{},10,Home,100.0,10,2,North,Card,4.8,50,90.0,180.0"
    dates = ["2024-01-15", "2024", "2024-01-15T10:30:00.000", "2024-01", "x"]
    path = write_csv(tmp_path / "c.csv", [line.format(d) for d in dates])
    got = [r["order_date"] for r in readers.read_clean_csv(spark, path).collect()]
    assert got == [datetime(2024, 1, 15), None, datetime(2024, 1, 15, 10, 30), None, None]


def test_raw_table_of_the_fixtures_has_the_contract_columns(spark):
    assert raw(spark, DIRTY).columns == RAW_COLUMNS


def counted(calls, function):
    def call(*args, **kwargs):
        calls.append(function.__name__)
        return function(*args, **kwargs)

    return call


@pytest.fixture
def scans(monkeypatch):
    """The scans of the raw table that a run makes, by the function that makes them."""
    calls = []
    for name in ("save_processed_data", "inspect_raw", "violating_rows"):
        monkeypatch.setattr(pipeline, name, counted(calls, getattr(pipeline, name)))
    return calls


def test_a_report_run_reads_the_raw_table_once(spark, tmp_path, scans):
    source = write_csv(tmp_path / "raw.csv", DECISION)
    paths = run_pipeline(spark, source, str(tmp_path / "out"), on_violation="report", with_profile=False)
    assert scans == ["save_processed_data"]
    metrics = json_record(paths["metrics"])
    assert (metrics["raw_row_count"], metrics["clean_row_count"]) == (4, 4)
    scans.clear()
    broken = write_csv(tmp_path / "broken.csv", DIRTY)
    run_pipeline(spark, broken, str(tmp_path / "out"), on_violation="report", with_profile=False)
    assert scans == ["save_processed_data", "violating_rows"]


def test_observed_counts_equal_those_of_a_scan(spark, tmp_path):
    source = write_csv(tmp_path / "raw.csv", [*DIRTY, *DECISION, LONG_LINE])
    raw_table = readers.load_raw_sales_data(spark, source)
    found = pipeline.write_inspected(raw_table, str(tmp_path / "clean"), "auto")
    assert found == pipeline.inspect_raw(raw_table, "auto")
    assert found.rules["row_malformed"] == 1 and found.integral == ("order_id", "product_id")


def test_a_lost_executor_does_not_change_the_counts(spark, tmp_path, monkeypatch):
    """Rows observed twice disagree with the rows written, and the raw table is counted by itself."""
    decoded = pipeline.decoded
    twice = lambda counts, formats: decoded({k: 2 * v for k, v in counts.items()}, formats)
    monkeypatch.setattr(pipeline, "decoded", twice)
    source = write_csv(tmp_path / "raw.csv", DECISION)
    found = pipeline.write_inspected(readers.load_raw_sales_data(spark, source), str(tmp_path / "clean"))
    assert (found.raw_rows, found.clean_rows) == (4, 4)


def test_a_run_stopped_midway_is_not_seen(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    first = run_pipeline(spark, write_csv(tmp_path / "a.csv", DECISION), out, with_profile=False)
    assert runs.published_outputs(spark, out) == first

    def stop(*args):
        raise KeyboardInterrupt

    other = write_csv(tmp_path / "b.csv", DECISION[:2])
    with monkeypatch.context() as patch:
        patch.setattr(pipeline, "save_reports", stop)  # the clean table is there, the reports are not
        with pytest.raises(KeyboardInterrupt):
            run_pipeline(spark, other, out, with_profile=False)
    assert len(list((tmp_path / "out" / "runs").iterdir())) == 2
    assert runs.published_outputs(spark, out) == first
    assert readers.read_clean_table(spark, out).count() == 4
    second = run_pipeline(spark, other, out, with_profile=False)
    assert runs.published_outputs(spark, out) == second
    assert readers.read_clean_table(spark, out).count() == 2
    assert readers.read_clean_table(spark, first["processed"]).count() == 4  # a reader of the older run goes on
    run_alerts(spark, out, str(tmp_path / "alerts"))  # jobs follow the newest run
    assert runs.expire_runs(spark, out, keep=1) == [first["processed"].split("/")[-2]]
    assert runs.published_outputs(spark, out) == second and not Path(first["processed"]).exists()


def test_a_failed_gate_leaves_no_folder_of_its_run(spark, tmp_path):
    out = tmp_path / "out"
    paths = run_pipeline(spark, write_csv(tmp_path / "a.csv", DECISION), str(out), with_profile=False)
    with pytest.raises(ValueError, match="Quality gate failed"):
        run_pipeline(spark, write_csv(tmp_path / "b.csv", DIRTY[1:]), str(out), on_violation="report")
    assert [p.name for p in (out / "runs").iterdir()] == [paths["processed"].split("/")[-2]]
    assert readers.read_clean_table(spark, str(out)).count() == 4


def test_manifests(spark, tmp_path):
    out = str(tmp_path / "out")
    assert runs.published_outputs(spark, out) is None and runs.published_path(spark, out, "x") == out
    run = runs.new_run(out)
    with pytest.raises(ValueError, match="outside"):
        runs.publish(spark, run, {"x": str(tmp_path / "elsewhere")})
    runs.publish(spark, run, {"x": run.path("x")})
    assert runs.published_path(spark, out, "x") == run.path("x")
    with pytest.raises(ValueError, match="published"):
        runs.discard(spark, run)
    assert runs.published_outputs(spark, out, "other") is None
    with pytest.raises(ValueError, match="keep"):
        runs.expire_runs(spark, out, 0)


DATED = "{},{},10,Home,100.0,10,2,North,Card,4.8,50,90.0,180.0"


def dated(spark, tmp_path, *dates):
    lines = [DATED.format(i, d) for i, d in enumerate(dates)]
    return readers.load_raw_sales_data(spark, write_csv(tmp_path / "dated.csv", lines))


@pytest.mark.parametrize(
    ("dates", "expected"),
    [
        (["2024-01-15", "2024-2-3"], "y-M-d"),
        (["03/04/2024", "25/04/2024", "x"], "d/M/yyyy"),
        (["03/04/2024", "04/25/2024"], "M/d/yyyy"),
        (["25-04-2024", "01-02-2024"], "d-M-yyyy"),
        (["25.04.2024"], "d.M.yyyy"),
        (["2024-01-15 10:30:00", "2024-01-16 00:00:00", "2024-01-17"], "yyyy-M-d H:m:s"),
        (["05/05/2024", "06/06/2024"], "d/M/yyyy"),  # both readings agree
        (["03/04/2024", "25/04/2024", "2024-01-15"], "d/M/yyyy"),  # the other one is no date of this column
        (["x", None], "y-M-d"),
    ],
)
def test_the_dates_vote_for_their_format(spark, tmp_path, dates, expected):
    table = dated(spark, tmp_path, *dates)
    found = pipeline.inspect_raw(table, "auto")
    assert found.date_format == expected
    kept = pipeline.clean_sales_data(table, found.date_format).count()
    assert found.clean_rows == kept


@pytest.mark.parametrize(
    ("dates", "message"),
    [
        (["03/04/2024", "05/06/2024"], "ambiguous"),
        (["25/04/2024", "04/25/2024", "04/26/2024"], "mixed"),
        (["25-04-2024", "04-25-2024"], "mixed"),
    ],
)
def test_mixed_and_ambiguous_dates_are_errors(spark, tmp_path, dates, message):
    table = dated(spark, tmp_path, *dates)
    with pytest.raises(ValueError, match=message):
        pipeline.inspect_raw(table, "auto")
    assert pipeline.inspect_raw(table, "d/M/yyyy").raw_rows == len(dates)  # a named format decides
    source = str(tmp_path / "dated.csv")
    for mode in ("fail", "report"):
        with pytest.raises(ValueError, match=message):
            run_pipeline(spark, source, str(tmp_path / mode), on_violation=mode, date_format="auto")
    assert runs.published_outputs(spark, str(tmp_path / "report")) is None


def test_files_of_two_date_orders(spark, tmp_path):
    """One file day first and one month first are a mixed table, whichever file is read first."""
    folder = tmp_path / "in"
    folder.mkdir()
    write_csv(folder / "a.csv", [DATED.format(1, "25/04/2024")])
    write_csv(folder / "b.csv", [DATED.format(2, "04/25/2024")])
    with pytest.raises(ValueError, match="mixed"):
        run_pipeline(spark, str(folder), str(tmp_path / "out"), date_format="auto")


def test_a_wrong_guess_is_written_again(spark, tmp_path, scans):
    lines = [DATED.format(i, d) for i, d in [(1, "05/04/2024"), ("2.5", "04/25/2024"), (3, "04/26/2024")]]
    source = write_csv(tmp_path / "raw.csv", lines)
    paths = run_pipeline(
        spark, source, str(tmp_path / "out"), on_violation="report", date_format="auto", with_profile=False
    )
    assert scans[:2] == ["save_processed_data", "save_processed_data"]
    stored = readers.read_clean_table(spark, paths["processed"])
    assert sorted(r["order_id"] for r in stored.collect()) == [1.0, 2.5, 3.0]
    assert {r["order_date"].day for r in stored.collect()} == {4, 25, 26}


def test_large_ids_stay_apart(spark, tmp_path):
    ids = [2**53, 2**53 + 1, -(2**63), " 7 "]
    source = write_csv(tmp_path / "raw.csv", [DATED.format(i, "2024-01-15") for i in ids])
    paths = run_pipeline(spark, source, str(tmp_path / "out"), with_profile=False)
    stored = readers.read_clean_table(spark, paths["processed"])
    assert dict(stored.dtypes)["order_id"] == "bigint"
    assert sorted(r["order_id"] for r in stored.collect()) == [-(2**63), 7, 2**53, 2**53 + 1]
    summary = spark.read.parquet(f"{paths['tables']}/kpi_summary")
    assert {r["metric"]: r["value"] for r in summary.collect()}["total_orders"] == 4
    # One number that is not whole, or too large, makes the column one of doubles.
    for other in ("1.5", "1e3", str(2**63)):
        source = write_csv(tmp_path / "raw.csv", [DATED.format(i, "2024-01-15") for i in (1, other)])
        assert pipeline.inspect_raw(readers.load_raw_sales_data(spark, source)).integral == ("product_id",)


def test_violations_name_the_place_of_their_row(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    bad = ",2024-01-15,10,Home,-1,10,2,North,Card,4.8,50,90.0,180.0"
    write_csv(folder / "a.csv", [bad, bad, DECISION[0], bad])
    write_csv(folder / "b.csv", [bad])
    placed = readers.load_raw_sales_data(spark, str(folder), with_place=True)
    rows = validation.violating_rows(placed).where("rule = 'price_ge_0'").collect()
    assert len(rows) == 4 and {r["order_id"] for r in rows} == {None}
    assert len({(r["source_file"], r["block_start"], r["position"]) for r in rows}) == 4
    of_a = sorted(r["position"] for r in rows if r["source_file"].endswith("a.csv"))
    assert [p - of_a[0] for p in of_a] == [0, 1, 3]
    paths = run_pipeline(spark, str(folder), str(tmp_path / "out"), on_violation="report", with_profile=False)
    assert {"source_file", "block_start", "position"} <= set(spark.read.parquet(paths["violations"]).columns)
    assert "_place" not in pipeline.clean_sales_data(placed).columns
