from datetime import datetime

import pytest
from pyspark.sql import functions as F

from samples import discount_days, record, values
from tillroll.operators import spikes
from tillroll.schema import ALERT_SCHEMA

SPIKE = [10, 11, 9, 10, 10, 11, 10, 45]


def test_spike_fixture(spark):
    alerts = spikes.detect_discount_spikes(
        discount_days(spark, SPIKE), z_threshold=2.0, min_observations=5
    )
    assert alerts.columns == ALERT_SCHEMA.names
    row = record(alerts)
    assert row["order_date"] == datetime(2024, 1, 8)
    assert row["baseline_mean"] == 14.5
    assert row["baseline_std"] == pytest.approx(12.340409810282408)
    assert row["z_score"] == pytest.approx(2.4715548728848913)
    assert row["estimated_leakage_usd"] == pytest.approx(61.0)
    assert row["severity"] == "medium"
    assert spikes.detect_discount_spikes(discount_days(spark, SPIKE)).isEmpty()


@pytest.mark.parametrize(
    ("discounts", "z", "severity"),
    [
        ([10] * 8 + [46], 2.6667, "medium"),
        ([10] * 19 + [50], 4.2485, "high"),
        ([10] * 29 + [50], 5.2947, "critical"),
    ],
)
def test_severities(spark, discounts, z, severity):
    row = record(spikes.detect_discount_spikes(discount_days(spark, discounts)))
    assert row["z_score"] == pytest.approx(z, abs=1e-4)
    assert row["severity"] == severity


def test_severity_bins_are_right_closed(spark):
    scores = spark.createDataFrame([(z,) for z in (2.5, 3.5, 3.50001, 5.0, 6.0)], "z double")
    assert [row[0] for row in values(scores.select(spikes.severity(F.col("z"))))] == [
        "medium",
        "medium",
        "high",
        "high",
        "critical",
    ]


def test_flat_and_single_days_score_zero(spark):
    flat = spikes.score_profile(spikes.discount_profile(discount_days(spark, [10] * 5)))
    assert {(row["baseline_std"], row["z_score"], row["obs_count"]) for row in flat.collect()} == {
        (0.0, 0.0, 5)
    }
    single = record(spikes.score_profile(spikes.discount_profile(discount_days(spark, [10]))))
    assert (single["baseline_std"], single["z_score"], single["obs_count"]) == (0.0, 0.0, 1)
    assert spikes.detect_discount_spikes(discount_days(spark, [10])).isEmpty()


def test_days_without_a_discount_do_not_count(spark):
    days = discount_days(spark, [10, 20]).withColumn(
        "discount_percent", F.when(F.col("discount_percent") < 15, F.col("discount_percent"))
    )
    scored = {r["order_date"].day: r for r in spikes.score_profile(spikes.discount_profile(days)).collect()}
    assert scored[1]["obs_count"] == scored[2]["obs_count"] == 1
    assert scored[2]["z_score"] == 0.0
    assert scored[2]["estimated_leakage_usd"] is None


def test_a_key_without_any_discount_has_an_empty_baseline(spark):
    days = discount_days(spark, [10, 20], gross=0.0).withColumn(
        "discount_percent", F.lit(None).cast("double")
    )
    rows = spikes.score_profile(spikes.discount_profile(days)).collect()
    assert {(row["obs_count"], row["z_score"]) for row in rows} == {(0, 0.0)}


def test_null_dates_and_categories_are_left_out(spark):
    days = discount_days(spark, [10] * 8 + [46])
    noise = days.withColumn("order_date", F.lit(None).cast("timestamp_ntz")).union(
        days.withColumn("product_category", F.lit(None).cast("string"))
    )
    assert values(spikes.detect_discount_spikes(days.union(noise))) == values(
        spikes.detect_discount_spikes(days)
    )


def test_grains(spark):
    days = discount_days(spark, [10, 20])
    later = days.withColumn("order_date", F.col("order_date") + F.expr("interval 5 hours"))
    both = days.union(later)
    counts = {grain: spikes.discount_profile(both, grain=grain).count() for grain in spikes.GRAINS}
    assert counts == {"exact": 4, "day": 2, "month": 1}
    with pytest.raises(ValueError, match="grain"):
        spikes.discount_profile(days, grain="week")


@pytest.mark.parametrize("threshold", [3.5, 4])
def test_thresholds_beyond_medium_are_refused(spark, threshold):
    with pytest.raises(ValueError, match="z_threshold"):
        spikes.detect_discount_spikes(discount_days(spark, [10]).where("false"), z_threshold=threshold)


def test_parameter_checks():
    spikes.check_alert_parameters(2.5, 2)
    with pytest.raises(ValueError, match="z_threshold"):
        spikes.check_alert_parameters(0, 5)
    with pytest.raises(ValueError, match="min_observations"):
        spikes.check_alert_parameters(2.5, 1)


def mixed(spark):
    tables = [
        discount_days(spark, [10] * 8 + [46], "A", gross=100.0),
        discount_days(spark, [10] * 8 + [46], "B", gross=200.0),
        discount_days(spark, [10] * 19 + [50], "C"),
        discount_days(spark, [10] * 29 + [50], "D"),
    ]
    first, *others = tables
    for table in others:
        first = first.union(table)
    return first


def test_alert_order_is_textual_or_by_rank(spark):
    keys = [row["product_category"] for row in spikes.detect_discount_spikes(mixed(spark)).collect()]
    assert keys == ["B", "A", "C", "D"]
    ranked = spikes.detect_discount_spikes(mixed(spark), by_rank=True)
    assert [row["product_category"] for row in ranked.collect()] == ["D", "C", "B", "A"]


def test_counts_and_status(spark):
    alerts = spikes.detect_discount_spikes(mixed(spark))
    assert values(spikes.severity_counts(alerts)) == [("critical", 1), ("high", 1), ("medium", 2)]
    assert record(spikes.alert_summary(alerts)) == {
        "alerts_count": 4,
        "severity_counts": {"critical": 1, "high": 1, "medium": 2},
        "status": "attention",
    }
    assert record(spikes.alert_summary(alerts.where("false"))) == {
        "alerts_count": 0,
        "severity_counts": {},
        "status": "ok",
    }


def test_scores_agree_with_brute_force(spark):
    """A hot key with most of the rows, against statistics computed in plain Python."""
    import random
    import statistics

    draw = random.Random(5)
    rows = [
        ("hot" if draw.random() < 0.7 else f"k{draw.randrange(5)}", draw.randrange(40), draw.uniform(0, 50))
        for _ in range(2000)
    ]
    table = spark.createDataFrame(rows, "product_category string, d int, discount_percent double")
    table = table.select(
        F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(d)").alias("order_date"),
        "product_category",
        "discount_percent",
        F.lit(1.0).alias("price"),
        F.lit(1.0).alias("quantity_sold"),
        F.lit(1.0).alias("total_revenue"),
    )
    daily = {}
    for key, day, discount in rows:
        daily.setdefault(key, {}).setdefault(day, []).append(discount)
    expected = {}
    for key, days in daily.items():
        means = {day: statistics.fmean(found) for day, found in days.items()}
        mean, std = statistics.fmean(means.values()), statistics.stdev(means.values())
        expected |= {(key, day): (m - mean) / std for day, m in means.items()}
    scored = spikes.score_profile(spikes.discount_profile(table)).collect()
    found = {(r["product_category"], (r["order_date"] - datetime(2024, 1, 1)).days): r["z_score"] for r in scored}
    assert found.keys() == expected.keys()
    assert all(found[k] == pytest.approx(expected[k], abs=1e-9) for k in expected)
