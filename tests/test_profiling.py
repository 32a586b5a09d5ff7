import math
import random
import statistics
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from samples import TABLES, featured, typed, values
from tillroll.operators import profiling


def numbers(spark, **columns):
    names = list(columns)
    rows = list(zip(*columns.values()))
    return spark.createDataFrame(rows, ", ".join(f"{name} double" for name in names))


def described(df, **options):
    return {row["column"]: row.asDict() for row in profiling.describe_numeric(df, **options).collect()}


def test_column_profile(spark):
    table = numbers(spark, a=[1.0, None, 3.0], b=[None, None, None])
    assert values(profiling.column_profile(table)) == [("a", "double", 2, 3), ("b", "double", 0, 3)]


def test_describe_fixture(spark):
    table = featured(spark, TABLES)
    found = described(table)
    assert set(found) == set(profiling.numeric_columns(table))
    assert "is_weekend" not in found
    price = found["price"]
    assert (price["count"], price["mean"], price["std"]) == (3, pytest.approx(100), pytest.approx(20))
    assert (price["min"], price["p25"], price["p50"], price["p75"], price["max"]) == (80, 90, 100, 110, 120)


@pytest.mark.parametrize(
    "settings",
    [
        {},
        {"GATHERED": 40},  # brackets are sketched again
        {"GATHERED": 3, "SKETCH_SIZE": 8, "MARGIN": 0.0},  # many brackets miss their rank and move
        {"SKETCH_SIZE": 8, "MARGIN": 1e-6},
    ],
)
def test_exact_quantiles_agree_with_brute_force(spark, settings, monkeypatch):
    for name, value in settings.items():
        monkeypatch.setattr(profiling, name, value)
    draw = random.Random(11)
    size = 3001
    columns = {
        "skewed": [math.exp(draw.gauss(0, 4)) for _ in range(size)],
        "signed": [draw.gauss(0, 1e-3) * draw.choice([1, 1e6]) for _ in range(size)],
        "hot": [7.0 if draw.random() < 0.6 else draw.uniform(0, 10) for _ in range(size)],
        "constant": [3.0] * size,
        "outlier": [draw.uniform(0, 1) for _ in range(size - 1)] + [1e300],
        "nullable": [None if draw.random() < 0.5 else draw.uniform(-5, 5) for _ in range(size)],
        "integers": [float(draw.randrange(50)) for _ in range(size)],
    }
    quantiles = (0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0)
    found = described(numbers(spark, **columns), quantiles=quantiles)
    assert set(found) == set(columns)
    for name, column in columns.items():
        present = [v for v in column if v is not None]
        row = found[name]
        assert row["count"] == len(present)
        assert (row["min"], row["max"]) == (min(present), max(present))
        if name != "outlier":
            assert row["mean"] == pytest.approx(statistics.fmean(present), rel=1e-9, abs=1e-9)
            assert row["std"] == pytest.approx(statistics.stdev(present), rel=1e-9, abs=1e-12)
        for q in quantiles:
            expected = float(np.quantile(present, q))
            assert row[profiling.quantile_name(q)] == pytest.approx(expected, rel=1e-12, abs=1e-15)


def test_describe_of_few_or_no_values(spark):
    found = described(numbers(spark, one=[5.0, None], none=[None, None]))
    assert set(found) == {"one"}
    assert found["one"]["std"] is None
    assert (found["one"]["p25"], found["one"]["p75"]) == (5.0, 5.0)


def test_approximate_quantiles(spark):
    table = numbers(spark, a=[float(i) for i in range(1001)])
    assert described(table, approx=True)["a"]["p50"] == pytest.approx(500, abs=1)


def test_describe_timestamps(spark):
    (row,) = profiling.describe_timestamps(typed(spark, TABLES)).collect()
    assert row["column"] == "order_date"
    assert (row["count"], row["min"], row["max"]) == (3, datetime(2024, 1, 15), datetime(2024, 2, 18))
    assert row["p50"] == datetime(2024, 2, 10)
    assert row["p25"] == datetime(2024, 1, 28)


def test_correlations(spark):
    table = numbers(
        spark,
        x=[1.0, 2.0, 3.0, 4.0, None],
        y=[2.0, 4.0, 5.0, 9.0, 1.0],
        z=[None, 1.0, 0.0, 5.0, 2.0],
        c=[3.0] * 5,
    )
    found = {(row["x"], row["y"]): row["r"] for row in profiling.correlation_matrix(table).collect()}
    assert len(found) == 16
    assert found["x", "x"] == pytest.approx(1)
    assert found["x", "y"] == found["y", "x"] == pytest.approx(statistics.correlation([1, 2, 3, 4], [2, 4, 5, 9]))
    assert found["x", "z"] == pytest.approx(statistics.correlation([2, 3, 4], [1, 0, 5]))
    assert found["x", "c"] is None and found["c", "c"] is None


def test_histogram(spark):
    table = numbers(spark, price=[0.0, 1.0, 2.0, 9.9, 10.0, None])
    assert values(profiling.histogram(table, "price", 5)) == [
        (1, 0.0, 2.0, 2),
        (2, 2.0, 4.0, 1),
        (5, 8.0, 10.0, 2),
    ]
    constant = numbers(spark, price=[4.0, 4.0])
    assert values(profiling.histogram(constant, "price", 5)) == [(1, 4.0, 4.0, 2)]
    assert values(profiling.histogram(table.where("false"), "price", 5)) == []


def test_automatic_bins(spark):
    rng = np.random.default_rng(2)
    for column in (rng.normal(size=3000), rng.exponential(size=500), np.repeat([1.0, 2.0, 9.0], [90, 5, 5])):
        table = numbers(spark, price=column.tolist())
        width = 2 * np.subtract(*np.quantile(column, [0.75, 0.25])) / len(column) ** (1 / 3)
        bins = math.ceil(max(np.ptp(column) / width if width else 0, math.log2(len(column)) + 1))
        assert profiling.automatic_bins(table, "price") == bins
        assert sum(n for *_, n in values(profiling.histogram(table, "price"))) == len(column)
        assert max(b for b, *_ in values(profiling.histogram(table, "price"))) == bins
    assert profiling.automatic_bins(numbers(spark, price=[4.0, 4.0]), "price") == 1
    assert profiling.automatic_bins(numbers(spark, price=[None]), "price") == 1
    assert profiling.automatic_bins(numbers(spark, price=[1.0, float("inf")]), "price") == 1
    assert len(values(profiling.histogram(numbers(spark, price=column.tolist()), "price", 3))) <= 3


def test_an_explicit_bandwidth_wins(spark):
    table = numbers(spark, price=[0.0, 1.0, 2.0, 3.0])
    wide, narrow = (values(profiling.density(table, "price", 4, 5, b)) for b in (50.0, 0.5))
    assert max(d for _, d in wide) < 0.02 < 0.1 < max(d for _, d in narrow)
    assert values(profiling.density(numbers(spark, price=[4.0, 4.0]), "price", 4, 5, 1.0)) == []


def test_density_integrates_to_about_one(spark):
    draw = random.Random(3)
    table = numbers(spark, price=[draw.gauss(100, 5) for _ in range(2000)])
    curve = values(profiling.density(table, "price", 60, 101))
    assert len(curve) == 101
    step = curve[1][0] - curve[0][0]
    assert sum(d for _, d in curve) * step == pytest.approx(1, abs=0.02)
    assert max(curve, key=lambda point: point[1])[0] == pytest.approx(100, abs=2)


def test_density_needs_a_spread(spark):
    assert values(profiling.density(numbers(spark, price=[4.0, 4.0]))) == []


def test_basic_eda_plans(spark):
    assert set(profiling.basic_eda(featured(spark, TABLES))) == {
        "column_profile",
        "numeric_describe",
        "timestamp_describe",
        "correlation_matrix",
        "price_histogram",
        "price_density",
    }


def test_a_narrow_column_with_many_values(spark):
    """Values of many digits lie close together."""
    rows = spark.range(200_000).select((F.lit(1e6) + F.col("id") * 1e-3).alias("v"))
    (row,) = profiling.describe_numeric(rows, [0.25, 0.5]).collect()
    assert row["p50"] == pytest.approx(1e6 + 99_999.5e-3, abs=1e-6)
    assert row["p25"] == pytest.approx(1e6 + 49_999.75e-3, abs=1e-6)


def test_two_scans_are_enough(spark, monkeypatch):
    scans = []
    counted = profiling._next_scan
    monkeypatch.setattr(profiling, "_next_scan", lambda *a: scans.append(1) or counted(*a))
    rows = spark.range(1_000_000).select(F.rand(5).alias("v"), F.randn(6).alias("w"), (F.col("id") % 7).alias("ties"))
    found = described(rows, quantiles=[0.01, 0.5, 0.99])
    assert len(scans) == 1 and found["ties"]["p50"] == 3
    assert found["v"]["p50"] == pytest.approx(0.5, abs=0.01)
    described(rows, approx=True)
    assert len(scans) == 1


def test_quantiles_out_of_range(spark):
    with pytest.raises(ValueError, match="between 0 and 1"):
        profiling.describe_numeric(numbers(spark, a=[1.0]), [1.5])


def test_describe_odd_values(spark):
    inf = float("inf")
    found = described(numbers(spark, a=[1.0, inf, -inf, 2.0, float("nan")], b=[0.0, -0.0, 0.0, None, 1.0]))
    assert found["a"]["count"] == 4 and (found["a"]["min"], found["a"]["p50"], found["a"]["max"]) == (-inf, 1.5, inf)
    assert found["b"]["p50"] == 0 and found["b"]["max"] == 1
    assert described(numbers(spark, a=[1.0]).where("false")) == {}
    assert profiling.describe_numeric(spark.createDataFrame([("x",)], "s string")).columns[:2] == ["column", "count"]


def test_the_mean_of_times_is_exact(spark):
    rows = spark.sql("SELECT timestamp_ntz'9999-12-31 23:59:59.999999' - make_dt_interval(0, 0, 0, id / 1e6) AS t FROM range(3)")
    (row,) = profiling.describe_timestamps(rows).collect()
    assert (row["mean"].second, row["mean"].microsecond) == (59, 999998)


def test_correlations_of_many_columns(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 105)).cumsum(axis=1)
    x[rng.random(x.shape) < 0.1] = np.nan
    x[:, 7] = 2.5
    x[3, 9] = np.inf
    table = spark.createDataFrame([tuple(map(float, row)) for row in x], ", ".join(f"c{i} double" for i in range(105)))
    found = {(r["x"], r["y"]): r["r"] for r in profiling.correlation_matrix(table).collect()}
    assert len(found) == 105 * 105
    for i, j in [(0, 1), (4, 3), (0, 104), (104, 103), (50, 50), (12, 90)]:
        both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
        assert found[f"c{i}", f"c{j}"] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1])
    assert all(found["c7", f"c{j}"] is None for j in range(105))
    met = ~np.isnan(x[3])  # the row with the infinite value counts only where the other one has a value
    assert all((found[f"c{j}", "c9"] is None) == bool(met[j] or j == 7) for j in range(105) if j != 9)


def test_correlations_merge_over_tasks(spark):
    """Large offsets do not cancel, and a column may vary in one task only, or only where another has no value."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=900)
    y = 0.5 * x + rng.normal(size=900)
    rows = [(float(1e9 + a), float(b), 1.0 if i else 2.0, 0.1 if i % 3 else float(i), None if i % 3 == 0 else float(b))
            for i, (a, b) in enumerate(zip(x, y))]
    table = spark.createDataFrame(rows, "x double, y double, once double, s double, t double").repartition(7)
    found = {(r["x"], r["y"]): r["r"] for r in profiling.correlation_matrix(table).collect()}
    assert found["x", "y"] == pytest.approx(np.corrcoef(x, y)[0, 1], abs=1e-6)
    assert found["once", "y"] == pytest.approx(np.corrcoef([r[2] for r in rows], y)[0, 1])
    assert found["s", "t"] is None and found["s", "y"] is not None
    assert values(profiling.correlation_matrix(table.where("false"))) == []
    assert values(profiling.correlation_matrix(spark.createDataFrame([("a",)], "s string"))) == []


def test_timestamps_are_exact_for_late_dates(spark):
    rows = spark.sql(
        "SELECT timestamp_ntz'9999-12-31 23:59:59.999999' AS t UNION ALL SELECT timestamp_ntz'9999-12-31 23:59:59.999997'"
    )
    (row,) = profiling.describe_timestamps(rows, [0.5]).collect()
    assert (row["min"].microsecond, row["p50"].microsecond, row["max"].microsecond) == (999997, 999998, 999999)


def test_brackets_are_counted_outside_of_expressions(spark, monkeypatch):
    """Some hundreds of functions a row for the columns of a sales table; only the first scan sketches."""

    def refused(*_):
        raise AssertionError("values are gathered by an expression")

    monkeypatch.setattr(profiling.F, "collect_list", refused)
    table = spark.range(1001).select(F.col("id").cast("double").alias("a"), (F.col("id") % 7).alias("b"))
    found = {row["column"]: (row["p25"], row["p50"], row["p75"]) for row in profiling.describe_numeric(table).collect()}
    assert found == {"a": (250.0, 500.0, 750.0), "b": (1.0, 3.0, 5.0)}


@pytest.mark.parametrize("gathered, points", [(20_000, 2_000), (10, 20)])
def test_quantiles_where_brackets_are_thinned(spark, monkeypatch, gathered, points):
    """With few values gathered, later scans cut through the brackets; nulls, infinities and one frequent value."""
    monkeypatch.setattr(profiling, "GATHERED", gathered)
    monkeypatch.setattr(profiling, "POINTS", points)
    monkeypatch.setattr(profiling, "MARGIN", 0.05)
    rng = np.random.default_rng(3)
    values = [*rng.normal(size=6000).tolist(), *[0.25] * 2500, *[float("inf"), float("-inf")] * 20]
    rng.shuffle(values)
    table = spark.createDataFrame([(v, None if v > 1 else v) for v in values], "a double, b double").repartition(5)
    for row in profiling.describe_numeric(table, [0.1, 0.25, 0.5, 0.9]).collect():
        kept = np.array([v for v in values if row["column"] == "a" or v <= 1])
        want = np.quantile(kept, [0.1, 0.25, 0.5, 0.9]).tolist()
        assert [row[name] for name in ("p10", "p25", "p50", "p90")] == pytest.approx(want)
    micros = spark.createDataFrame([(datetime(2024, 1, 1) + timedelta(microseconds=i),) for i in range(4001)], "t timestamp_ntz")
    row = profiling.describe_timestamps(micros).first()
    assert row["p25"] == datetime(2024, 1, 1, 0, 0, 0, 1000) and row["p50"] == datetime(2024, 1, 1, 0, 0, 0, 2000)
