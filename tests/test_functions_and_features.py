import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from samples import BASE, TABLES, featured, record, typed, values
from tillroll.functions import blank_missing, clip, to_moment, to_number
from tillroll.operators.features import (
    build_features,
    date_bounds,
    dimension_values,
    ensure_revenue_columns,
    slice_sales,
)
from tillroll.operators.profiling import correlation_matrix
from tillroll.operators.reports import category_performance, data_quality_audit
from tillroll.operators.cleaning import clean_sales_data
from tillroll.schema import RAW_COLUMNS


def parsed(spark, texts):
    table = spark.createDataFrame([(text,) for text in texts], "value string")
    return [row[0] for row in table.select(to_number(table, "value")).collect()]


def test_numbers(spark):
    texts = ["abc", "1d", "NaN", " 5 ", "1e3", "", None, ".5", "5.", "-2", "0x10", "1 2", "5\t"]
    assert parsed(spark, texts) == [
        None, None, None, 5.0, 1000.0, None, None, 0.5, 5.0, -2.0, None, None, 5.0,
    ]
    assert parsed(spark, ["inf", "-Infinity"]) == [math.inf, -math.inf]


def test_nan_in_a_number_column_is_null(spark):
    table = spark.createDataFrame([(float("nan"),), (1.0,)], "value double")
    assert values(table.select(to_number(table, "value"))) == [(None,), (1.0,)]


def test_dates(spark):
    texts = ["2024-01-15", "2024-1-5", "15/01/2024", "2024-01-16 10:00", "2024", "", None]
    table = spark.createDataFrame([(text,) for text in texts], "day string")
    moments = [row[0] for row in table.select(to_moment(table, "day")).collect()]
    assert moments == [datetime(2024, 1, 15), datetime(2024, 1, 5)] + [None] * 5


def test_missing_tokens_become_null(spark):
    table = spark.createDataFrame([("N/A", 1), ("", 2), ("null", 3), ("Home", 4)], "a string, b int")
    assert values(blank_missing(table)) == [(None, 1), (None, 2), (None, 3), ("Home", 4)]


def test_clip_keeps_null(spark):
    table = spark.createDataFrame([(None,), (-1.0,), (7.0,), (3.0,)], "x double")
    assert values(table.select(clip(F.col("x"), 0.0, 5.0))) == [(None,), (0.0,), (5.0,), (3.0,)]


def test_features_of_the_base_row(spark):
    row = record(featured(spark, BASE))
    assert (row["year"], row["month"], row["quarter"]) == (2024, 1, 1)
    assert (row["month_name"], row["day_of_week"], row["is_weekend"]) == ("January", "Monday", False)
    assert row["gross_revenue"] == 200.0
    assert row["discount_value"] == 20.0
    assert row["net_revenue_retained"] == 0.9
    assert row["revenue_per_unit"] == 90.0
    assert row["discount_impact_pct"] == pytest.approx(10.0)


def test_weekend_days(spark):
    weekend = [row["is_weekend"] for row in featured(spark, TABLES).orderBy("order_id").collect()]
    assert weekend == [False, True, True]


def test_zero_price_gives_zero_ratios(spark):
    table = typed(spark, BASE).withColumns({"price": F.lit(0.0), "total_revenue": F.lit(0.0)})
    row = record(build_features(table))
    assert row["net_revenue_retained"] == 0.0
    assert row["revenue_per_unit"] == 0.0
    assert row["discount_impact_pct"] == 0.0


def test_null_date_is_not_a_weekend(spark):
    table = typed(spark, BASE).withColumn("order_date", F.lit(None).cast("timestamp_ntz"))
    row = record(build_features(table))
    assert (row["year"], row["is_weekend"]) == (None, False)


def test_revenue_columns_are_derived_only_when_absent(spark):
    derived = record(ensure_revenue_columns(typed(spark, BASE)))
    assert (derived["gross_revenue"], derived["discount_value"]) == (200.0, 20.0)
    given = typed(spark, BASE).withColumn("gross_revenue", F.lit(500.0))
    kept = record(ensure_revenue_columns(given))
    assert (kept["gross_revenue"], kept["discount_value"]) == (500.0, 320.0)


def test_slices_are_inclusive_and_combine(spark):
    table = featured(spark, TABLES)

    def ids(**bounds):
        return sorted(row["order_id"] for row in slice_sales(table, **bounds).collect())

    assert ids() == [1, 2, 3]
    assert ids(start=date(2024, 2, 10), end=date(2024, 2, 18)) == [2, 3]
    assert ids(start=date(2024, 1, 15), end=date(2024, 1, 15)) == [1]
    assert ids(region="North", category="Electronics") == [1, 3]
    assert ids(payment="Pix", region="North") == []
    assert ids(start=date(2024, 3, 1), end=date(2024, 2, 1)) == []


def test_slice_keeps_the_last_moment_of_the_day(spark):
    table = typed(spark, BASE).withColumn(
        "order_date", F.lit("2024-01-15 23:59:59.999").cast("timestamp_ntz")
    )
    assert slice_sales(table, end=date(2024, 1, 15)).count() == 1


def test_date_bounds_and_dimension_values(spark):
    table = typed(spark, [*TABLES, "4,2024-03-01,1,,1,1,1,,,1,1,1,1"])
    assert record(date_bounds(table)) == {
        "first_order_date": datetime(2024, 1, 15),
        "last_order_date": datetime(2024, 3, 1),
    }
    assert values(dimension_values(table, "product_category")) == [("Electronics",), ("Home",)]


def test_infinite_prices_count_as_missing_differences(spark):
    """Infinity less infinity is no number: it is null, its ratios are 0, and sums leave it out."""
    lines = [
        "1,2024-01-15,10,Home,inf,10,2,North,Card,4.8,50,inf,inf",
        "2,2024-01-15,10,Home,100.0,10,2,North,Card,4.8,50,90.0,180.0",
    ]
    rows = featured(spark, lines)
    first = rows.where("order_id = 1").first()
    assert first["gross_revenue"] == float("inf") and first["discount_value"] is None
    assert (first["net_revenue_retained"], first["discount_impact_pct"]) == (0.0, 0.0)
    category = category_performance(rows).first()
    assert category["discount_value"] == 20.0
    audit = {r["check"]: r["value"] for r in data_quality_audit(rows).collect()}
    assert audit["null_values"] == 1
    pairs = {(r["x"], r["y"]): r["r"] for r in correlation_matrix(rows, ["discount_value", "rating"]).collect()}
    assert pairs[("discount_value", "discount_value")] is None


def test_cleaned_values_are_computed_once(spark):
    """Features name a parsed value many times over; only one place in the plan may parse it."""
    raw = spark.createDataFrame([("2024-02-29", "2.5")], "order_date string, price string")
    others = {name: F.lit("1") for name in RAW_COLUMNS if name not in raw.columns}
    rows = build_features(clean_sales_data(raw.withColumns(others)))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    after = plan[: plan.index("Generate inline")]
    assert "RLIKE" not in after and "cast(price" not in after and "date_format" not in after
    assert (rows.first()["month_name"], rows.first()["day_of_week"]) == ("February", "Thursday")


def test_names_of_months_and_days(spark):
    days = spark.sql("SELECT explode(sequence(DATE'1999-12-20', DATE'2001-01-10')) AS day")
    rows = days.select(F.col("day").cast("timestamp_ntz").alias("order_date")).withColumns(
        {name: F.lit(1.0) for name in ("price", "quantity_sold", "total_revenue")}
    )
    named = build_features(rows)
    wrong = (F.col("month_name") != F.date_format("order_date", "MMMM")) | (
        F.col("day_of_week") != F.date_format("order_date", "EEEE")
    )
    assert named.where(F.coalesce(wrong, F.lit(True))).count() == 0
