import pytest
from pyspark.sql import functions as F

from samples import BASE, DIRTY, raw, record, typed, values
from tillroll.operators.cleaning import clean_sales_data, retention
from tillroll.operators.contracts import (
    contract_snapshot,
    enforce_raw_contract,
    missing_metric_fields,
    validate_raw_contract,
)
from tillroll.operators.validation import (
    enforce_clean_quality_gates,
    gate_counts,
    schema_violations,
    validate_raw_sales_data,
    violating_rows,
)
from tillroll.schema import RAW_COLUMNS


def test_contract_accepts_a_valid_table(spark):
    assert validate_raw_contract(raw(spark, BASE)).is_valid


def test_contract_has_thirteen_columns(spark):
    snapshot = record(contract_snapshot(spark))
    assert len(snapshot["required_columns"]) == 13
    assert snapshot["required_columns"] == sorted(RAW_COLUMNS)
    assert snapshot["contract_version"] == "1.0.0"


def test_contract_names_missing_columns_sorted(spark):
    with pytest.raises(ValueError, match="missing: price, rating"):
        enforce_raw_contract(raw(spark, BASE).drop("rating", "price"))


def test_contract_joins_all_errors(spark):
    empty = raw(spark, BASE).where("false").drop("price")
    assert len(validate_raw_contract(empty).errors) == 2
    with pytest.raises(ValueError, match=r"price \| .*empty"):
        enforce_raw_contract(empty)


def test_dirty_rows_break_the_expected_rules(spark):
    broken = {
        row["rule"]: row["violations"]
        for row in schema_violations(raw(spark, DIRTY)).where("violations > 0").collect()
    }
    assert broken == {"price_ge_0": 1, "discount_percent_ge_0": 1, "quantity_sold_gt_0": 1}


def test_violating_rows_show_the_text(spark):
    found = set(values(violating_rows(raw(spark, DIRTY))))
    assert found == {
        ("2", "price_ge_0", "price", "-5.0"),
        ("3", "discount_percent_ge_0", "discount_percent", "-20"),
        ("3", "quantity_sold_gt_0", "quantity_sold", "0"),
    }


def test_type_and_null_rules(spark):
    lines = ["1,2024-01-15,10,,abc,10,2,,,x,50,90.0,180.0"]
    broken = schema_violations(raw(spark, lines)).where("violations > 0")
    names = {row["rule"] for row in broken.collect()}
    assert names == {"product_category_not_null", "price_numeric", "rating_numeric"}


def test_validation_raises_with_every_broken_rule(spark):
    with pytest.raises(ValueError, match="schema check.*price_ge_0.*quantity_sold_gt_0"):
        validate_raw_sales_data(raw(spark, DIRTY))
    good = raw(spark, BASE)
    assert validate_raw_sales_data(good) is good


def test_minimal_profile_looks_at_the_quantity_only(spark):
    table = raw(spark, DIRTY).drop("rating")
    assert values(schema_violations(table, "minimal")) == [
        ("quantity_sold_gt_0", "quantity_sold", 1)
    ]
    with pytest.raises(ValueError, match="missing: price"):
        schema_violations(table.drop("price"), "minimal")


def gate_frame(spark, **changes):
    row = {"discount_percent": 10.0, "rating": 4.5, "quantity_sold": 2.0, "price": 100.0}
    other = {"discount_percent": 20.0, "rating": 3.8, "quantity_sold": 1.0, "price": 50.0}
    columns = list(row)
    rows = [[{**row, **changes}[c] for c in columns], [other[c] for c in columns]]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns))


def test_gates_accept_valid_rows(spark):
    enforce_clean_quality_gates(gate_frame(spark))
    enforce_clean_quality_gates(gate_frame(spark, rating=None))


@pytest.mark.parametrize(
    ("column", "value"),
    [("discount_percent", 120.0), ("rating", 7.0), ("quantity_sold", 0.0), ("price", -1.0)],
)
def test_gates_name_the_column(spark, column, value):
    with pytest.raises(ValueError, match=column):
        enforce_clean_quality_gates(gate_frame(spark, **{column: value}))


def test_first_gate_wins_and_empty_fails(spark):
    both = gate_frame(spark, rating=7.0, price=-1.0)
    assert record(gate_counts(both))["price_negative"] == 1
    with pytest.raises(ValueError, match="rating"):
        enforce_clean_quality_gates(both)
    with pytest.raises(ValueError, match="empty"):
        enforce_clean_quality_gates(both.where("false"))


def test_cleaning_keeps_the_usable_row_only(spark):
    clean = clean_sales_data(raw(spark, DIRTY))
    rows = clean.collect()
    assert [row["order_id"] for row in rows] == [1.0]
    assert None not in tuple(rows[0])
    assert record(retention(raw(spark, DIRTY))) == {
        "raw_row_count": 3,
        "clean_row_count": 1,
        "rows_dropped": 2,
        "row_retention_rate": 1 / 3,
    }


def test_retention_of_an_empty_table(spark):
    assert record(retention(raw(spark, DIRTY).where("false")))["row_retention_rate"] == 0.0


def test_cleaning_needs_every_column(spark):
    with pytest.raises(ValueError, match="rating"):
        clean_sales_data(raw(spark, BASE).drop("rating"))


def test_cleaning_clips_and_recomputes(spark):
    lines = ["1,2024-01-15,10,Electronics,100.0,120,2,North,Card,7,50,90.0,180.0"]
    row = record(clean_sales_data(raw(spark, lines)))
    assert (row["discount_percent"], row["rating"]) == (100.0, 5.0)
    assert (row["discounted_price"], row["total_revenue"]) == (0.0, 0.0)


def test_cleaning_keeps_a_null_rating_and_a_zero_price(spark):
    lines = ["1,2024-01-15,10,Electronics,0,10,1,,,,50,,"]
    row = record(clean_sales_data(raw(spark, lines)))
    assert row["rating"] is None
    assert row["price"] == 0.0


def test_cleaning_keeps_integral_ids(spark):
    table = typed(spark, BASE).withColumn("order_id", F.lit(2**53 + 1))
    assert record(clean_sales_data(table))["order_id"] == 2**53 + 1


def test_date_format_is_an_argument(spark):
    lines = ["1,15/01/2024,10,Electronics,100.0,10,2,North,Card,4.8,50,90.0,180.0"]
    assert clean_sales_data(raw(spark, lines)).isEmpty()
    assert record(clean_sales_data(raw(spark, lines), "d/M/y"))["order_date"].month == 1


def test_metric_contract(spark):
    assert missing_metric_fields(spark.range(1).withColumnRenamed("id", "total_revenue")) == sorted(
        {
            "contract_version",
            "pipeline_version",
            "generated_at_utc",
            "gross_revenue",
            "north_star_nrr",
            "period_end",
            "period_start",
            "raw_row_count",
            "clean_row_count",
            "row_retention_rate",
            "rows_dropped",
        }
    )
