import pytest
from pyspark.sql import functions as F

from samples import DECISION, SCENARIO, featured, record, values
from tillroll.operators.recommendations import build_actionable_recommendations
from tillroll.operators.recovery import (
    check_default_rate,
    rates_table,
    recovery_display,
    recovery_rates,
    recovery_totals,
    simulate_leakage_recovery,
)
from tillroll.operators.totals import sales_totals


@pytest.mark.parametrize("stored", [False, True])
def test_decision_fixture(spark, stored):
    table = featured(spark, DECISION)
    recommendations = build_actionable_recommendations(
        table, totals=sales_totals(table) if stored else None
    )
    assert recommendations.columns == [
        "priority",
        "decision_rule",
        "recommended_action",
        "expected_impact_usd",
        "owner_area",
    ]
    rows = [(r[0], r[1], pytest.approx(r[3]), r[4]) for r in values(recommendations)]
    assert rows == [
        ("high", "NRR below 90%", 6.55, "Revenue Operations"),
        ("high", "Highest leakage category is Beauty", 3.75, "Category Management"),
        ("medium", "Lowest average ticket on Pix", 7.29, "Commercial Strategy"),
    ]
    actions = [row[2] for row in values(recommendations)]
    assert actions[1] == (
        "Run a 2-week pricing policy test in Beauty with tighter discount thresholds."
    )


def test_empty_table_fires_the_first_rule_only(spark):
    rows = values(build_actionable_recommendations(featured(spark, DECISION).where("false")))
    assert [(row[1], row[3]) for row in rows] == [("NRR below 90%", 0.0)]


def test_no_rule_fires(spark):
    blank = F.lit(None).cast("string")
    table = featured(spark, DECISION).withColumns(
        {
            "product_category": blank,
            "payment_method": blank,
            "total_revenue": F.col("gross_revenue"),
            "discount_value": F.lit(0.0),
        }
    )
    assert [(r[0], r[1], r[3], r[4]) for r in values(build_actionable_recommendations(table))] == [
        ("low", "No material risk detected", 0.0, "Analytics")
    ]


def test_thresholds_are_arguments(spark):
    table = featured(spark, DECISION)
    rules = [r[1] for r in values(build_actionable_recommendations(table, nrr_floor=0.5))]
    assert rules == ["Highest leakage category is Beauty", "Lowest average ticket on Pix"]
    doubled = values(build_actionable_recommendations(table, recovery=0.1, ticket_uplift=0.02))
    assert [r[3] for r in doubled] == [pytest.approx(v) for v in (13.1, 7.5, 14.58)]


def test_ties_take_the_smallest_key(spark):
    lines = [f"{i},2024-01-01,1,{c},10,50,1,R,{p},1,1,5,5" for i, (c, p) in enumerate(["BY", "AX"])]
    rules = [r[1] for r in values(build_actionable_recommendations(featured(spark, lines)))]
    assert "Highest leakage category is A" in rules
    assert "Lowest average ticket on X" in rules


RATES = {"Electronics": 0.2, "Beauty": 0.1}


def test_scenario_fixture(spark):
    breakdown = simulate_leakage_recovery(featured(spark, SCENARIO), RATES)
    assert breakdown.columns == [
        "product_category",
        "gross_revenue",
        "total_revenue",
        "discount_leakage",
        "recovery_rate",
        "expected_uplift",
        "simulated_revenue",
    ]
    assert values(breakdown) == [
        ("Beauty", 200.0, 160.0, 40.0, 0.1, 4.0, 164.0),
        ("Electronics", 440.0, 408.0, 32.0, 0.2, pytest.approx(6.4), pytest.approx(414.4)),
    ]
    assert record(recovery_totals(breakdown)) == {
        "baseline_revenue": 568.0,
        "gross_revenue": 640.0,
        "baseline_nrr": 0.8875,
        "simulated_revenue": pytest.approx(578.4),
        "simulated_nrr": pytest.approx(0.90375),
        "total_uplift": pytest.approx(10.4),
    }
    assert values(recovery_display(breakdown))[0] == ("Beauty", 40.0, 10.0, 4.0, 164.0)


def test_rates_are_limited_and_default_to_zero(spark):
    table = featured(spark, SCENARIO)
    rates = rates_table(spark, {"Electronics": -0.1, "Beauty": 1.5})
    found = {r["product_category"]: r["recovery_rate"] for r in simulate_leakage_recovery(table, rates).collect()}
    assert found == {"Electronics": 0.0, "Beauty": 1.0}
    none = simulate_leakage_recovery(table, {})
    assert {r["recovery_rate"] for r in none.collect()} == {0.0}


def test_totals_of_an_empty_table(spark):
    empty = simulate_leakage_recovery(featured(spark, SCENARIO).where("false"), RATES)
    assert set(record(recovery_totals(empty)).values()) == {0.0}


def test_rates_for_every_category(spark):
    table = featured(spark, SCENARIO)
    overrides = {"Beauty": 1.7, "Absent": 0.3}
    assert sorted(values(recovery_rates(table, 0.05, overrides))) == [
        ("Beauty", 1.7),
        ("Electronics", 0.05),
    ]
    assert sorted(values(recovery_rates(table, 0.05))) == [("Beauty", 0.05), ("Electronics", 0.05)]


@pytest.mark.parametrize("rate", [-0.01, 1.01])
def test_default_rate_must_be_a_share(spark, rate):
    with pytest.raises(ValueError, match="between 0 and 1"):
        check_default_rate(rate)
    with pytest.raises(ValueError, match="between 0 and 1"):
        recovery_rates(featured(spark, SCENARIO), rate)


def test_repeated_and_undefined_rates_are_refused(spark):
    rows = featured(spark, SCENARIO)
    fields = "product_category string, recovery_rate double"
    twice = spark.createDataFrame([("Beauty", 0.1), ("Beauty", 0.2)], fields)
    with pytest.raises(Exception, match="Several recovery rates for category Beauty"):
        simulate_leakage_recovery(rows, twice).collect()
    undefined = spark.createDataFrame([("Beauty", float("nan"))], fields)
    with pytest.raises(Exception, match="NaN for category Beauty"):
        recovery_rates(rows, 0.05, undefined).collect()


def test_no_rows_no_rules_but_the_first(spark):
    rows = featured(spark, DECISION).where("false")
    found = [(r["decision_rule"], r["expected_impact_usd"]) for r in build_actionable_recommendations(rows).collect()]
    assert found == [("NRR below 90%", 0.0)]
