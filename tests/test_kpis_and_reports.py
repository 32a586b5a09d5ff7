from datetime import UTC, date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from samples import API, BASE, DIRTY, METRICS, TABLES, featured, raw, record, typed, values
from tillroll.functions import exact_money
from tillroll.operators import kpis, reports
from tillroll.operators.cleaning import clean_sales_data, marked_sales_data, retention
from tillroll.operators.contracts import missing_metric_fields
from tillroll.operators.totals import overall_part, sales_totals
from tillroll.schema import MALFORMED

NULL_KEY = "9,2024-02-20,10,,50.0,0,1,,,3.0,5,50.0,50.0"


def impact_rows(spark):
    return spark.createDataFrame(
        [(100.0, 2.0, 180.0, 200.0), (50.0, 1.0, 40.0, 50.0)],
        "price double, quantity_sold double, total_revenue double, gross_revenue double",
    )


def test_business_impact(spark):
    expected = {
        "total_revenue": 220.0,
        "gross_revenue": 250.0,
        "discount_leakage": 30.0,
        "retained_ratio": 0.88,
        "expected_uplift": 3.0,
    }
    assert record(kpis.calculate_business_impact(impact_rows(spark), 0.1)) == expected
    derived = impact_rows(spark).drop("gross_revenue")
    assert record(kpis.calculate_business_impact(derived, 0.1)) == expected


def test_executive_summary(spark):
    assert values(kpis.build_executive_summary(impact_rows(spark))) == [
        ("north_star_net_revenue_retained", 0.88),
        ("total_revenue", 220.0),
        ("gross_revenue", 250.0),
        ("discount_leakage", 30.0),
        ("expected_uplift_5pct_recovery", 1.5),
    ]


def test_kpis_of_an_empty_table_are_zero(spark):
    empty = featured(spark, TABLES).where("false")
    zero = dict.fromkeys(
        ["total_revenue", "total_orders", "total_units", "avg_ticket", "avg_rating"], 0
    )
    assert record(kpis.summarize_kpis(empty)) == {**zero, "net_revenue_retained": 0.0}
    stored = overall_part(sales_totals(empty))
    assert record(kpis.summarize_kpis(empty, stored)) == {**zero, "net_revenue_retained": 0.0}
    assert record(kpis.calculate_business_impact(empty))["retained_ratio"] == 0.0


def test_kpi_record_and_its_long_form(spark):
    table = featured(spark, TABLES)
    row = record(kpis.summarize_kpis(table))
    assert row["total_revenue"] == 504.0
    assert row["net_revenue_retained"] == 0.9
    long = dict(values(kpis.kpi_summary(table)))
    assert long == {
        "total_revenue": 504.0,
        "total_orders": 3.0,
        "total_units": 6.0,
        "avg_ticket": 168.0,
        "avg_rating": pytest.approx(4.5),
        "north_star_nrr": 0.9,
    }


def test_units_are_cut_in_the_long_form_only(spark):
    table = featured(spark, BASE).withColumn("quantity_sold", F.lit(2.9))
    assert record(kpis.summarize_kpis(table))["total_units"] == 2.9
    assert dict(values(kpis.kpi_summary(table)))["total_units"] == 2.0


def test_orders_are_distinct_and_null_ids_do_not_count(spark):
    lines = [*TABLES, "1,2024-03-01,1,Home,1,0,1,North,Card,1,1,1,1", ",2024-03-01,1,Home,1,0,1,North,Card,1,1,1,1"]
    table = featured(spark, lines)
    assert record(kpis.summarize_kpis(table))["total_orders"] == 3
    home = {r["product_category"]: r["total_orders"] for r in reports.category_performance(table).collect()}
    assert home == {"Electronics": 2, "Home": 2}


def test_metrics_summary(spark):
    assert record(kpis.metrics_summary(featured(spark, API))) == {
        "total_revenue": 250.0,
        "gross_revenue": 300.0,
        "discount_leakage": 50.0,
        "north_star_nrr": pytest.approx(250 / 300),
        "total_orders": 2,
        "avg_ticket": 125.0,
    }


@pytest.mark.parametrize("stored", [False, True])
def test_product_metrics(spark, stored):
    rows = raw(spark, METRICS)
    clean = typed(spark, METRICS)
    table = featured(spark, METRICS)
    moment = datetime(2024, 3, 1, tzinfo=UTC)
    metrics = kpis.collect_product_metrics(
        2 if stored else rows,
        2 if stored else clean,
        table,
        contract_version="1.0.0",
        pipeline_version="test",
        generated_at=moment,
        totals=sales_totals(table) if stored else None,
    )
    assert missing_metric_fields(metrics) == []
    assert record(metrics) == {
        "metrics_version": "1.0.0",
        "contract_version": "1.0.0",
        "pipeline_version": "test",
        "generated_at_utc": moment.isoformat(),
        "raw_row_count": 2,
        "clean_row_count": 2,
        "rows_dropped": 0,
        "row_retention_rate": 1.0,
        "total_revenue": 220.0,
        "gross_revenue": 250.0,
        "discount_leakage": 30.0,
        "north_star_nrr": 0.88,
        "unique_orders": 2,
        "unique_categories": 2,
        "period_start": "2024-01-15",
        "period_end": "2024-01-20",
    }


def test_product_metrics_without_rows(spark):
    empty = featured(spark, METRICS).where("false")
    row = record(kpis.collect_product_metrics(0, 0, empty))
    assert (row["period_start"], row["period_end"]) == ("", "")
    assert (row["row_retention_rate"], row["north_star_nrr"]) == (0.0, 0.0)


@pytest.mark.parametrize("stored", [False, True])
def test_six_tables(spark, stored):
    table = featured(spark, TABLES)
    tables = reports.build_executive_tables(table, sales_totals(table) if stored else None)
    assert list(tables) == [
        "kpi_summary",
        "category_performance",
        "regional_performance",
        "payment_performance",
        "monthly_trend",
        "data_quality_audit",
    ]
    assert len(values(tables["kpi_summary"])) == 6
    category = tables["category_performance"]
    assert category.columns == [
        "product_category",
        "total_revenue",
        "total_units",
        "total_orders",
        "avg_rating",
        "discount_value",
    ]
    assert values(category) == [
        ("Electronics", 408.0, 5.0, 2, pytest.approx(4.7), 32.0),
        ("Home", 96.0, 1.0, 1, 4.1, 24.0),
    ]
    assert values(tables["regional_performance"]) == [
        ("North", 408.0, 2, 204.0),
        ("South", 96.0, 1, 96.0),
    ]
    assert values(tables["payment_performance"]) == [("Card", 408.0, 2, 204.0), ("Pix", 96.0, 1, 96.0)]
    assert values(tables["monthly_trend"]) == [(date(2024, 1, 31), 180.0), (date(2024, 2, 29), 324.0)]
    assert values(tables["data_quality_audit"]) == [
        ("row_count", 3),
        ("null_values", 0),
        ("duplicated_order_id", 0),
        ("discount_out_of_range", 0),
        ("rating_out_of_range", 0),
    ]


@pytest.mark.parametrize("stored", [False, True])
def test_null_keys_count_in_the_kpis_only(spark, stored):
    table = featured(spark, [*TABLES, NULL_KEY])
    totals = sales_totals(table) if stored else None
    tables = reports.build_executive_tables(table, totals)
    assert dict(values(tables["kpi_summary"]))["total_revenue"] == 554.0
    for name in ("category_performance", "regional_performance", "payment_performance"):
        assert len(values(tables[name])) == 2
    assert dict(values(tables["data_quality_audit"]))["null_values"] == 3


def test_equal_revenue_is_ordered_by_key(spark):
    lines = [f"{i},2024-01-01,1,{c},10,0,1,R,P,1,1,10,10" for i, c in enumerate("CAB")]
    assert [r[0] for r in values(reports.category_performance(featured(spark, lines)))] == list("ABC")


def test_audit_counts_repeated_and_null_ids(spark):
    lines = [f"{i},2024-01-01,1,A,10,{d},1,R,P,{r},1,10,10" for i, d, r in
             [("1", 0, 1), ("1", 120, 1), ("", 0, 7), ("", -1, "")]]
    audit = dict(values(reports.data_quality_audit(typed(spark, lines))))
    assert audit == {
        "row_count": 4,
        "null_values": 3,
        "duplicated_order_id": 2,
        "discount_out_of_range": 2,
        "rating_out_of_range": 1,
    }


def test_audit_of_an_empty_table(spark):
    audit = dict(values(reports.data_quality_audit(typed(spark, TABLES).where("false"))))
    assert set(audit.values()) == {0}


def test_trends_with_a_gap(spark):
    lines = ["1,2024-01-15,1,A,1,0,1,R,P,1,1,1,1", "2,2024-04-10,1,A,2,0,1,R,P,1,1,2,2"]
    table = typed(spark, lines)
    assert values(reports.monthly_trend(table)) == [
        (date(2024, 1, 31), 1.0),
        (date(2024, 2, 29), 0.0),
        (date(2024, 3, 31), 0.0),
        (date(2024, 4, 30), 2.0),
    ]
    assert values(reports.sales_trend_over_time(table)) == [
        (date(2024, 1, 1), 1.0),
        (date(2024, 4, 1), 2.0),
    ]


def test_trends_ignore_null_dates_and_empty_input(spark):
    table = typed(spark, TABLES)
    undated = table.withColumn("order_date", F.lit(None).cast("timestamp_ntz"))
    assert values(reports.monthly_trend(undated)) == []
    assert values(reports.sales_trend_over_time(undated)) == []
    assert len(values(reports.monthly_trend(table.union(undated)))) == 2


def test_opportunities_and_top_categories(spark):
    table = featured(spark, TABLES)
    assert values(reports.rank_discount_opportunities(table)) == [
        ("Electronics", 408.0, 32.0, pytest.approx(0.0784313725490196)),
        ("Home", 96.0, 24.0, 0.25),
    ]
    assert values(reports.rank_discount_opportunities(table, 1))[0][0] == "Electronics"
    assert values(reports.top_categories_by_sales(table, 2)) == [("Electronics", 408.0), ("Home", 96.0)]
    free = table.withColumn("total_revenue", F.lit(0.0))
    assert {r[3] for r in values(reports.rank_discount_opportunities(free))} == {0.0}


def test_revenue_and_ticket_rankings(spark):
    table = featured(spark, TABLES)
    assert values(reports.revenue_by(table, "customer_region")) == [("North", 408.0), ("South", 96.0)]
    assert values(reports.payment_ticket_ranking(table)) == [("Pix", 96.0, 96.0), ("Card", 204.0, 408.0)]
    assert values(reports.leakage_by_category(table))[1] == ("Home", 120.0, 96.0, 24.0)


def test_share_of_total(spark):
    table = featured(spark, [*TABLES, "1,2024-01-16,1,Home,10,0,1,South,Card,1,1,10,10"])
    row = record(kpis.slice_share(table, region="South"))
    assert row["slice_revenue"] == 106.0
    assert row["slice_orders"] == 2
    assert row["revenue_share_pct"] == pytest.approx(106 / 514 * 100)
    assert row["order_share_pct"] == pytest.approx(2 / 3 * 100)
    none = record(kpis.slice_share(table.where("false"), region="South"))
    assert (none["revenue_share_pct"], none["order_share_pct"]) == (0.0, 0.0)


def test_exact_money_gives_the_same_reports(spark):
    table = featured(spark, TABLES)
    exact = exact_money(table)
    assert dict(exact.dtypes)["total_revenue"] == "decimal(28,6)"
    assert values(reports.category_performance(exact)) == values(reports.category_performance(table))
    assert record(kpis.summarize_kpis(exact)) == record(kpis.summarize_kpis(table))


def test_exact_money_is_wide_and_fails_on_overflow(spark):
    rows = spark.createDataFrame([(1e15,), (float("inf"),), (None,), (-2.5,)], "total_revenue double")
    assert [r[0] for r in exact_money(rows).collect()] == [10**15, None, None, Decimal("-2.5")]
    with pytest.raises(Exception, match="too large"):
        exact_money(spark.createDataFrame([(1e23,)], "total_revenue double")).collect()


def test_totals_of_orders_without_id_and_with_several_keys(spark):
    """One order in two regions counts in both and once overall; a region without order ids has none."""
    rows = [(1, "A", "North", "Card"), (1, "A", "South", None), (2, "B", "South", "Card"), (None, "A", "East", "Card")]
    names = "order_id long, product_category string, customer_region string, payment_method string"
    table = spark.createDataFrame([row + (1.0, 1.0, 1.0, 1.0, 0.0) for row in rows], names + (
        ", total_revenue double, quantity_sold double, price double, gross_revenue double, discount_value double"
    ))
    found = sales_totals(table, "row_count", "total_orders")
    assert sorted(map(tuple, found.collect()), key=str) == sorted(
        [("overall", None, 4, 2), ("product_category", "A", 3, 1), ("product_category", "B", 1, 1),
         ("customer_region", "North", 1, 1), ("customer_region", "South", 2, 2), ("customer_region", "East", 1, 0),
         ("payment_method", "Card", 3, 2)], key=str,
    )


def test_product_metrics_of_raw_rows_in_one_pass(spark):
    """As from the cleaned rows, where dropped rows have dates, categories, orders and amounts of their own."""
    lines = [
        *TABLES, *DIRTY, ",2024-03-05,1,Home,10,0,1,North,Card,1,1,1,1",
        "8,2031-01-01,9,Toys,1e30,0,-1,North,Card,1,1,1,1",
        "9,1999-01-01,9,Garden,5,N/A,1,North,Card,1,1,1,1",
    ]
    for rows in (raw(spark, lines), raw(spark, lines).where("false")):
        clean = exact_money(featured_of(rows))
        moment = datetime(2024, 3, 1, tzinfo=UTC)
        want = record(kpis.collect_product_metrics(retention(rows), None, clean, generated_at=moment))
        marked = exact_money(kpis.ensure_revenue_columns(marked_sales_data(rows, "order_id", "product_category")))
        assert record(kpis.marked_product_metrics(marked, generated_at=moment)) == want
    assert want["raw_row_count"] == 0


def featured_of(rows):
    return kpis.ensure_revenue_columns(clean_sales_data(rows))


def test_malformed_rows_count_as_raw_rows_only(spark):
    rows = raw(spark, BASE).withColumn(MALFORMED, F.lit(None).cast("string"))
    rows = rows.unionByName(rows.withColumn(MALFORMED, F.lit("a,b")))
    row = record(kpis.marked_product_metrics(marked_sales_data(rows, "order_id", "product_category")))
    assert (row["raw_row_count"], row["clean_row_count"], row["total_revenue"]) == (2, 1, 180.0)
