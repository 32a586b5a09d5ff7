from datetime import date, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from samples import record, values
from tillroll.operators import cube as cubes
from tillroll.operators.features import build_features, slice_sales
from tillroll.operators.kpis import slice_share, summarize_kpis
from tillroll.operators.totals import sales_totals
from tillroll.plans.slice_report import cube_report, slice_report, store_cube
from tillroll.sources.scratch import Scratch, shared_folder

SLICES = [
    {},
    {"start": date(2024, 1, 10), "end": date(2024, 2, 3)},
    {"region": "North", "category": "Home"},
    {"start": date(2024, 2, 1), "payment": "Pix", "region": "South"},
    {"region": "Nowhere"},
]


@pytest.fixture(scope="module")
def sales(spark):
    """Orders over several days, regions and categories; one order holds a third of the rows."""
    rng = np.random.default_rng(1)
    rows = []
    for i in range(600):
        order = 1 if i % 3 == 0 else int(rng.integers(2, 60))
        day = datetime(2024, 1, 1 + int(rng.integers(28))) if i % 2 else datetime(2024, 2, 1 + int(rng.integers(20)), 13)
        pick = lambda *names: names[int(rng.integers(len(names)))]
        rows.append(
            (None if i % 50 == 7 else order, None if i % 60 == 5 else day, 2, pick("Home", "Toys", None), 10.0, 5.0,
             float(rng.integers(1, 4)), pick("North", "South", "East"), pick("Card", "Pix", None),
             None if i % 9 == 0 else 4.0, 1.0, 9.5)
        )
    schema = (
        "order_id long, order_date timestamp_ntz, product_id long, product_category string, price double, "
        "discount_percent double, quantity_sold double, customer_region string, payment_method string, rating double, "
        "review_count double, discounted_price double"
    )
    table = spark.createDataFrame(rows, schema)
    return build_features(table.withColumn("total_revenue", F.col("discounted_price") * F.col("quantity_sold")))


@pytest.fixture(scope="module")
def cube(spark, sales, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("cube"))
    store_cube(sales, path)
    return cubes.read_cube(spark, path)


def close(rows):
    return sorted((tuple(pytest.approx(v) if isinstance(v, float) else v for v in row) for row in rows), key=str)


@pytest.mark.parametrize("bounds", SLICES)
def test_slices_equal_those_of_the_rows(sales, cube, bounds):
    rows = slice_sales(sales, **bounds)
    part = cubes.slice_cube(cube, **bounds)
    want = record(summarize_kpis(rows))
    got = record(summarize_kpis(part.cells, cubes.cube_overall(part)))
    assert got == {name: pytest.approx(value) for name, value in want.items()}
    assert record(cubes.cube_share(cube, **bounds)) == {
        name: pytest.approx(value) for name, value in record(slice_share(sales, **bounds)).items()
    }
    assert sorted(values(cubes.cube_totals(part)), key=str) == close(values(sales_totals(rows).select(cubes.cube_totals(part).columns)))


def test_the_report_needs_no_sales_rows(sales, cube, tmp_path):
    bounds = SLICES[1]
    want = slice_report(sales, str(tmp_path / "report"), **bounds)  # from the rows
    found = cube_report(cube, **bounds)
    for name, table in found.items():
        assert values(table) == [
            tuple(pytest.approx(v) if isinstance(v, float) else v for v in row) for row in values(want[name])
        ], name


def test_days_prune_the_stored_cube(cube):
    part = cubes.slice_cube(cube, **SLICES[1])
    for table in (part.cells, part.orders):
        assert "PartitionFilters: [isnotnull(year" in table._jdf.queryExecution().executedPlan().toString()


def test_cubes_of_nothing(spark, sales, tmp_path):
    empty = store_cube(sales.where("false"), str(tmp_path))
    assert record(cubes.cube_overall(empty))["total_orders"] == 0
    assert record(cubes.cube_share(empty)) == {
        "slice_revenue": 0, "slice_orders": 0, "revenue_share_pct": 0, "order_share_pct": 0,
    }


def test_scratch_tables(spark):
    scratch = Scratch(spark, "x")
    assert scratch.path.startswith(shared_folder(spark))
    assert scratch.keep(spark.range(3), "t").count() == 3


def test_no_bitmap_is_shuffled_or_sorted_while_it_is_made(spark, sales):
    plans = {}

    def keep(table, name):
        plans[name] = table._jdf.queryExecution().executedPlan().toString()
        return spark.createDataFrame(table.collect(), table.schema)

    cubes.build_cube(sales, keep)
    after = plans["orders"].split("partial_bitmap_construct_agg")[0]
    assert "Exchange" not in after and "Sort " not in after


def test_one_order_of_many_days_and_cells_is_counted_once(spark, tmp_path):
    """Also where its rows repeat, and where parts of a cell are null."""
    table = spark.range(900).select(
        F.lit(7).cast("long").alias("order_id"),
        F.when(F.col("id") % 10 > 0, F.timestamp_add("DAY", F.col("id") % 50, F.lit("2024-01-01").cast("timestamp_ntz"))).alias("order_date"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("c"), F.col("id") % 7)).alias("product_category"),
        F.lit("North").alias("customer_region"),
        F.lit(None).cast("string").alias("payment_method"),
        *[F.lit(1.0).alias(n) for n in ("price", "quantity_sold", "total_revenue", "rating", "gross_revenue", "discount_value")],
    )
    store_cube(table, str(tmp_path))
    found = cubes.cube_totals(cubes.read_cube(spark, str(tmp_path))).select("row_count", "total_orders").collect()
    assert sum(row.row_count for row in found) == 900 + 900 + 600 and {row.total_orders for row in found} == {1}
