"""Small hand-written sales tables."""

from pyspark.sql import functions as F

from tillroll.operators.features import build_features
from tillroll.schema import RAW_COLUMNS

BASE = ["1,2024-01-15,10,Electronics,100.0,10,2,North,Card,4.8,50,90.0,180.0"]
DIRTY = [
    *BASE,
    "2,invalid,11,Home,-5.0,5,1,South,Pix,3.7,7,4.75,4.75",
    "3,2024-01-17,12,Books,50.0,-20,0,West,Boleto,2.0,3,40.0,0.0",
]
METRICS = [*BASE, "2,2024-01-20,11,Beauty,50.0,20,1,South,Pix,4.2,8,40.0,40.0"]
TABLES = [
    *BASE,
    "2,2024-02-10,11,Home,120.0,20,1,South,Pix,4.1,20,96.0,96.0",
    "3,2024-02-18,12,Electronics,80.0,5,3,North,Card,4.6,15,76.0,228.0",
]
SCENARIO = [
    *BASE,
    "2,2024-01-20,11,Beauty,200.0,20,1,South,Pix,4.4,20,160.0,160.0",
    "3,2024-01-30,12,Electronics,80.0,5,3,North,Card,4.6,15,76.0,228.0",
]
DECISION = [
    *BASE,
    "2,2024-01-20,11,Home,120.0,20,1,South,Pix,4.1,20,96.0,96.0",
    "3,2024-02-10,12,Electronics,80.0,5,3,North,Card,4.6,15,76.0,228.0",
    "4,2024-02-18,13,Beauty,150.0,25,2,West,Boleto,4.4,30,112.5,225.0",
]
API = [
    "1,2024-01-01,10,Beauty,100.0,10.0,1,North,Card,4.8,10,90.0,90.0",
    "2,2024-01-02,11,Electronics,200.0,20.0,1,South,Pix,4.6,20,160.0,160.0",
]


def raw(spark, lines):
    """The lines as an all-text raw table; an empty cell is null."""
    rows = [[cell or None for cell in line.split(",")] for line in lines]
    return spark.createDataFrame(rows, ", ".join(f"{name} string" for name in RAW_COLUMNS))


def typed(spark, lines):
    """The lines with clean types but with the values as given."""
    table = raw(spark, lines)
    text = {"product_category", "customer_region", "payment_method"}
    return table.select(
        *[
            F.col(name)
            if name in text
            else F.col(name).cast("timestamp_ntz" if name == "order_date" else "double").alias(name)
            for name in RAW_COLUMNS
        ]
    )


def featured(spark, lines):
    return build_features(typed(spark, lines))


def discount_days(spark, discounts, category="Electronics", gross=200.0):
    """One row per day from 2024-01-01 with the given discounts."""
    rows = [(f"2024-01-{day:02d}", category, float(d), gross) for day, d in enumerate(discounts, 1)]
    table = spark.createDataFrame(
        rows,
        "day string, product_category string, discount_percent double, gross_revenue double",
    )
    return table.select(
        F.col("day").cast("timestamp_ntz").alias("order_date"),
        "product_category",
        "discount_percent",
        "gross_revenue",
        F.lit(100.0).alias("price"),
        F.lit(2.0).alias("quantity_sold"),
        F.lit(180.0).alias("total_revenue"),
    )


def values(df):
    return [tuple(row) for row in df.collect()]


def record(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()
