"""Raw rows to clean rows: one narrow projection and filter, no shuffle."""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions import a_number, clip, evaluated_once, ratio_or_zero, to_moment, to_number
from tillroll.functions.coerce import ID_COLUMNS, ISO_DATE, whole_number
from tillroll.operators.contracts import require_columns
from tillroll.schema import MALFORMED, NUMBER_COLUMNS, PLACE


#: Limits that cleaning puts on values.
CLIPPED = {"discount_percent": (0.0, 100.0), "rating": (0.0, 5.0)}
#: Tells whether cleaning keeps a row.
MARK = "is_clean"


def coerce_types(
    df: DataFrame, date_format: str = ISO_DATE, integral: Collection[str] = ()
) -> DataFrame:
    """Parse the date and the numeric columns; what cannot be parsed becomes null.

    The date format is an argument, as are the text columns that hold whole numbers only, which
    become BIGINT (a DOUBLE would merge ids above 2**53). Both are facts of a whole column, which
    ``inspect_raw`` finds in one scan.
    """
    typed = {
        name: whole_number(F.col(name))
        if name in integral and isinstance(df.schema[name].dataType, T.StringType)
        else to_number(df, name, keep_integral=name in ID_COLUMNS)
        for name in NUMBER_COLUMNS
    }
    return df.withColumns({"order_date": to_moment(df, "order_date", date_format), **typed})


def usable_row(value: Callable[[str], Column] = F.col) -> Column:
    """True for a row that cleaning keeps; ``value`` gives the coerced value of a column."""
    # The comparisons are false for null as well.
    return (
        value("order_date").isNotNull()
        & value("discount_percent").isNotNull()
        & (value("quantity_sold") > 0)
        & (value("price") >= 0)
    )


def well_formed(df: DataFrame) -> DataFrame:
    """Without the lines that had too few or too many fields, whose values mean nothing."""
    df = df.drop(PLACE)
    if MALFORMED not in df.columns:
        return df
    return df.where(F.col(MALFORMED).isNull()).drop(MALFORMED)


def clean_sales_data(
    df: DataFrame, date_format: str = ISO_DATE, integral: Collection[str] = ()
) -> DataFrame:
    """Coerce, drop unusable rows, clip discount and rating, recompute price and revenue."""
    require_columns(df)
    return evaluated_once(_recomputed(coerce_types(well_formed(df), date_format, integral).where(usable_row())))


def _recomputed(df: DataFrame) -> DataFrame:
    """Clipped values, and price and revenue as they follow from these."""
    return (
        df.withColumns({name: clip(F.col(name), *limits) for name, limits in CLIPPED.items() if name in df.columns})
        .withColumn(
            "discounted_price", a_number(F.col("price") * (1 - F.col("discount_percent") / 100))
        )
        .withColumn(
            "total_revenue", a_number(F.col("discounted_price") * F.col("quantity_sold"))
        )
    )


def marked_sales_data(
    df: DataFrame, *columns: str, date_format: str = ISO_DATE, integral: Collection[str] = ()
) -> DataFrame:
    """Every raw row: as ``clean_sales_data`` leaves it, or with nulls only where that drops it.

    ``is_clean`` tells the two apart, so that one pass over the rows can count both tables. Of the
    columns there are those that revenue is made of, and the named ones; the others are not parsed.
    """
    require_columns(df)
    whole = F.col(MALFORMED).isNull() if MALFORMED in df.columns else F.lit(True)
    names = list(dict.fromkeys([*columns, "order_date", "price", "discount_percent", "quantity_sold"]))
    rows = evaluated_once(coerce_types(df, date_format, integral).select(*names, whole.alias(MARK)))
    rows = rows.withColumn(MARK, F.coalesce(F.col(MARK) & usable_row(), F.lit(False)))
    return _recomputed(rows.withColumns({name: F.when(F.col(MARK), F.col(name)) for name in names}))


def row_accounting(raw_rows: Column, clean_rows: Column) -> dict[str, Column]:
    """Counts before and after cleaning, rows dropped and the share that was kept."""
    return {
        "raw_row_count": raw_rows,
        "clean_row_count": clean_rows,
        "rows_dropped": raw_rows - clean_rows,
        "row_retention_rate": ratio_or_zero(clean_rows, raw_rows),
    }


def retention(raw: DataFrame, date_format: str = ISO_DATE) -> DataFrame:
    """Row accounting of cleaning ``raw``, counted in one scan of the raw table."""
    require_columns(raw)
    whole = F.col(MALFORMED).isNull() if MALFORMED in raw.columns else F.lit(True)
    counted = coerce_types(raw, date_format).agg(
        F.count(F.lit(1)).alias("raw_rows"), F.count_if(whole & usable_row()).alias("clean_rows")
    )
    parts = row_accounting(F.col("raw_rows"), F.col("clean_rows"))
    return counted.select(*[column.alias(name) for name, column in parts.items()])
