"""Null-on-failure conversions. All are native expressions and safe under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.schema import MALFORMED, MISSING_TOKENS

# Spark's own cast also takes "1d", "1f" and "NaN"; a price of NaN would pass "> 0".
NUMBER_PATTERN = r"^\s*[+-]?(([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf(inity)?))\s*$"

ISO_DATE = "y-M-d"
#: Formats a column of dates is tried against where none is named; the first is the usual one.
DATE_FORMATS = [
    ISO_DATE,
    "yyyy/M/d",
    "d/M/yyyy",
    "M/d/yyyy",
    "d-M-yyyy",
    "M-d-yyyy",
    "d.M.yyyy",
    "yyyy-M-d H:m:s",
    "yyyy-M-d'T'H:m:s",
]
#: Pairs of them that read some dates in two ways.
SWAPPED_FORMATS = [("d/M/yyyy", "M/d/yyyy"), ("d-M-yyyy", "M-d-yyyy")]

ID_COLUMNS = ["order_id", "product_id"]
WHOLE_PATTERN = r"^\s*[+-]?[0-9]+\s*$"


def quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def blank_missing(df: DataFrame) -> DataFrame:
    """Null out the missing-value tokens in every text column."""
    blanked = {
        field.name: F.when(~df[quoted(field.name)].isin(MISSING_TOKENS), df[quoted(field.name)])
        for field in df.schema
        if isinstance(field.dataType, T.StringType) and field.name != MALFORMED
    }
    return df.withColumns(blanked) if blanked else df


def to_number(df: DataFrame, name: str, keep_integral: bool = False) -> Column:
    """The column as DOUBLE, null where it is not a number. NaN counts as null.

    ``keep_integral`` leaves integral ids as they are, since DOUBLE is exact only up to 2**53.
    """
    column, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return F.when(column.rlike(NUMBER_PATTERN), column.try_cast("double"))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(column), column.cast("double"))
    if keep_integral and isinstance(kind, T.IntegralType):
        return column
    return column.cast("double")


def whole_number(column: Column) -> Column:
    """The text as BIGINT, null where it is not a whole number that fits."""
    return F.when(column.rlike(WHOLE_PATTERN), column.try_cast("bigint"))


def to_moment(df: DataFrame, name: str, date_format: str = ISO_DATE) -> Column:
    """The column as a zone-less timestamp, null where the text does not follow the format."""
    column, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, T.TimestampNTZType):
        return column
    if isinstance(kind, T.StringType):
        column = F.try_to_timestamp(column, F.lit(date_format))
    return column.cast("timestamp_ntz")
