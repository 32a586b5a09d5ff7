"""Small building blocks for sums, ratios and long-form records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.coerce import quoted
from tillroll.schema import MONEY_COLUMNS

MONEY_TYPE = "decimal(28,6)"


def money_sum(value: Column | str) -> Column:
    """Sum as DOUBLE, 0 for no rows or only nulls.

    The input may be DOUBLE or DECIMAL (see ``exact_money``); a decimal sum is exact and does
    not depend on the order in which partitions are merged.
    """
    total = F.sum(F.col(value) if isinstance(value, str) else value)
    return F.coalesce(total.cast("double"), F.lit(0.0))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``, 0 where that is undefined, not a number or null."""
    quotient = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    return F.coalesce(a_number(quotient), F.lit(0.0))


def a_number(value: Column) -> Column:
    """The value, null where it is NaN (such as infinity less infinity)."""
    return F.when(~F.isnan(value.cast("double")), value)


def evaluated_once(df: DataFrame) -> DataFrame:
    """The same rows, with every column computed once per row however often later columns use it.

    Spark merges projections and filters that follow one another, and then computes a parsed value
    again wherever it is named, several times over in nested conditions. It does not look through a
    generator. All columns are computed, so this belongs where most of them are used.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(quoted(name)) for name in df.columns]))))


def deviation_or_zero(value: Column | str) -> Column:
    """Sample standard deviation, 0 for fewer than two values."""
    return F.coalesce(F.stddev_samp(value), F.lit(0.0))


def clip(value: Column, low: float | None = None, high: float | None = None) -> Column:
    """Limit to [low, high] and keep null (``greatest`` and ``least`` alone would drop it)."""
    bounded = value
    if low is not None:
        bounded = F.greatest(bounded, F.lit(low))
    if high is not None:
        bounded = F.least(bounded, F.lit(high))
    return F.when(value.isNotNull(), bounded)


def exact_money(df: DataFrame) -> DataFrame:
    """Carry the money columns as DECIMAL so that totals are reproducible to the last digit.

    Infinity, which no DECIMAL holds, becomes null; a finite amount that is too large, from 10^22 on,
    is an error.
    """
    present = [name for name in MONEY_COLUMNS if name in df.columns]
    return df.withColumns({name: _exact(F.col(name)) for name in present})


def _exact(value: Column) -> Column:
    exact = value.try_cast(MONEY_TYPE)
    finite = F.abs(value.cast("double")) < float("inf")
    lost = F.raise_error(F.concat(F.lit("Amount is too large for exact sums: "), value.cast("string")))
    return F.when(exact.isNull() & finite, lost.cast(MONEY_TYPE)).otherwise(exact)


def unpivot_record(
    record: DataFrame, fields: Sequence[tuple[str, str]], label: str, kind: str
) -> DataFrame:
    """Turn a one-row record into ``(label, value)`` rows; ``fields`` pairs row names and columns."""
    entries = F.array(
        *[
            F.struct(F.lit(name).alias(label), F.col(column).cast(kind).alias("value"))
            for name, column in fields
        ]
    )
    return record.select(F.inline(entries))
