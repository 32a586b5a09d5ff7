"""Column profile, exact quantiles, correlations, histogram and density curve."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.coerce import quoted
from tillroll.operators.correlation import pairwise_correlations

QUARTILES = (0.25, 0.5, 0.75)
#: Size of a sketch; it misses a rank by less than ``MARGIN`` of the rows in all but rare cases.
SKETCH_SIZE = 4096
MARGIN = 0.002
#: Ranks that are looked up in a sketch of the inside of a bracket.
SPREAD = [i / 500 for i in range(501)]
#: Bins that are found without being asked for, at most.
MOST_BINS = 10_000
#: Values of a bracket that are gathered at most, about.
GATHERED = 20_000
#: Values that stand for more, with weights, that a task hands on of a bracket.
POINTS = 2_000


def column_profile(df: DataFrame) -> DataFrame:
    """Name, type, non-null count and row count of each column, from one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(name).alias(f"_n{index}") for index, name in enumerate(df.columns)],
    )
    entries = [
        F.struct(
            F.lit(name).alias("column"),
            F.lit(kind).alias("type"),
            F.col(f"_n{index}").alias("non_null_count"),
            F.col("_rows").alias("row_count"),
        )
        for index, (name, kind) in enumerate(df.dtypes)
    ]
    return counts.select(F.inline(F.array(*entries)))


def numeric_columns(df: DataFrame) -> list[str]:
    return [field.name for field in df.schema if isinstance(field.dataType, T.NumericType)]


def timestamp_columns(df: DataFrame) -> list[str]:
    kinds = (T.TimestampType, T.TimestampNTZType, T.DateType)
    return [field.name for field in df.schema if isinstance(field.dataType, kinds)]


@dataclass
class _Rank:
    """The search for the value at one rank of a sorted column.

    The value lies between ``low`` and ``high``, both of which occur in the column; about
    ``inside`` values lie strictly between them.
    """

    column: int
    rank: int
    low: object
    high: object
    inside: float
    found: object = None


def _numbers(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The columns as doubles v0, v1, ..., without NaN."""
    doubles = {f"v{i}": F.col(quoted(name)).cast("double") for i, name in enumerate(names)}
    return df.select(*[F.when(~F.isnan(value), value).alias(name) for name, value in doubles.items()])


def _sketched(value: Column, kind: str, ranks: Sequence[float]) -> Column:
    """About the values at these ranks, from 0 to 1, out of a sketch of fixed size; null without values."""
    make = getattr(F, f"kll_sketch_agg_{kind}")
    cut = getattr(F, f"kll_sketch_get_quantile_{kind}")
    places = F.array(*[F.lit(float(rank)) for rank in ranks])
    return F.when(F.count(value) > 0, cut(make(value, F.lit(SKETCH_SIZE)), places))


def _around(rank: float) -> list[float]:
    return [max(rank - MARGIN, 0.0), min(rank + MARGIN, 1.0)]


def _first_scan(values: DataFrame, kind: str, quantiles: Sequence[float], exact: bool) -> list[dict]:
    """Moments of every column, and for each quantile the bracket it lies in or, inexact, its value."""
    ranks = [place for q in quantiles for place in (_around(q) if exact else [q])]
    record = []
    for name in values.columns:
        value = F.col(name)
        total = F.sum(value.cast("decimal(20,0)")) if kind == "bigint" else F.avg(value)
        facts = {
            "count": F.count(value),
            "mean": total,
            "std": F.stddev_samp(value),
            "min": F.min(value),
            "max": F.max(value),
            "cuts": _sketched(value, kind, ranks) if ranks else F.array(),
        }
        record.append(F.struct(*[fact.alias(key) for key, fact in facts.items()]).alias(name))
    row = values.agg(*record).first()
    return [row[name].asDict() for name in values.columns]


def _next_scan(values: DataFrame, kind: str, brackets: list[_Rank]) -> list[tuple]:
    """Per bracket: how many values lie below, on its ends and inside, and those inside, or cuts through them.

    A batch of a column is held against all its brackets at once; as expressions these would be some
    hundreds of functions a row. A task hands on one row per bracket, with the values inside or, where
    these would be more than ``GATHERED``, evenly chosen ones with weights. The rows of a bracket are
    merged, and one reaches the driver.
    """
    asked = [(f"v{b.column}", b.low, b.high, b.inside <= GATHERED) for b in brackets]
    names = list(dict.fromkeys(name for name, *_ in asked))
    dtype = np.int64 if kind == "bigint" else np.float64
    counted = ["below", "at", "inside", "end"]
    points, spread = POINTS, np.array(SPREAD)

    def thinned(shown: np.ndarray, weights: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Sorted; of more than ``most`` values the least, the greatest and others at even steps of weight."""
        order = np.argsort(shown)
        shown, weights = shown[order], weights[order]
        if len(shown) <= most:
            return shown, weights
        reached = np.cumsum(weights)
        ends = np.append(0, np.searchsorted(reached, reached[-1] * np.arange(1, most) / (most - 1)))
        ends = np.unique(np.minimum(ends, len(shown) - 1))
        return shown[ends], np.diff(reached[ends], prepend=0)

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(asked), len(counted)), np.int64)
        held = [[(np.empty(0, dtype), np.empty(0, np.int64))] for _ in asked]
        sizes = [0] * len(asked)

        def packed(number: int) -> None:
            parts = [np.concatenate(x) for x in zip(*held[number])]
            held[number] = [parts if asked[number][-1] else thinned(*parts, points)]
            sizes[number] = len(held[number][0][0])

        for batch in batches:
            columns = {name: batch.column(name).drop_null().to_numpy() for name in names}
            for number, (name, low, high, _) in enumerate(asked):
                value = columns[name]
                inside = value[(value > low) & (value < high)]
                found = [np.count_nonzero(value < low), np.count_nonzero(value == low), len(inside), np.count_nonzero(value == high)]
                counts[number] += found
                if len(inside):
                    held[number].append((inside, np.ones(len(inside), np.int64)))
                    sizes[number] += len(inside)
                if not asked[number][-1] and sizes[number] > 50 * points:
                    packed(number)
        for number in range(len(asked)):
            packed(number)
        shown, weights = ([list(part[0][place]) for part in held] for place in (0, 1))
        lists = [pa.array(shown, pa.list_(pa.from_numpy_dtype(dtype))), pa.array(weights, pa.list_(pa.int64()))]
        columns = [pa.array(np.arange(len(asked))), *[pa.array(x) for x in counts.T], *lists]
        yield pa.RecordBatch.from_arrays(columns, ["number", *counted, "shown", "weights"])

    def of_bracket(table: pa.Table) -> pa.Table:
        number = table.column("number")[0].as_py()
        sums = [[sum(table.column(name).to_pylist())] for name in counted]
        shown, weights = (table.column(name).combine_chunks().flatten().to_numpy() for name in ("shown", "weights"))
        shown, weights = thinned(shown, weights, len(shown))
        if not asked[number][-1] and len(shown):
            reached = np.cumsum(weights)
            shown = shown[np.minimum(np.searchsorted(reached, spread * reached[-1]), len(shown) - 1)]
        columns = [[number], *sums, pa.array([shown], pa.list_(pa.from_numpy_dtype(dtype)))]
        return pa.table(columns, ["number", *counted, "shown"])

    sums = "number long, " + ", ".join(f"{name} long" for name in counted) + f", shown array<{kind}>"
    parts = values.select(*names).mapInArrow(of_task, f"{sums}, weights array<long>")
    rows = {row["number"]: row for row in parts.groupBy("number").applyInArrow(of_bracket, sums).toArrow().to_pylist()}
    return [tuple(rows[number][name] for name in (*counted, "shown")) for number in range(len(asked))]


def _narrowed(rank: _Rank, scan: tuple, fact: dict) -> None:
    """Find the value of the rank in what a scan has shown, or a bracket that is sure to hold it."""
    below, at, inside, end, shown = scan
    if rank.low == rank.high:
        end = 0
    place = rank.rank - below
    if place <= 0:
        rank.low, rank.high, rank.inside = fact["min"], rank.low, below
    elif place <= at:
        rank.found = rank.low
    elif place <= at + inside:
        place -= at
        if rank.inside <= GATHERED:
            rank.found = sorted(shown)[place - 1]
        else:
            # The first cut and the last one are the least and the greatest value inside.
            low = [cut for part, cut in zip(SPREAD, shown) if part <= place / inside - MARGIN]
            high = [cut for part, cut in zip(SPREAD, shown) if part >= place / inside + MARGIN]
            rank.low, rank.high = (low or shown)[-1 if low else 0], (high or shown)[0 if high else -1]
            rank.inside = inside * (2 / (len(SPREAD) - 1) + 2 * MARGIN)
    elif place <= at + inside + end:
        rank.found = rank.high
    else:
        above = fact["count"] - below - at - inside - end
        rank.low, rank.high, rank.inside = rank.high, fact["max"], above


def _ranks_found(values: DataFrame, kind: str, facts: list[dict], quantiles: Sequence[float]) -> dict:
    """The values at the one or two ranks on which each quantile of each column lies."""
    searched: dict[tuple[int, int], _Rank] = {}
    for column, fact in enumerate(facts):
        for number, q in enumerate(quantiles if fact["count"] else ()):
            position = (fact["count"] - 1) * q
            low, high = fact["cuts"][2 * number : 2 * number + 2]
            for place in {math.floor(position), math.ceil(position)}:
                inside = fact["count"] * 2 * MARGIN
                rank = _Rank(column, place + 1, low, high, inside)
                searched.setdefault((column, place + 1), rank)
    while open_ := [rank for rank in searched.values() if rank.found is None]:
        shared = {(rank.column, rank.low, rank.high): rank for rank in open_}
        scans = dict(zip(shared, _next_scan(values, kind, list(shared.values()))))
        for rank in open_:
            # Of ranks with one bracket the last one said what was gathered.
            rank.inside = shared[rank.column, rank.low, rank.high].inside
        for rank in open_:
            _narrowed(rank, scans[rank.column, rank.low, rank.high], facts[rank.column])
    return {key: rank.found for key, rank in searched.items()}


def _interpolated(values: dict, column: int, count: int, quantile: float, integral: bool) -> object:
    """Between the two neighbours; of integers the lower one's distance is cut to whole steps."""
    position = (count - 1) * quantile
    low, high = (values[column, place + 1] for place in (math.floor(position), math.ceil(position)))
    if low == high:
        return low
    step = (high - low) * (position - math.floor(position))
    return low + (math.floor(step) if integral else step)


def quantile_name(quantile: float) -> str:
    return f"p{quantile * 100:g}".replace(".", "_")


def _described(
    values: DataFrame, names: Sequence[str], kind: str, quantiles: Sequence[float], approx: bool = False
) -> list[dict]:
    """Moments and quantiles of every column that has a value.

    A quantile sits at one or two ranks of the sorted column. The first scan takes the moments and a
    sketch of fixed size, which brackets these ranks; the second counts what lies below each bracket
    and on its ends, and gathers the few values inside. Where these would be more than ``GATHERED``
    (above some millions of rows), evenly chosen ones stand for them, and the bracket shrinks by two
    orders; where the rank lies outside, the bracket moves. Counts decide, so the result is exact. The
    first scan is one aggregate over whole columns, and the later ones hold batches against the brackets:
    nothing is shuffled but one buffer per task, or per bracket and task, and a row per bracket reaches
    the driver.
    """
    if not names:
        return []
    facts = _first_scan(values, kind, quantiles, not approx)
    ranks = {} if approx else _ranks_found(values, kind, facts, quantiles)
    out = []
    for column, (name, fact) in enumerate(zip(names, facts)):
        if fact["count"]:
            cuts = fact.pop("cuts")
            if not approx:
                cuts = [
                    _interpolated(ranks, column, fact["count"], q, kind == "bigint") for q in quantiles
                ]
            out.append({"column": name, **fact} | dict(zip(map(quantile_name, quantiles), cuts)))
    return out


def _checked_quantiles(quantiles: Sequence[float]) -> list[float]:
    wrong = [q for q in quantiles if not 0 <= q <= 1]
    if wrong:
        raise ValueError(f"quantiles must lie between 0 and 1: {wrong}")
    return list(dict.fromkeys(quantiles))


def describe_numeric(
    df: DataFrame, quantiles: Sequence[float] = QUARTILES, *, approx: bool = False
) -> DataFrame:
    """Count, mean, deviation, min, max and quantiles of every numeric column.

    Quantiles interpolate linearly between neighbours and are exact; ``approx`` takes them from the
    sketch alone, in one scan. The figures are computed when this is called (two scans of the table,
    three above some millions of rows); the result holds one row per column with a value.
    """
    names, quantiles = numeric_columns(df), _checked_quantiles(quantiles)
    rows = _described(_numbers(df, names), names, "double", quantiles, approx)
    shown = ["mean", "std", "min", "max", *map(quantile_name, quantiles)]
    schema = ", ".join(["column string", "count long", *[f"`{name}` double" for name in shown]])
    listed = [tuple(row[name] for name in ("column", "count", *shown)) for row in rows]
    return df.sparkSession.createDataFrame(listed, schema)


def describe_timestamps(df: DataFrame, quantiles: Sequence[float] = QUARTILES) -> DataFrame:
    """The same figures for date and time columns, as timestamps; a deviation is not given.

    Times are carried as whole microseconds, which are exact for every date; the mean comes from an
    exact sum and is cut to whole microseconds.
    """
    quantiles = _checked_quantiles(quantiles)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    names = timestamp_columns(df)
    micros = [
        F.timestamp_diff("MICROSECOND", epoch, F.col(quoted(name)).cast("timestamp_ntz")).alias(f"v{i}")
        for i, name in enumerate(names)
    ]
    shown = ["mean", "min", *map(quantile_name, quantiles), "max"]
    listed = []
    for row in _described(df.select(*micros), names, "bigint", quantiles):
        row["mean"] = int(row["mean"]) // row["count"]
        listed.append((row["column"], row["count"], *[row[name] for name in shown]))
    schema = ", ".join(["column string", "count long", *[f"`{name}` long" for name in shown]])
    found = df.sparkSession.createDataFrame(listed, schema)
    return found.withColumns({name: F.timestamp_add("MICROSECOND", name, epoch) for name in shown})


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair of numeric columns, over rows where both are present.

    Long form ``(x, y, r)``, both triangles and the diagonal; a constant column gives null, and so
    does a pair with an infinite value. A table without rows or numeric columns gives no rows.
    """
    names = list(columns) if columns is not None else numeric_columns(df)
    if not names:
        return df.sparkSession.createDataFrame([], "x string, y string, r double")
    return pairwise_correlations(df, names)


def automatic_bins(df: DataFrame, column: str) -> int:
    """The number of bins for the values of a column: the larger one of two rules.

    Freedman-Diaconis makes bins of width ``2 * IQR / n^(1/3)``, Sturges ``log2(n) + 1`` of them; the
    latter also holds where the quartiles coincide. A column that does not vary, or not finitely, has
    one bin, and no column more than ``MOST_BINS``. Quartiles are exact, from the scans of
    ``describe_numeric``.
    """
    found = _described(_numbers(df, [column]), [column], "double", (0.25, 0.75))
    if not found:
        return 1
    count, spread = found[0]["count"], found[0]["max"] - found[0]["min"]
    if not 0 < spread < math.inf:
        return 1
    width = 2 * (found[0]["p75"] - found[0]["p25"]) / count ** (1 / 3)
    by_width = spread / width if width > 0 else 0.0
    return math.ceil(min(max(by_width, math.log2(count) + 1), MOST_BINS))


def _binned(df: DataFrame, column: str, bins: int, *extra: Column) -> DataFrame:
    """Rows ``(bin, lo, hi, <extra>, n)``: counts per equal-width bin between the extremes.

    The limits and the ``extra`` statistics are one row, attached to every value.
    """
    present = df.select(F.col(column).cast("double").alias("value")).where(
        F.col("value").isNotNull() & ~F.isnan("value")
    )
    limits = present.agg(F.min("value").alias("lo"), F.max("value").alias("hi"), *extra)
    # width_bucket puts the maximum into a bin of its own, one past the last.
    bucket = F.least(F.width_bucket("value", "lo", "hi", F.lit(bins)), F.lit(bins).cast("bigint"))
    single = F.lit(1).cast("bigint")
    placed = present.crossJoin(limits).withColumn(
        "bin", F.when(F.col("lo") == F.col("hi"), single).otherwise(bucket)
    )
    return placed.groupBy("bin", *limits.columns).agg(F.count(F.lit(1)).alias("n"))


def histogram(df: DataFrame, column: str = "price", bins: int | None = None) -> DataFrame:
    """Equal-width bins ``(bin, low, high, n)``; the last one includes the maximum.

    Without a number of bins, ``automatic_bins`` finds it. Bins without values do not appear; a
    constant column has a single bin.
    """
    bins = automatic_bins(df, column) if bins is None else bins
    width = (F.col("hi") - F.col("lo")) / bins
    return (
        _binned(df, column, bins)
        .select(
            "bin",
            (F.col("lo") + width * (F.col("bin") - 1)).alias("low"),
            (F.col("lo") + width * F.col("bin")).alias("high"),
            "n",
        )
        .orderBy("bin")
    )


def density(
    df: DataFrame,
    column: str = "price",
    bins: int | None = None,
    points: int = 51,
    bandwidth: float | None = None,
) -> DataFrame:
    """Gaussian density ``(x, density)`` on an even grid from minimum to maximum.

    Evaluated on the histogram bins, so the kernel runs bins x points times and not once per
    row. Without a number of bins, ``automatic_bins`` finds it; without a bandwidth, it is the sample
    deviation times n^(-1/5). A column that does not vary gives no rows.
    """
    bins = automatic_bins(df, column) if bins is None else bins
    total, std = F.count("value").alias("total"), F.stddev_samp("value").alias("std")
    span = F.col("hi") - F.col("lo")
    scott = F.col("std") * F.pow(F.col("total").cast("double"), F.lit(-0.2))
    width = scott if bandwidth is None else F.when(F.col("std") > 0, F.lit(float(bandwidth)))
    centres = (
        _binned(df, column, bins, total, std)
        .withColumn("bandwidth", width)
        .where("bandwidth > 0")
        .withColumn("centre", F.col("lo") + span * (F.col("bin") - 0.5) / bins)
        .withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .withColumn("x", F.col("lo") + span / (points - 1) * F.col("point"))
    )
    distance = (F.col("x") - F.col("centre")) / F.col("bandwidth")
    kernel = F.col("n") * F.exp(-0.5 * distance * distance)
    norm = F.col("total") * F.col("bandwidth") * F.sqrt(2 * F.pi())
    return (
        centres.groupBy("point", "x")
        .agg(F.sum(kernel / norm).alias("density"))
        .select("x", "density")
        .orderBy("x")
    )


def basic_eda(df: DataFrame) -> dict[str, DataFrame]:
    """The exploratory profile of a sales table; the figures of the two summaries are computed at once."""
    return {
        "column_profile": column_profile(df),
        "numeric_describe": describe_numeric(df),
        "timestamp_describe": describe_timestamps(df),
        "correlation_matrix": correlation_matrix(df),
        "price_histogram": histogram(df, "price"),
        "price_density": density(df, "price"),
    }
