"""Pearson correlations of many columns from one small matrix of sums per task."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.coerce import quoted


def pairwise_correlations(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows ``(x, y, r)`` for every pair of columns, over the rows where both have a value.

    A batch of rows is a matrix; products of it with itself and with its mask of present values give
    counts, means, squared deviations and co-moments of all pairs at once. A task merges its batches,
    then hands on one row of sums per column, and these rows are merged by column: nothing else is
    shuffled, whatever the number of rows, and no row is spread into its pairs. Sums are taken about
    the means of the batch and merged by the differences of means, so that large values do not
    cancel. A column that does not vary over the rows of a pair gives null, and so does an infinite value.
    """
    names = list(names)
    d = len(names)
    doubles = [F.col(quoted(name)).cast("double") for name in names]
    rows = df.select(*[F.when(~F.isnan(v), v).alias(f"v{i}") for i, v in enumerate(doubles)])
    # Each of these is a matrix; "y_" marks what is known of the second column of a pair.
    parts = ["n", "x_mean", "y_mean", "x_squares", "y_squares", "products", "x_low", "x_high", "y_low", "y_high", "odd"]
    schema = "i long, " + ", ".join(f"{part} array<double>" for part in parts)

    def of_batch(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(np.float64)
        infinite = np.isinf(x)
        known = ~np.isnan(x) & ~infinite
        low = np.where(known, x, np.inf)
        high = np.where(known, x, -np.inf)
        # Of a pair: the extremes of the first column where the second has a value.
        lows, highs = (np.repeat(v[:, None], d, axis=1) for v in (low.min(axis=0), high.max(axis=0)))
        for j in np.flatnonzero(~known.all(axis=0)).tolist():
            lows[:, j] = low[known[:, j]].min(axis=0, initial=np.inf)
            highs[:, j] = high[known[:, j]].max(axis=0, initial=-np.inf)
        seen = known.sum(axis=0)
        centre = np.where(known, x, 0).sum(axis=0) / np.maximum(seen, 1)
        centred = np.where(known, x - centre, 0)
        mask = known.astype(np.float64)
        n = mask.T @ mask
        some = np.maximum(n, 1)
        sums = centred.T @ mask
        squares = np.maximum((centred**2).T @ mask - sums**2 / some, 0)
        either = infinite.astype(np.float64).T @ (known | infinite)
        means = sums / some + centre[:, None]
        return {
            "n": n, "x_mean": means, "y_mean": means.T, "x_squares": squares, "y_squares": squares.T,
            "products": centred.T @ centred - sums * sums.T / some, "x_low": lows, "x_high": highs,
            "y_low": lows.T, "y_high": highs.T, "odd": either + either.T,
        }

    def merged(a: dict[str, np.ndarray], b: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        n = a["n"] + b["n"]
        some = np.maximum(n, 1)
        share, weight = b["n"] / some, a["n"] * b["n"] / some
        x_step, y_step = b["x_mean"] - a["x_mean"], b["y_mean"] - a["y_mean"]
        return {
            "n": n, "x_mean": a["x_mean"] + x_step * share, "y_mean": a["y_mean"] + y_step * share,
            "x_squares": a["x_squares"] + b["x_squares"] + x_step**2 * weight,
            "y_squares": a["y_squares"] + b["y_squares"] + y_step**2 * weight,
            "products": a["products"] + b["products"] + x_step * y_step * weight,
            "x_low": np.minimum(a["x_low"], b["x_low"]), "x_high": np.maximum(a["x_high"], b["x_high"]),
            "y_low": np.minimum(a["y_low"], b["y_low"]), "y_high": np.maximum(a["y_high"], b["y_high"]),
            "odd": a["odd"] + b["odd"],
        }

    def sums_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if batch.num_rows:
                found = of_batch(batch)
                held = found if held is None else merged(held, found)
        if held is not None:
            columns = [pa.array(np.arange(d))]
            columns += [pa.array(list(held[part]), pa.list_(pa.float64())) for part in parts]
            yield pa.RecordBatch.from_arrays(columns, ["i", *parts])

    def row_of_matrix(table: pa.Table) -> pa.Table:
        held = None
        for row in range(table.num_rows):
            found = {part: table.column(part)[row].values.to_numpy() for part in parts}
            held = found if held is None else merged(held, found)
        varies = (held["x_low"] < held["x_high"]) & (held["y_low"] < held["y_high"]) & (held["odd"] == 0)
        spread = np.sqrt(held["x_squares"]) * np.sqrt(held["y_squares"])
        defined = varies & (spread > 0)
        r = np.clip(held["products"] / np.where(defined, spread, 1), -1, 1)
        x = names[table.column("i")[0].as_py()]
        return pa.table({"x": [x] * d, "y": names, "r": pa.array(r, mask=~defined)})

    summed = rows.mapInArrow(sums_of_task, schema)
    return summed.groupBy("i").applyInArrow(row_of_matrix, "x string, y string, r double")
