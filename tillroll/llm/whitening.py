"""Embedding whitening by shifted CholeskyQR.

1. Every vector becomes a vector of integers; the fit list holds each distinct one once. Its counts
   and sums are exact, and so are the centred rows up to one division.
2. The centred rows are orthogonalised in passes over the stored fit list. A pass adds up the Gram
   matrix of the rows as the factors found so far leave them (one triangular solve per factor) and
   factors it: ``Gram + shift = R^T R``. The first shift keeps the factor defined for ill-conditioned
   rows, the later ones are rounding-sized; a shift never turns the eigenvectors.
3. The R factors are composed. The singular values of their product are those of the centred rows,
   its right singular vectors the components, which double precision resolves far below what the
   square root of a covariance would.
4. One more pass measures the covariance of the whitened fit list; every row is then projected.

Rows stay in their partitions. A task hands on one matrix of the size of a vector squared, by rows,
which are summed row by row; the driver sees one such matrix a pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import settle

COMPONENTS = 16
#: An entry c becomes floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
MAX_PASSES = 6
#: Rows count as orthonormal when no eigenvalue of their Gram matrix is farther from one.
ORTHONORMAL = 1e-8
#: Directions whose singular value is below this part of the greatest have no variance.
NO_VARIANCE = 1e-12
EPS = np.finfo(np.float64).eps


@dataclass
class Whitening:
    """The fit of all vectors of one length."""

    n: int
    sums: np.ndarray
    factors: list[np.ndarray] = field(default_factory=list)
    trace: float = 0.0
    eigenvalues: np.ndarray = field(default_factory=lambda: np.empty(0))
    #: One component a column, of unit length; the entry of greatest size is positive.
    components: np.ndarray = field(default_factory=lambda: np.empty((0, 0)))
    identity_error: float = 0.0

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """``n * x - sums``, exact; Python integers where a long could overflow."""
        top = float(np.abs(x).max(initial=0)) * self.n + float(np.abs(self.sums).max(initial=0))
        if top < 2.0**62:
            return x * self.n - self.sums
        return x.astype(object) * self.n - self.sums.astype(object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.deviations(x) / self.n).astype(np.float64)

    def orthogonalised(self, x: np.ndarray) -> np.ndarray:
        rows = self.centred(x)
        for factor in self.factors:
            rows = solved(rows, factor)
        return rows

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.components / np.sqrt(self.eigenvalues))

    def finish(self, components: int) -> None:
        """Eigenvalues and components from the composed factors."""
        composed = np.eye(len(self.sums))
        for factor in self.factors:
            composed = factor @ composed
        _, values, vectors = np.linalg.svd(composed)
        kept = min(components, int(np.count_nonzero(values > values[0] * NO_VARIANCE)))
        self.eigenvalues = values[:kept] ** 2 / self.n
        turned = vectors[:kept].T
        signs = np.sign(turned[np.abs(turned).argmax(axis=0), np.arange(kept)])
        self.components = turned * signs


def solved(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """``rows @ inverse(factor)`` for an upper triangular factor, by substitution."""
    out = np.empty(rows.shape, order="F")
    for j in range(rows.shape[1]):
        out[:, j] = (rows[:, j] - out[:, :j] @ factor[:j, j]) / factor[j, j]
    return out


def shifted_factor(gram: np.ndarray, rows: int) -> np.ndarray:
    """Upper triangular R with ``R^T R = gram + shift``, the shift of the size of rounding errors in ``rows`` rows."""
    d = len(gram)
    shift = 11 * (rows * d + d * (d + 1)) * EPS * np.linalg.norm(gram, 2)
    return np.linalg.cholesky(gram + shift * np.eye(d)).T


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, dim, x`` of the rows whose vector has entries, all of them finite."""
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("vec"),
    )
    finite = F.forall("vec", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform("vec", lambda c: F.floor(c * F.lit(float(SCALE))).cast("long") + F.lit(OFFSET))
    return rows.filter((F.size("vec") > 0) & finite).select("vec_id", F.size("vec").cast("long").alias("dim"), whole.alias("x"))


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, places in the batch and matrix of the vectors of each length."""
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims).tolist():
        here = np.flatnonzero(dims == dim)
        part = batch.column("x") if len(here) == len(dims) else batch.column("x").take(pa.array(here))
        yield dim, here, part.flatten().to_numpy().reshape(len(here), dim)


def _totals(fit: DataFrame) -> dict[int, Whitening]:
    """Exact counts and sums of the fit list, by length of vector."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            for dim, _, x in _by_length(batch):
                n, sums = held.get(dim, (0, 0))
                held[dim] = n + len(x), sums + x.sum(axis=0)
        for dim, (n, sums) in held.items():
            yield pa.RecordBatch.from_pydict({"dim": [dim], "n": [n], "sums": [sums.tolist()]})

    parts = settle(fit.mapInArrow(add_up, "dim long, n long, sums array<long>"), "fit-sums")
    counts = {r["dim"]: r["n"] for r in parts.groupBy("dim").agg(F.sum("n").alias("n")).collect()}
    entries = parts.select("dim", F.posexplode("sums").alias("place", "part"))
    sums = {dim: np.zeros(dim, np.int64) for dim in counts}
    for row in entries.groupBy("dim", "place").agg(F.sum("part").alias("total")).collect():
        sums[row["dim"]][row["place"]] = row["total"]
    return {dim: Whitening(n, sums[dim]) for dim, n in counts.items()}


def _grams(fit: DataFrame, rows_of: dict[int, Callable[[np.ndarray], np.ndarray]]) -> dict[int, np.ndarray]:
    """``A^T A`` over the fit list for what each function makes of the vectors of its length."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, _, x in _by_length(batch):
                if dim in rows_of:
                    rows = rows_of[dim](x)
                    held[dim] = held.get(dim, 0.0) + rows.T @ rows
        for dim, gram in held.items():
            places = np.arange(len(gram))
            yield pa.RecordBatch.from_pydict(
                {"dim": np.full(len(gram), dim), "place": places, "part": list(gram)}
            )

    def total(parts: pa.Table) -> pa.Table:
        width = len(parts.column("part")[0])
        flat = parts.column("part").combine_chunks().flatten().to_numpy()
        summed = flat.reshape(-1, width).sum(axis=0)
        return pa.table(
            {"dim": parts.column("dim")[:1], "place": parts.column("place")[:1], "part": [summed]}
        )

    schema = "dim long, place long, part array<double>"
    found = fit.mapInArrow(add_up, schema).groupBy("dim", "place").applyInArrow(total, schema)
    rows = sorted(found.collect(), key=lambda r: (r["dim"], r["place"]))
    return {dim: np.array([r["part"] for r in rows if r["dim"] == dim]) for dim in rows_of}


def _settled(gram: np.ndarray) -> bool:
    """Whether every direction is of unit length or, to rounding, of none."""
    values = np.linalg.eigvalsh(gram)
    return bool(np.all((np.abs(values - 1) < ORTHONORMAL) | (np.abs(values) < 100 * len(gram) * EPS)))


def _checked(model: Whitening) -> Callable[[np.ndarray], np.ndarray]:
    """Whitened rows beside a column of ones, whose products are the sums."""
    return lambda x: np.column_stack((model.whitened(x), np.ones(len(x))))


def fit_whitening(fit: DataFrame, components: int = COMPONENTS) -> dict[int, Whitening]:
    """The fits over a stored list of distinct vectors (columns dim, x), by length of vector.

    A length without any variance has no components.
    """
    models = _totals(fit)
    open_ = dict(models)
    varied = {}
    for step in range(MAX_PASSES):
        if not open_:
            break
        grams = _grams(fit, {dim: model.orthogonalised for dim, model in open_.items()})
        for dim, gram in grams.items():
            model = open_[dim]
            if not step:
                model.trace = float(np.trace(gram)) / model.n
                if model.trace:
                    varied[dim] = model
            if model.trace:
                model.factors.append(shifted_factor(gram, 1 if step else model.n))
            if not model.trace or (step and _settled(gram)):
                del open_[dim]
    for model in varied.values():
        model.finish(components)
    for dim, gram in _grams(fit, {dim: _checked(m) for dim, m in varied.items()}).items() if varied else ():
        n = varied[dim].n
        mean = gram[-1, :-1] / n
        covariance = gram[:-1, :-1] / n - np.outer(mean, mean)
        varied[dim].identity_error = float(np.abs(covariance - np.eye(len(mean))).max(initial=0))
    return models


OUT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, "
    "identity_error double"
)


def whiten(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """A row per vector and component: its whitened value, and what the fit says of the component.

    Null and empty vectors and vectors with null or non-finite entries are left out. Repeated rows and ids
    stay, each with its rows; equal vectors count once in the fit. Vectors of different lengths are
    fitted apart (every fit has its own ``n``; the lengths should be few). Components without
    variance are left out: fewer distinct vectors than components, or constant entries, give fewer
    rows, and one distinct vector or an empty table none. ``deviation`` is null where it exceeds a
    long; entries that no long can hold, from about 10^17 on, are an error. Other columns are
    ignored, whatever their names.
    """
    rows = settle(integer_vectors(vectors, id_col, vector_col), "integer-vectors")
    fit = settle(rows.select("dim", "x").distinct(), "fit-list")
    models = fit_whitening(fit, components)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("vec_id")
            for dim, here, x in _by_length(batch):
                model = models[dim]
                k = len(model.eigenvalues)
                if not k:
                    continue
                m = len(here)
                repeated = pa.array(np.repeat(here, k))
                columns = {
                    "vec_id": ids.take(repeated),
                    "component": np.tile(np.arange(1, k + 1, dtype=np.int32), m),
                    "n": np.full(m * k, model.n),
                    "deviation": _squares(model.deviations(x)).take(pa.array(np.repeat(np.arange(m), k))),
                    "whitened": model.whitened(x).ravel(),
                    "explained": np.tile(model.eigenvalues / model.trace, m),
                    "identity_error": np.full(m * k, model.identity_error),
                }
                yield pa.RecordBatch.from_pydict(columns)

    return rows.mapInArrow(project, OUT)


def _squares(deviations: np.ndarray) -> pa.Array:
    """Sums of squares by row, exact; null where a long cannot hold one."""
    if deviations.dtype != object and float(np.abs(deviations).max(initial=0)) ** 2 * deviations.shape[1] < 2.0**62:
        return pa.array((deviations**2).sum(axis=1), pa.int64())
    sums = (deviations.astype(object) ** 2).sum(axis=1)
    return pa.array([value if value < 1 << 63 else None for value in sums.tolist()], pa.int64())
