"""Approximate nearest neighbours by a permutation index.

Each vector is represented by the order of its ``LENGTH`` nearest pivots. A block of vectors posts
these orders into inverted files, one per pivot, which hold the place of the pivot in each vector's
order (``LENGTH`` where it is not among them). A query reads the files of its own nearest pivots,
adds up the differences of places (footrule distance), and reranks the vectors by their true
distance in this order, ``SHARE`` of the block at a time, until ``PATIENCE`` such portions in a row
have brought nothing better. So a dense cluster, whose members the pivots hardly tell apart, is gone
through as far as it helps.

Every row is indexed. Queries are a stated set: they go over all rows in blocks of about
``QUERY_BLOCK``, each of which is broadcast with a bounded size; every block of vectors gives its
ten best per query, and the best of these are the result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import settle

PIVOTS = 256
LENGTH = 192
SHARE = 0.04
MIN_CANDIDATES = 50
PATIENCE = 4
QUERY_BLOCK = 4096
INDEX_BLOCK = 16_384
NEIGHBOURS = 10


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, vec`` of the rows that take part: an id, and a finite vector other than zero."""
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vec")
    )
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col("id").isNotNull() & finite & F.exists("vec", lambda x: x != 0))


def nearest_pivots(vectors: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """Per vector the numbers of its nearest pivots, nearest first; ties go to the lower number."""
    apart = (pivots**2).sum(axis=1)[None] - 2 * vectors @ pivots.T
    return np.argsort(apart, axis=1, kind="stable")[:, :length]


class InvertedFiles:
    """For each pivot, the place it has in the order of every vector of a block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, pivots: np.ndarray, length: int):
        self.ids, self.vectors, self.length = ids, vectors, min(length, len(pivots))
        order = nearest_pivots(vectors, pivots, self.length)
        self.places = np.full((len(pivots), len(ids)), self.length, np.int16)
        rows = np.repeat(np.arange(len(ids)), self.length)
        self.places[order.ravel(), rows] = np.tile(np.arange(self.length, dtype=np.int16), len(ids))

    def footrule(self, order: np.ndarray) -> np.ndarray:
        """Distance of the order of a query to those of all vectors, over the query's pivots."""
        own = np.arange(len(order), dtype=np.int16)[:, None]
        return np.abs(self.places[order] - own).sum(axis=0, dtype=np.int32)

    def search(
        self, query_id: int, query: np.ndarray, order: np.ndarray, k: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the best candidates other than the query's own row."""
        far = self.footrule(order)
        own = self.ids == query_id
        far[own] = np.iinfo(np.int32).max
        order = np.argsort(far, kind="stable")[: len(far) - np.count_nonzero(own)]
        portion = max(MIN_CANDIDATES, k, math.ceil(SHARE * len(far)))
        ids, scores, idle = np.empty(0, np.int64), np.empty(0), 0
        for at in range(0, len(order), portion):
            near = order[at : at + portion]
            score = np.sqrt(((self.vectors[near] - query) ** 2).sum(axis=1))
            every, all_ids = np.append(scores, score), np.append(ids, self.ids[near])
            best = np.lexsort((all_ids, every))
            _, first = np.unique(all_ids[best], return_index=True)  # repeated ids count once
            best = best[np.sort(first)][:k]
            idle = idle + 1 if np.array_equal(all_ids[best], ids) else 0
            ids, scores = all_ids[best], every[best]
            if idle == PATIENCE:
                break
        return ids, scores


def _search_block(shared, k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, query_ids, queries = shared.value
        orders = nearest_pivots(queries, pivots, min(LENGTH, len(pivots)))
        held: list[pa.RecordBatch] = []

        def flush() -> Iterator[pa.RecordBatch]:
            ids = np.concatenate([b.column("id").to_numpy() for b in held])
            flat = np.concatenate([b.column("vec").flatten().to_numpy() for b in held])
            files = InvertedFiles(ids, flat.reshape(len(ids), -1), pivots, LENGTH)
            for query_id, query, order in zip(query_ids, queries, orders):
                found, score = files.search(query_id, query, order, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(found), query_id)), pa.array(found), pa.array(score)],
                    ["query_id", "vec_id", "score"],
                )

        size = 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size >= INDEX_BLOCK:
                yield from flush()
                held.clear()
                size = 0
        if held:
            yield from flush()

    return search


def _matrix(rows: list) -> np.ndarray:
    return np.array([row["vec"] for row in rows], dtype=np.float64)


def nearest(
    vectors: DataFrame,
    is_query: F.Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = NEIGHBOURS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows found for each query row.

    ``is_query`` is a condition on column ``id``. Score is the Euclidean distance of the vectors in
    double precision; ties go to the smaller id. Rows without an id and vectors that are null, zero,
    or hold null or non-finite numbers take no part. Vectors of different lengths have no distance:
    each length is indexed and searched by itself (there should be few). Rows with equal ids count
    once, with the smallest distance. Fewer candidates than ``k`` give fewer rows, and tables without a
    query none. Other columns are ignored.
    """
    rows = usable(vectors, id_col, vector_col).withColumn("length", F.size("vec"))
    asked = rows.filter(is_query).select("length").distinct().orderBy("length").collect()
    out = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    found = None
    for row in asked:
        part = _nearest(rows.filter(F.col("length") == row["length"]).drop("length"), is_query, k)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return out
    # An id with vectors of several lengths has neighbours of each.
    return found if len(asked) == 1 else _best(found.select("query_id", "vec_id", "score"), k)


def _nearest(rows: DataFrame, is_query: F.Column, k: int) -> DataFrame:
    """The same for usable rows of one length."""
    spark = rows.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    chosen = rows.orderBy(F.xxhash64("id"), "id").limit(PIVOTS).collect()
    pivots = np.unique(_matrix(chosen), axis=0)
    queries = settle(rows.filter(is_query).groupBy("id").agg(F.min("vec").alias("vec")), "queries")
    blocks = math.ceil(queries.count() / QUERY_BLOCK)
    parts = []
    for block in range(blocks):
        mine = queries.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).orderBy("id").collect()
        if not mine:
            continue
        ids = np.array([row["id"] for row in mine], np.int64)
        shared = spark.sparkContext.broadcast((pivots, ids, _matrix(mine)))
        found = rows.mapInArrow(_search_block(shared, k), "query_id long, vec_id long, score double")
        parts.append(settle(_best(found, k), "neighbours") if blocks > 1 else _best(found, k))
    if not parts:
        return empty
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _best(found: DataFrame, k: int) -> DataFrame:
    once = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
