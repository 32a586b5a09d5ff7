import numpy as np
from pyspark.sql import functions as F

from tillroll.llm import permutation_index

SCHEMA = "vec_id long, embedding array<float>, label int, id string, vec string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "z", "z") for i, v in rows], SCHEMA).repartition(3)


def exact(ids, x, k=10):
    out = {}
    for q in np.flatnonzero(ids % 100 == 0):
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        order = [j for j in np.lexsort((ids, d)) if ids[j] != ids[q]][:k]
        out[int(ids[q])] = [(int(ids[j]), float(d[j])) for j in order]
    return out


def test_recall_and_scores(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(3000, 32))
    x[:900] = x[0] + 0.05 * rng.normal(size=(900, 32))  # a dense cluster with a third of the rows
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    ids = np.arange(3000)
    rows = permutation_index.nearest(
        table(spark, [(int(i), v.tolist()) for i, v in zip(ids, x)]), F.col("id") % 100 == 0
    ).collect()
    want = exact(ids, x.astype(np.float64))
    got = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(got) == set(want) and all(len(v) == 10 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)
    for q, found in got.items():
        assert found == sorted(found, key=lambda f: (f[1], f[0]))
        for i, score in found:
            d = np.sqrt(((x[q].astype(np.float64) - x[i].astype(np.float64)) ** 2).sum())
            assert abs(score - d) < 1e-12


def test_ties_go_to_the_smaller_id(spark):
    rows = [(i, [1.0, 0.0]) for i in range(40)] + [(100, [0.0, 1.0])]
    found = permutation_index.nearest(table(spark, rows), F.col("id") % 100 == 0).collect()
    got = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got == {0: list(range(1, 11)), 100: list(range(10))}


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [1.0, 2.5]), (2, None), (3, []), (4, [nan, 1.0]), (5, [inf, 1.0]),
        (6, [0.0, 0.0]), (7, [1.0, None]), (None, [1.0, 2.0]), (8, [3.0, 4.0]), (200, [0.0, 0.0]), (100, [2.0, 2.0]),
    ]
    found = permutation_index.nearest(table(spark, rows), F.col("id") % 100 == 0).collect()
    got = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got == {0: [1, 100, 8], 100: [0, 1, 8]}


def test_every_length_is_searched(spark):
    rows = [(i * 50, [float(i), 1.0]) for i in range(6)] + [(1000 + i * 50, [float(i), 0.0, 2.0]) for i in range(4)] + [(2000, [3.0])]
    found = permutation_index.nearest(table(spark, rows), F.col("id") % 100 == 0).collect()
    got = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got == {
        0: [50, 100, 150, 200, 250], 100: [50, 150, 0, 200, 250], 200: [150, 250, 100, 50, 0],
        1000: [1050, 1100, 1150], 1100: [1050, 1150, 1000],
    }


def test_without_vectors_or_queries(spark):
    assert permutation_index.nearest(table(spark, []), F.col("id") % 100 == 0).count() == 0
    assert permutation_index.nearest(table(spark, [(1, [1.0])]), F.col("id") % 100 == 0).count() == 0


def test_query_blocks(spark, monkeypatch):
    monkeypatch.setattr(permutation_index, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(12)
    x = rng.normal(size=(60, 4)).astype(np.float32)
    rows = [(int(i) * 10, v.tolist()) for i, v in enumerate(x)]
    found = permutation_index.nearest(table(spark, rows), F.col("id") % 100 == 0).collect()
    ids = np.arange(60) * 10
    want = exact(ids, x.astype(np.float64))
    got = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got == {q: [i for i, _ in v] for q, v in want.items()}


def test_one_row_of_odd_length_does_not_drop_the_others(spark):
    """Each row in turn has an odd length, so the one with the smallest hash has it once."""
    for odd in range(0, 6):
        rows = [(i * 100, [1.0] * 3 if i == odd else [float(i), 1.0]) for i in range(6)]
        found = permutation_index.nearest(table(spark, rows), F.col("id") % 100 == 0).collect()
        assert {r["query_id"] for r in found} == {i * 100 for i in range(6) if i != odd}
        assert len(found) == 5 * 4
