import hashlib
import math
from collections import Counter

import pytest

from tillroll.llm import mixing

from cases import odd_documents


def draw(seed, name, part, mean):
    u = (int(hashlib.md5(f"{seed}:{name}:{part}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
    k, p = 0, math.exp(-mean)
    total = p
    while total < u and k < mixing.PART_COPIES + 1:
        k += 1
        p *= mean / k
        total += p
    return k


def corpus(spark, sizes):
    rows, i = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            rows.append((i, f"text {i}", "en", source, 7))
            i += 1
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_copies_against_brute_force(spark):
    docs = corpus(spark, {"a": 300, "b": 40, "c": 5})
    weights = {"a": 1.0, "b": 1.0, "c": 2.0}
    got = Counter(r["doc_id"] for r in mixing.mix(docs, weights).collect())
    sizes = {"a": 300, "b": 40, "c": 5}
    expected = Counter()
    for row in docs.collect():
        s = row["source"]
        rate = 345 * (weights[s] / 4.0) / sizes[s]
        parts = max(math.ceil(rate / mixing.PART_MEAN), 1)
        expected[row["doc_id"]] = sum(draw(42, row["doc_id"], p, rate / parts) for p in range(1, parts + 1))
    assert got == +expected


def test_shares_reach_their_targets(spark):
    docs = corpus(spark, {"a": 4000, "b": 1000})
    rows = Counter(r["source"] for r in mixing.mix(docs, {"a": 1, "b": 1}).collect())
    for source in "ab":
        assert abs(rows[source] - 2500) < 6 * math.sqrt(2500 * 2.5)


def test_sources_left_out_have_no_copies(spark):
    docs = corpus(spark, {"a": 10, "b": 10})
    assert {r["source"] for r in mixing.mix(docs, {"a": 1}).collect()} == {"a"}
    assert mixing.mix(docs, {}).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(docs, {"a": -1})


def test_every_copy_is_whole_and_numbered(spark):
    docs = corpus(spark, {"a": 50, "b": 2})
    rows = mixing.mix(docs, {"a": 1, "b": 9}).collect()
    byid = {}
    for r in rows:
        assert r["text"] == f"text {r['doc_id']}"
        byid.setdefault(r["doc_id"], []).append(r["copy"])
    assert all(sorted(c) == list(range(1, len(c) + 1)) for c in byid.values())


def test_order_is_mixed_and_repeatable(spark):
    docs = corpus(spark, {"a": 500, "b": 500})
    one = [(r["doc_id"], r["copy"], r["mix_key"]) for r in mixing.mix(docs).collect()]
    two = [(r["doc_id"], r["copy"], r["mix_key"]) for r in mixing.mix(docs.repartition(5)).collect()]
    assert sorted(one) == sorted(two)
    ids = [i for i, _, _ in one]
    assert ids != sorted(ids)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    mixed = mixing.mix(docs)
    assert mixed.columns == [c for c in docs.columns if c not in ("copy", "mix_key")] + ["copy", "mix_key"]
    sources = {r["source"] for r in mixing.mix(docs, {"a": 5.0}).collect()}
    assert sources <= {"a"}
    counts = Counter((r["doc_id"], r["text"]) for r in mixed.collect() if r["doc_id"] == 4)
    assert all(n % 2 == 0 for n in counts.values())
    assert mixing.mix(odd_documents(spark, [])).count() == 0
