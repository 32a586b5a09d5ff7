import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tillroll.llm import simhash
from tillroll.llm.components import connected_components

from cases import LONG, documents, odd_documents


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def classes_of(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_pairs(codes):
    return [(a, b) for a in codes for b in codes if a < b and (a ^ b).bit_count() <= 3]


def clustered(seed, groups, size, flips):
    rng = random.Random(seed)
    out = set()
    for _ in range(groups):
        base = rng.getrandbits(64)
        for _ in range(size):
            code = base
            for _ in range(rng.randrange(flips + 1)):
                code ^= 1 << rng.randrange(64)
            out.add(code)
    return sorted(out)


def in_gray_order(codes):
    array = np.array(codes, np.uint64)
    rank = array.copy()
    for step in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(step)
    return array[np.argsort(rank)]


@pytest.mark.parametrize("text", ["", None, "a", "A b", "Ünï Code x y z", "ABC\x0bdef ghi\tjkl", LONG[:9000]])
def test_fingerprint_by_definition(text):
    assert simhash.text_fingerprint(text) % (1 << 64) == plain_fingerprint(text)


def test_hash_is_the_native_one(spark):
    row = spark.sql("SELECT xxhash64('a b c') AS h").first()
    assert row["h"] % (1 << 64) == xxhash.xxh64_intdigest(b"a b c", 42)


@pytest.mark.parametrize("shape", [(1, 1, 0), (3, 2, 1), (20, 9, 2), (4, 120, 6), (400, 1, 0)])
def test_tree_links_have_the_closure_of_all_pairs(shape):
    codes = in_gray_order(clustered(1, *shape))
    tree = simhash.PatternTree(codes)
    us, vs = simhash.tree_links(tree, tree, 3)
    assert all((int(codes[u]) ^ int(codes[v])).bit_count() <= 3 for u, v in zip(us, vs))
    values = [int(c) for c in codes]
    got = classes_of(values, [(values[u], values[v]) for u, v in zip(us, vs)])
    assert got == classes_of(values, near_pairs(values))


@pytest.mark.parametrize("page", [2, 7, 1024])
def test_links_across_pages_and_partitions(spark, page):
    codes = clustered(2, 30, 25, 5)
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    table = spark.createDataFrame([(c,) for c in signed], "fp long").repartition(3)
    links = simhash.near_links(table, page=page).collect()
    got = classes_of(codes, [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in links])
    assert got == classes_of(codes, near_pairs(codes))


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    odd = [(5000, 5000), (5001, 5002), (5002, 5001), (None, 5003)]
    edges = spark.createDataFrame(chain + star + odd, "a long, b long")
    roots = {r["node"]: r["root"] for r in connected_components(edges).collect()}
    expected = {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(200)} | {5001: 5001, 5002: 5001}
    assert roots == expected


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_groups_against_brute_force(spark):
    rng = random.Random(3)
    words = [f"v{i}" for i in range(300)]
    texts = []
    for _ in range(40):
        base = [rng.choice(words) for _ in range(150)]
        for _ in range(rng.randrange(1, 5)):
            changed = list(base)
            for _ in range(rng.randrange(3)):
                changed[rng.randrange(150)] = rng.choice(words)
            texts.append(" ".join(changed))
    rows = simhash.near_duplicates(documents(spark, texts)).collect()
    codes = [plain_fingerprint(t) for t in texts]
    roots = classes_of(sorted(set(codes)), near_pairs(sorted(set(codes))))
    least = {}
    for i, code in enumerate(codes):
        least.setdefault(roots[code], i)
    expected = {i: (f"{c:016x}", least[roots[c]]) for i, c in enumerate(codes)}
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == expected


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    empty = {(r["doc_id"], r["component_id"]) for r in rows if r["fingerprint"] == "0" * 16}
    assert empty == {(0, 0), (1, 0), (6, 0), (None, 0)}
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    left = sorted((r["doc_id"] or -1, r["text"] or "") for r in kept.collect())
    assert [i for i, _ in left] == [-1, -1, -1, 2, 2, 3, 4, 4, 7]


def test_empty_table(spark):
    docs = odd_documents(spark, [])
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.keep_one_of_each(docs).count() == 0


def test_routes_cover_all_ways_to_differ():
    masks = [m % (1 << 64) for m in simhash.routes()]
    rng = random.Random(4)
    for _ in range(500):
        flipped = sum(1 << b for b in rng.sample(range(64), 3))
        assert any(flipped & m == 0 for m in masks)


def test_gray_rank_orders_neighbours_by_one_bit(spark):
    table = spark.range(64).select(F.col("id").alias("fp"), simhash.gray_rank(F.col("id")).alias("rank"))
    codes = [r["fp"] for r in table.orderBy("rank").collect()]
    assert all((a ^ b).bit_count() == 1 for a, b in zip(codes, codes[1:]))
