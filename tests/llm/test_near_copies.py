import random

import numpy as np

from tillroll.llm import near_copies, simhash

from cases import documents, odd_documents


def shingles(text):
    words = (text or "").lower().split()
    span = min(5, len(words))
    return {" ".join(words[i : i + span]) for i in range(len(words) - span + 1)} if words else set()


def alike(a, b):
    a, b = shingles(a), shingles(b)
    return (not a and not b) or len(a & b) >= 0.8 * len(a | b)


def classes(texts):
    """The least number of each text's class, by all pairs."""
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            a, b = find(i), find(j)
            if a != b and (texts[i] == texts[j] or alike(texts[i], texts[j])):
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))]


def collection(seed, bases=40, copies=4):
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrst"]
    texts = []
    for _ in range(bases):
        words = rng.choices(vocabulary, k=rng.randrange(60, 400))
        texts.append(" ".join(words))
        for _ in range(rng.randrange(copies)):
            other = list(words)
            for _ in range(rng.randrange(1, max(2, len(words) // 45))):
                other[rng.randrange(len(other))] = rng.choice(vocabulary)
            texts.append(" ".join(other))
    rng.shuffle(texts)
    return texts


def test_similarity_is_that_of_shingles():
    texts = [*collection(1, 6), "", " \n", "one", "One", "one two three four", "a b c d e f"]
    for a in texts:
        for b in texts:
            near = near_copies.similarity(near_copies.shingle_hashes(a), near_copies.shingle_hashes(b)) >= 0.8
            assert near == alike(a, b)


def test_classes_against_all_pairs(spark):
    """Recall and precision over random near copies; what is linked is always alike."""
    texts = collection(2, 120)
    want = classes(texts)
    rows = near_copies.keep_one_of_each(documents(spark, texts)).collect()
    kept = {r["doc_id"] for r in rows}
    must = set(want)
    assert must <= kept  # no class is lost
    extra = kept - must
    copies = len(texts) - len(must)
    assert copies > 100 and len(extra) <= 0.02 * copies


def test_no_pair_that_is_alike_is_left_out(spark):
    """Copies at the very bar, and copies just below it."""
    rng = random.Random(11)
    texts = []
    for number in range(150):
        words = [f"w{number}x{i}" for i in range(rng.randrange(40, 120))]
        texts.append(" ".join(words))
        # The most words that may be appended: n of n + m shingles are equal, with n >= 0.8 (n + m).
        more = (len(words) - 4) // 4
        texts.append(" ".join(words + [f"more{number}y{i}" for i in range(more)]))
        texts.append(" ".join(words + [f"over{number}y{i}" for i in range(more + 1)]))
    rng.shuffle(texts)
    want = set(classes(texts))
    assert {r["doc_id"] for r in near_copies.keep_one_of_each(documents(spark, texts)).collect()} == want


def test_classes_do_not_depend_on_heads(spark, monkeypatch):
    """A chain: each text is like the next one only, and all share a passage."""
    monkeypatch.setattr(near_copies, "PAIRS_A_ROW", 0)
    passage = [f"p{i}" for i in range(64)]
    texts = [" ".join(passage + [f"q{j}" for j in range(i, i + 36)]) for i in range(0, 240, 6)]
    assert not alike(texts[0], texts[2])
    rows = near_copies.keep_one_of_each(documents(spark, texts)).collect()
    assert {r["doc_id"] for r in rows} == set(classes(texts)) == {0}


def test_a_large_group_of_near_copies(spark):
    rng = random.Random(5)
    base = [f"w{i % 211}x{i % 13}" for i in range(120)]
    texts = []
    for _ in range(1500):
        other = list(base)
        other[rng.randrange(len(other))] = f"new{rng.randrange(10**6)}"
        texts.append(" ".join(other))
    rows = near_copies.keep_one_of_each(documents(spark, texts + ["something else altogether"])).collect()
    assert {r["doc_id"] for r in rows} == {0, 1500}


def test_near_links_are_pairs_within_the_radius(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(-(2**62), 2**62, 30)
    fps = {int(b) ^ int(np.bitwise_xor.reduce(1 << rng.integers(0, 62, k))) for b in base for k in (1, 4, 9)}
    frame = spark.createDataFrame([(f,) for f in fps], "fp long")
    links = simhash.near_links(frame, 8, 8, 14, 2).distinct().collect()
    assert links
    for r in links:
        assert r["a"] in fps and r["b"] in fps and bin((r["a"] ^ r["b"]) & (2**64 - 1)).count("1") <= 14


def test_nearest_forest_spans_every_radius():
    rng = np.random.default_rng(4)
    fps = rng.integers(0, 2**63, 60).astype(np.uint64)
    fps[20:] = fps[rng.integers(0, 20, 40)] ^ (np.uint64(1) << rng.integers(0, 63, 40).astype(np.uint64))
    fps = np.unique(fps)
    u, v = np.triu_indices(len(fps), 1)
    a, b = simhash._nearest_forest(u, v, fps)

    def components(us, vs, limit):
        root = {int(f): int(f) for f in fps.view(np.int64)}
        for x, y in zip(us, vs):
            if bin((int(x) ^ int(y)) & (2**64 - 1)).count("1") <= limit:
                rx, ry = root[int(x)], root[int(y)]
                root = {k: (min(rx, ry) if r in (rx, ry) else r) for k, r in root.items()}
        return root

    signed = fps.view(np.int64)
    for limit in (1, 2, 25, 64):
        assert components(a, b, limit) == components(signed[u], signed[v], limit)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = near_copies.keep_one_of_each(docs)
    assert rows.columns == docs.columns
    kept = rows.collect()
    # Empty, null and blank texts are three rows of one class; ids 4 and 5 differ in case only.
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == [0, 2, 2, 3, 4, 7]
    assert [r["text"] for r in kept if r["doc_id"] is None] == ["no id at all"]
    assert near_copies.keep_one_of_each(odd_documents(spark, [])).count() == 0
    same = [(None, "the same words in every row", "en", "a")] * 5 + [(9, "other words of one id", "en", "a")] * 4
    kept = near_copies.keep_one_of_each(odd_documents(spark, same)).collect()
    assert sorted((r["doc_id"] or 0) for r in kept) == [0, 9]


def test_what_is_stored_to_compare_is_smaller_than_shingles(spark, monkeypatch):
    sizes, put = {}, near_copies.settle

    def settle(df, label):
        stored = put(df, label)
        binary = [c for c, kind in stored.dtypes if kind == "binary"]
        if label not in ("distinct-texts", "texts-to-compare"):
            sizes[label] = [r[0] for r in stored.selectExpr(f"length({binary[0]})").collect()] if binary else []
        return stored

    monkeypatch.setattr(near_copies, "settle", settle)
    rng = random.Random(41)
    words = [f"{a}{b}{c}" for a in "bcdfgl" for b in "aeiou" for c in "bdkl"]
    base = [" ".join(rng.choices(words, k=400)) for _ in range(6)]
    texts = [text + f" end{i}" for text in base for i in range(3)]
    classes = near_copies.near_copy_classes(documents(spark, texts)).collect()
    assert len(classes) == 18 and len({r["class_key"] for r in classes}) == 6
    whole = sum(8 * len(near_copies.shingle_hashes(x)) for x in texts)
    assert 0 < max(sum(x) for label, x in sizes.items() if label != "near-copy-classes") < whole / 2
