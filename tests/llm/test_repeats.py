import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tillroll.llm import repeats

from cases import documents, odd_documents


def brute(texts, length=200):
    """Removed runs of each text, by a count of every passage."""
    bodies = [(t or "").encode() for t in texts]
    counts = Counter(b[i : i + length] for b in bodies for i in range(len(b) - length + 1))
    out = []
    for b in bodies:
        covered = np.zeros(len(b) + 2, bool)
        for i in range(len(b) - length + 1):
            if counts[b[i : i + length]] > 1:
                covered[i + 1 : i + 1 + length] = True
        edges = np.flatnonzero(np.diff(covered.astype(np.int8)))
        kept = np.frombuffer(b, np.uint8)[~covered[1 : len(b) + 1]].tobytes()
        out.append((list(zip(edges[::2].tolist(), edges[1::2].tolist())), kept))
    return out


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefg é") for _ in range(rng.randrange(2, 8))) for _ in range(n))


def collection(seed):
    rng = random.Random(seed)
    passage, line = words(rng, 90), words(rng, 20)
    texts = [words(rng, rng.randrange(1, 200)) for _ in range(30)]
    texts += [f"{words(rng, 60)} {passage} {words(rng, 60)}" for _ in range(20)]
    texts += [f"{words(rng, 60)} {line} {words(rng, 60)}" for _ in range(20)]
    texts += [texts[0] + texts[1]] * 3 + ["x" * 1500, "x" * 199, "x" * 200, "ab" * 300, "abc" * 77 + words(rng, 50)]
    base = words(rng, 150)
    for _ in range(15):  # near copies: one letter differs
        at = rng.randrange(len(base))
        texts.append(base[:at] + "#" + base[at + 1 :])
    exact = words(rng, 40).encode()[:200].decode(errors="ignore").ljust(200, "y")[:200]
    texts += [f"1{exact}2", f"3{exact}4", f"5{exact[:-1]}6", exact + exact]
    return texts


def check(spark, texts):
    rows = repeats.remove_repeats(documents(spark, texts)).collect()
    want = brute(texts)
    assert len(rows) == len(texts)
    for r in rows:
        spans, kept = want[r["doc_id"]]
        assert [(s["start"], s["end"]) for s in r["spans"]] == spans, r["doc_id"]
        assert r["kept"] == kept and r["n_bytes"] == len(texts[r["doc_id"]].encode())


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    check(spark, collection(seed))


def test_crowded_anchors(spark, monkeypatch):
    """Groups over the bound are split level by level, down to single passages."""
    monkeypatch.setattr(repeats, "MOST", 2)
    check(spark, collection(3))


def test_small_blocks_and_buffers(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK", 3)
    texts = collection(4)
    check(spark, texts)
    bodies = [t.encode() for t in texts]
    whole = repeats.stretches_of(bodies)
    monkeypatch.setattr(repeats, "BUFFER", 512)
    monkeypatch.setattr(repeats, "_PLACE_BITS", np.uint64(1023))
    repeats._powers.cache_clear()
    cut = repeats.stretches_of(bodies)
    repeats._powers.cache_clear()
    for found in (whole, cut):  # every passage lies in one stretch, whatever the pieces
        passages = Counter()
        for number, start, count in zip(found["number"].tolist(), found["start"].tolist(), found["passages"].tolist()):
            passages.update((number, p) for p in range(start, start + count))
        assert set(passages.values()) == {1}
        assert set(passages) == {(i, p) for i, b in enumerate(bodies) for p in range(len(b) - 199)}
        assert found["col"].min() >= 1 - repeats.PLACES and found["col"].max() <= 0


def test_least_of_and_between():
    rng = np.random.default_rng(9)
    values = rng.integers(0, 50, 400).astype(np.int16)
    assert repeats.least_of(values, 7).tolist() == [values[i : i + 7].min() for i in range(394)]
    first = np.append(rng.integers(0, 399, 300), [0, 0])
    last = np.append(np.minimum(first[:300] + rng.integers(0, 400, 300), 399), [399, 0])
    want = [values[a : b + 1].min() for a, b in zip(first, last)]
    assert repeats._least_between(values, first, last).tolist() == want


def test_columns_of_one_collection():
    """Orders and common prefixes find the passages that a plain comparison finds."""
    rng = random.Random(4)
    anchor = bytes(rng.choices(b"abcd", k=repeats.GRAM))
    contents, cols = [], []
    for _ in range(40):
        low, high = sorted(rng.choices(range(-100, 1), k=2))
        left, right = bytes(rng.choices(b"ab", [30, 1], k=100)), bytes(rng.choices(b"ab", [30, 1], k=100))
        contents.append((left + anchor + right)[low + 100 : high + 300])
        cols.append(low)
    found = repeats.insert_columns(contents, np.array(cols), np.zeros(40, int))
    for i, (content, col) in enumerate(zip(contents, cols)):
        for at in range(-100, 1):
            here = content[at - col : at - col + 200] if at >= col else b""
            others = [c[at - k : at - k + 200] for j, (c, k) in enumerate(zip(contents, cols)) if j != i and at >= k]
            assert found[i, at + 100] == (len(here) == 200 and here in others)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = repeats.remove_repeats(docs).collect()
    assert len(rows) == docs.count()
    texts = [r["text"] for r in docs.select("text").collect()]
    want = sorted(hashlib.sha256(kept).hexdigest() for _, kept in brute(texts))
    assert sorted(hashlib.sha256(r["kept"]).hexdigest() for r in rows) == want
    assert repeats.remove_repeats(odd_documents(spark, [])).count() == 0
