import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import toxicity

from cases import documents, labels_of, odd_documents


def corpus(seed, n=900):
    rng = random.Random(seed)
    words = [f"{a}{b}{c}" for a in "bcdfglmnprst" for b in "aeiou" for c in "bdklmnrt"]
    bad = ["scumlike", "vileness", "trashful", "idiotic"]
    texts, labels = [], []
    for _ in range(n):
        text = [rng.choice(words) for _ in range(rng.randrange(20, 200))]
        toxic = rng.random() < 0.2
        if toxic:
            for _ in range(rng.randrange(2, 6)):
                text.insert(rng.randrange(len(text)), rng.choice(bad))
        texts.append(" ".join(text))
        labels.append(int(toxic))
    return texts, labels


def held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


@pytest.fixture(scope="module")
def scored(spark):
    texts, labels = corpus(13)
    table = labels_of(spark, [(i, 1, y) for i, y in enumerate(labels)])
    rows = toxicity.toxicity_scores(documents(spark, texts), table).collect()
    return {r["doc_id"]: r["score"] for r in rows}, labels


def test_held_out_accuracy(scored):
    scores, labels = scored
    rows = [(scores[i] >= toxicity.THRESHOLD, y) for i, y in enumerate(labels) if held(i)]
    assert sum(p for p, y in rows if y) >= 0.85 * sum(y for _, y in rows)
    assert sum(p for p, y in rows if not y) <= 0.02 * len(rows)


def test_held_out_labels_change_nothing(spark, scored):
    scores, labels = scored
    texts, _ = corpus(13)
    table = labels_of(spark, [(i, 0, 1 - y if held(i) else y) for i, y in enumerate(labels)])
    rows = toxicity.toxicity_scores(documents(spark, texts), table).collect()
    assert {r["doc_id"]: r["score"] for r in rows} == scores


def test_counts_against_plain_counting(spark):
    texts, labels = corpus(14, 60)
    table = labels_of(spark, [(i, 1, y) for i, y in enumerate(labels)])
    got = toxicity.count_model(documents(spark, texts), toxicity.training_rows(table)).collect()
    words = {}
    for i, (text, y) in enumerate(zip(texts, labels)):
        if not held(i):
            for w in toxicity.word_numbers(text).tolist():
                words.setdefault(w, [0, 0])[y] += 1
    found = {r["bucket"]: [r["ordinary"], r["toxic"]] for r in got if r["kind"] == "word"}
    assert found == words


def test_features_leave_a_texts_own_counts_out():
    rows = [("word", 5, 0.0, 3.0), ("word", 6, 40.0, 40.0)]
    import pandas as pd

    table = pd.DataFrame(rows, columns=["kind", "bucket", "ordinary", "toxic"])
    for name in ("kept_ordinary", "kept_toxic", "kinds"):
        table[name] = 0.0
    model = toxicity.Model(table)
    alone = np.array([5, 5, 5, 6])
    assert model.features(alone, 1)[2] < model.features(alone)[2]


def plain_model(train, frequent_pair):
    """Class-conditional Kneser-Ney over dictionaries, from pairs of text and label: the features of a text."""
    import re
    from collections import Counter

    words_of = lambda t: re.findall(r"[^\W\d_]+", t.lower())
    pair, word, context = ([Counter(), Counter()] for _ in range(3))
    for text, y in train:
        for before, w in zip(["", *words_of(text)], words_of(text)):
            pair[y][before, w] += 1
            word[y][w] += 1
            context[y][before] += 1
    every = set(pair[0]) | set(pair[1])
    kinds = Counter(w for _, w in every)
    shared_total = len(every) + len(kinds) + 1
    kept = [Counter(), Counter()]
    for key in every:
        if pair[0][key] + pair[1][key] >= frequent_pair:
            for y in (0, 1):
                kept[y][key[0]] += max(pair[y][key] - 0.75, 0)

    often = {v for v in kinds if word[0][v] + word[1][v] >= toxicity.FREQUENT_WORD}
    totals = [sum(counts.values()) for counts in word]
    rests = [total - sum(max(counts[v] - 0.75, 0) for v in often) for total, counts in zip(totals, word)]

    def probability(y, before, w):
        kept_word = max(word[y][w] - 0.75, 0) if w in often else 0
        single = (kept_word + rests[y] * (kinds[w] + 1) / shared_total) / totals[y]
        left = context[y][before] - kept[y][before]
        n = pair[y][before, w] if pair[0][before, w] + pair[1][before, w] >= frequent_pair else 0
        double = max(n - 0.75, 0) + left * single
        return double / context[y][before] if context[y][before] and double > 0 else single

    def features(text):
        ratio = [
            math.log(probability(1, b, w)) - math.log(probability(0, b, w))
            for b, w in zip(["", *words_of(text)], words_of(text))
        ]
        if not ratio:
            return [0.0] * 6
        strong = sorted(ratio, reverse=True)
        mean = sum(ratio) / len(ratio)
        return [mean, sum(max(r, 0) for r in ratio) / len(ratio), *[sum(strong[:k]) for k in (1, 3, 8)], math.log1p(len(ratio))]

    return features


def test_ratios_against_plain_kneser_ney(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "FREQUENT_PAIR", 3)
    monkeypatch.setattr(toxicity, "BLOCK_TOKENS", 300)
    rng = random.Random(17)
    words = ["the", "a", "old", "dog", "cat", "ran", "vile", "scum", "sat", "on", "mat", "very"]
    texts = [" ".join(rng.choices(words, k=rng.randrange(1, 25))) for _ in range(90)] + ["unseen words only", ""]
    labels = [int("scum" in t and "vile" in t) for t in texts]
    docs = documents(spark, texts)
    model = toxicity.count_model(docs, toxicity.training_rows(labels_of(spark, [(i, 1, y) for i, y in enumerate(labels)])))
    totals = toxicity._word_totals(model)
    ratios, unknown = toxicity.token_ratios(model, totals)
    named = docs.selectExpr("doc_id AS name", "text", "-1 AS toxic").mapInArrow(toxicity._blocks, toxicity.BLOCK_SCHEMA)
    found = toxicity.text_features(toxicity.settle(named, "t"), ratios, unknown).collect()
    features = plain_model([(t, y) for i, (t, y) in enumerate(zip(texts, labels)) if not held(i)], 3)
    assert sorted(r["name"] for r in found) == list(range(len(texts)))
    for r in found:
        assert [r[f] for f in toxicity.FEATURES] == pytest.approx(features(texts[r["name"]]), rel=1e-4, abs=1e-4)


def plain_scores(spark, docs, labels):
    """Scores by text of ``docs`` (id to text) from labels (id to 0 or 1), all but the counting in plain Python."""
    train = sorted(i for i in labels if i in docs and not held(i))
    features = plain_model([(docs[i] or "", labels[i]) for i in train], toxicity.FREQUENT_PAIR)
    table = labels_of(spark, [(i, 1, labels[i]) for i in train])
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    model = toxicity.Model(toxicity.count_model(frame, toxicity.training_rows(table)).drop("before", "word").toPandas())
    sample = np.array([model.features(toxicity.word_numbers(docs[i]), labels[i]) for i in train])
    known = np.array([labels[i] for i in train], float)
    order = np.lexsort(np.column_stack((sample, known)).T)
    weights = toxicity.fit_weights(sample[order], known[order])
    raw = {i: float(np.clip(np.dot(weights[:-1], features(text or "")) + weights[-1], -30, 30)) for i, text in docs.items()}
    return {i: 1 / (1 + math.exp(-value)) for i, value in raw.items()}


def test_scores_follow_from_features_and_weights(spark):
    """The whole of it: counts, own share taken off, weights and scores, against plain Python."""
    texts, labels = corpus(19, 240)
    table = labels_of(spark, [(i, 1, y) for i, y in enumerate(labels)])
    rows = toxicity.toxicity_scores(documents(spark, texts), table).collect()
    want = plain_scores(spark, dict(enumerate(texts)), dict(enumerate(labels)))
    assert {r["doc_id"]: r["score"] for r in rows} == {i: pytest.approx(score, abs=1e-4) for i, score in want.items()}


def test_a_repeated_labelled_id_is_one_calibration_row(spark):
    docs = documents(spark, ["one text", "other text"] * 40).withColumn("doc_id", F.col("doc_id") % 4)
    labels = toxicity.training_rows(labels_of(spark, [(i, 1, i % 2) for i in range(4)]))
    assert toxicity.calibration_texts(docs, labels).count() == labels.count()


def test_odd_rows(spark):
    docs = odd_documents(spark)
    labels = labels_of(spark, [(0, 1, 1), (0, 1, 0), (None, 1, 1), (3, 1, None), (5, 1, 0), (7, 1, 1), (4, 0, 0), (99, 0, 0)])
    kept = toxicity.reject_toxic(docs, labels)
    assert kept.columns == docs.columns
    scores = toxicity.toxicity_scores(docs, labels).select("score").collect()
    assert len(scores) == docs.count() and all(0 <= r["score"] <= 1 for r in scores)
    none = toxicity.toxicity_scores(docs, labels_of(spark, []))
    assert {r["score"] for r in none.collect()} == {0.0}
    assert toxicity.toxicity_scores(odd_documents(spark, []), labels).count() == 0


def test_every_word_and_pair_has_counts_of_its_own(spark, monkeypatch):
    """More words than any fixed range of numbers; each, and each pair of them, is counted alone."""
    monkeypatch.setattr(toxicity, "FREQUENT_PAIR", 1)
    texts = ["".join(chr(97 + i // 26**k % 26) for k in range(4)) for i in range(150_000)]
    texts = [" ".join(texts[i : i + 500]) for i in range(0, len(texts), 500)]
    train = [i for i in range(len(texts)) if not held(i)]
    labels = labels_of(spark, [(i, 1, i % 2) for i in train])
    got = toxicity.count_model(documents(spark, texts), toxicity.training_rows(labels)).toPandas()
    words = got[got["kind"] == "word"]
    pairs = got[got["kind"] == "pair"]
    assert len(words) == len(pairs) == 500 * len(train)
    assert set(words["ordinary"] + words["toxic"]) == set(pairs["ordinary"] + pairs["toxic"]) == {1}


def test_all_counts_against_plain_counting(spark, monkeypatch):
    """Every sum of every context, word and frequent pair, from many parts and small batches of counts."""
    from collections import Counter

    monkeypatch.setattr(toxicity, "FREQUENT_PAIR", 3)
    monkeypatch.setattr(toxicity, "FLUSH_TOKENS", 200)
    monkeypatch.setattr(toxicity, "PART_BYTES", 1000)
    rng = random.Random(23)
    words = ["the", "a", "old", "dog", "cat", "ran", "vile", "scum", "sat", "on", "mat", "very"]
    words += [f"{a}{b}rare" for a in "bcdfg" for b in "aeiou"]
    texts = [" ".join(rng.choices(words, [5] * 12 + [1] * 25, k=rng.randrange(1, 40))) for _ in range(150)] + ["", "?"]
    labels = [i % 3 == 0 for i in range(len(texts))]
    table = labels_of(spark, [(i, 1, int(y)) for i, y in enumerate(labels)])
    got = toxicity.count_model(documents(spark, texts), toxicity.training_rows(table)).collect()
    pair = [Counter(), Counter()]
    for i, (text, y) in enumerate(zip(texts, labels)):
        if not held(i):
            found = toxicity.word_numbers(text)
            pair[y].update(zip(toxicity.words_before(found).tolist(), found.tolist()))
    want = {}
    for before, word in set(pair[0]) | set(pair[1]):
        counts = [pair[y][before, word] for y in (0, 1)]
        kept = [max(n - 0.75, 0) if sum(counts) >= 3 else 0 for n in counts]
        for key, more in ((("context", before), [*counts, *kept, 0]), (("word", word), [*counts, 0, 0, 1])):
            want[key] = [a + b for a, b in zip(want.get(key, [0] * 5), more)]
        if sum(counts) >= 3:
            want["pair", before, word] = [*counts, 0, 0, 0]
    rows = {(r["kind"], *((r["before"], r["word"]) if r["kind"] == "pair" else (r["bucket"],))): [r[c] for c in toxicity.SUMS] for r in got}
    assert len(rows) == len(got) and rows == want
    pairs = [r for r in got if r["kind"] == "pair"]
    numbers = toxicity._paired(*[np.array([r[c] for r in pairs], np.int64) for c in ("before", "word")])
    assert pairs and numbers.tolist() == [r["bucket"] for r in pairs]


def test_texts_that_need_more_than_the_head_score_the_same(spark, monkeypatch):
    texts, labels = corpus(29, 240)
    texts += ["", "unseen words only", "scumlike"]
    table = labels_of(spark, [(i, 1, y) for i, y in enumerate(labels)])
    docs = documents(spark, texts)
    scores = lambda: {r["doc_id"]: r["score"] for r in toxicity.toxicity_scores(docs, table).collect()}
    want, blocks, put = scores(), [], toxicity.settle
    monkeypatch.setattr(toxicity, "settle", lambda df, label: (blocks.append(label), put(df, label))[1])
    assert scores() == want and "text-blocks" not in blocks
    for rows in (1, 300):
        monkeypatch.setattr(toxicity, "HEAD_ROWS", rows)
        assert scores() == {i: pytest.approx(score, abs=1e-12) for i, score in want.items()}
    assert blocks.count("text-blocks") == 2


def test_pairs_are_counted_without_a_table_of_all(spark, monkeypatch):
    """Of the tables that are stored, none has a row for each pair, most of which occur once."""
    texts, labels = corpus(31, 300)
    sizes, put = {}, toxicity.settle

    def settle(df, label):
        stored = put(df, label)
        sizes[label] = stored.count()
        return stored

    monkeypatch.setattr(toxicity, "settle", settle)
    toxicity.text_scores(documents(spark, texts), labels_of(spark, [(i, 1, y) for i, y in enumerate(labels)]))
    found = [toxicity.word_numbers(t) for i, t in enumerate(texts) if not held(i)]
    assert max(sizes.values()) < len(np.unique(np.concatenate([toxicity.pair_numbers(x) for x in found]))) / 4
