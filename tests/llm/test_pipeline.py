import math
import random
from collections import Counter
from pathlib import Path

import pytest

import __spark_entry__ as driver
import corpus_pipeline
from tillroll.llm import decontaminate, mixing, near_copies, secrets, toxicity
from tillroll.llm.queries import llm_oracles, llm_queries

from cases import documents, odd_documents
from test_mixing import draw
from test_near_copies import alike, classes, collection
from test_secrets import plain_spans
from test_simhash import classes_of, plain_fingerprint
from test_toxicity import plain_scores

SMALL = "/root/testdata/sf0.001"
available = pytest.mark.skipif(not Path(SMALL).exists(), reason="test tables not present")
ORDER = ["toxicity", "simhash_near_dedup", "benchmark_decontamination", "secret_redaction", "source_mixing"]


def without_secrets(text):
    """The text with the runs that base spans cover replaced, found by plain patterns."""
    cuts = sorted((int(s), int(e)) for _, s, e in (span.split(":") for span in plain_spans(text)))
    merged = []
    for start, end in cuts:
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    for start, end in reversed(merged):
        text = text[:start] + "[SECRET]" + text[end:]
    return text


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ORDER


def test_registered():
    names = set(driver.queries())
    assert set(llm_queries()) | {"pipeline"} <= names
    assert {int(name[2:].split("_")[0]) for name in llm_queries()} == set(range(1, 14))
    assert set(llm_oracles()) <= set(llm_queries())


@available
def test_each_stage_against_brute_force(spark):
    """Every stage is held against plain Python over what the stage before it kept."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    rows = {r["doc_id"]: r.asDict() for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)

    labels = {}
    for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect():
        if r["doc_id"] is not None and r["toxic"] is not None:
            labels[r["doc_id"]] = max(int(r["toxic"] > 0), labels.get(r["doc_id"], 0))
    scores = plain_scores(spark, {i: r["text"] for i, r in rows.items()}, labels)
    assert all(abs(score - toxicity.THRESHOLD) > 1e-3 for score in scores.values())
    toxic = {i for i, score in scores.items() if score >= toxicity.THRESHOLD}
    assert toxic
    kept = stages["toxicity"](spark, docs, SMALL)
    assert kept.columns == columns
    rows = {i: r for i, r in rows.items() if i not in toxic}
    assert {r["doc_id"]: r.asDict() for r in kept.collect()} == rows

    table = spark.createDataFrame(list(map(lambda r: tuple(r[c] for c in columns), rows.values())), docs.schema)
    kept = stages["simhash_near_dedup"](spark, table, SMALL)
    ids = sorted(rows)
    least = {ids[place] for place in classes([rows[i]["text"] for i in ids])}
    rows = {i: r for i, r in rows.items() if i in least}
    assert kept.columns == columns
    assert {r["doc_id"]: r.asDict() for r in kept.collect()} == rows

    table = spark.createDataFrame([tuple(r[c] for c in columns) for r in rows.values()], docs.schema)
    kept = stages["benchmark_decontamination"](spark, table, SMALL)
    words = {i: decontaminate.template(r["text"])[0].tolist() for i, r in rows.items()}
    items = [decontaminate.template(r["text"])[0].tolist() for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]

    def holds(text, item):
        have = {tuple(text[i : i + 5]) for i in range(len(text) - 4)}
        want = [tuple(item[i : i + 5]) for i in range(len(item) - 4)]
        return sum(w in have for w in want) >= 0.8 * len(want)

    rows = {i: r for i, r in rows.items() if not any(holds(words[i], item) for item in items)}
    assert kept.columns == columns
    assert {r["doc_id"] for r in kept.collect()} == set(rows)

    table = spark.createDataFrame([tuple(r[c] for c in columns) for r in rows.values()], docs.schema)
    clean = stages["secret_redaction"](spark, table, SMALL)
    assert clean.columns == columns
    for r in clean.collect():
        before = rows[r["doc_id"]]["text"] or ""
        blotted = without_secrets(before)
        if not secrets.context_spans(before, secrets.base_spans(before)):
            assert r["text"] == blotted and r["n_chars"] == len(blotted)
        assert not plain_spans(r["text"])

    mixed = Counter(r["doc_id"] for r in stages["source_mixing"](spark, clean, SMALL).collect())
    sizes = Counter(r["source"] for r in rows.values())
    weights = {source: n**mixing.TEMPERATURE for source, n in sizes.items()}
    expected = Counter()
    for i, r in rows.items():
        share = weights[r["source"]] / sum(weights.values())
        rate = mixing.EPOCHS * len(rows) * share / sizes[r["source"]]
        parts = max(math.ceil(rate / mixing.PART_MEAN), 1)
        expected[i] = sum(draw(42, i, part, rate / parts) for part in range(1, parts + 1))
    assert mixed == +expected


@available
@pytest.mark.parametrize("name", ORDER)
def test_odd_rows(spark, name):
    """Nulls, empty and very long texts, ties, repeated rows, clashing columns and an empty table."""
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = odd_documents(spark)
    found = stage(spark, docs, SMALL)
    last = ["copy", "mix_key"] if name == ORDER[-1] else []
    assert found.columns == [c for c in docs.columns if c not in last] + last
    rows = found.collect()
    if not last:
        kept = Counter((r["doc_id"], r["lang"]) for r in rows)
        assert kept <= Counter((r["doc_id"], r["lang"]) for r in docs.collect())
        assert {0, 2, 3, 4, 7} <= {r["doc_id"] for r in rows}
        assert len(rows) == docs.count() or name == "simhash_near_dedup"
    nothing = stage(spark, odd_documents(spark, []), SMALL)
    assert nothing.columns == found.columns and nothing.count() == 0


def near_duplicates(texts):
    """Pairs linked by SimHash, and by five-word similarity, of all pairs."""
    codes = [plain_fingerprint(x) for x in texts]
    pairs = [(i, j) for j in range(len(texts)) for i in range(j)]
    by_code = {(i, j) for i, j in pairs if (codes[i] ^ codes[j]).bit_count() <= 3}
    return by_code, {(i, j) for i, j in pairs if alike(texts[i], texts[j])}


def refrains(rng):
    """Texts of one fingerprint each, whatever their endings; a short form of the last is its near copy only."""
    texts = []
    for name in ("x", "y", "z"):
        refrain = [f"{name}{i % 3}" for i in range(300)]
        endings = [[f"{name}end{rng.randrange(10**6)}" for _ in range(40)] for _ in range(4)]
        texts += [" ".join(refrain + ending) for ending in endings]
        texts.append(" ".join(refrain[:9] + endings[-1]))
    return texts


def test_near_duplicates_by_simhash_as_well(spark):
    """Texts that SimHash links go although their five-word similarity is low; links of both kinds hold a class together."""
    texts = refrains(random.Random(7)) + collection(9, 25)
    by_code, by_words = near_duplicates(texts)
    assert by_code - by_words and by_words - by_code
    want = classes_of(range(len(texts)), by_code | by_words)
    assert want[4] == want[0] and (0, 4) not in by_code | by_words
    assert len(set(want.values())) < len(set(classes_of(range(len(texts)), by_words).values()))
    kept = dict(corpus_pipeline.STAGES)["simhash_near_dedup"](spark, documents(spark, texts), SMALL)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want.values()))


def test_near_duplicates_by_simhash_without_ids(spark):
    """The row with an id stays; of null ids only, one; a repeated row with the smallest id once."""
    texts = refrains(random.Random(8))
    rows = [(None, texts[0]), (5, texts[1]), (5, texts[1]), (None, texts[5]), (None, texts[6]), (9, "quite other words")]
    docs = odd_documents(spark, [(i, text, "en", "a") for i, text in rows])
    kept = dict(corpus_pipeline.STAGES)["simhash_near_dedup"](spark, docs, SMALL)
    assert kept.columns == docs.columns
    found = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert len(found) == 3 and {(5, texts[1]), (9, "quite other words")} < set(found)
    assert {text for i, text in found if i is None} < {texts[5], texts[6]}


@available
def test_run_is_the_stages(spark):
    result = corpus_pipeline.run(spark, SMALL)
    assert "doc_id" in result.columns and result.count() > 0
    assert corpus_pipeline.ORACLE_SQL is None


def test_operators_have_own_modules():
    assert {m.__name__ for m in (near_copies, toxicity, decontaminate, secrets, mixing)} == {
        f"tillroll.llm.{n}" for n in ("near_copies", "toxicity", "decontaminate", "secrets", "mixing")
    }
