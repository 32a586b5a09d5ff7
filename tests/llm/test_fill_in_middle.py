import hashlib
import random
import re

import pytest

from tillroll.llm import fill_in_middle as fim

from cases import documents, odd_documents

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(name, text):
    text = text or ""
    h = [int(hashlib.sha256(f"42:{name}".encode()).hexdigest()[i : i + 8], 16) for i in (0, 8, 16, 24)]
    tokens = TOKEN.findall(text)
    n = len(tokens)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(part) for part in (tokens[:a], tokens[a:b], tokens[b:]))
    if h[3] % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def random_texts():
    rng = random.Random(3)
    pool = ["a", "bc", " ", "  ", "\n", "\t", "é", "😀", "\x0b", "\x85", " ", "<", "P>", "<S", "<P>", ">"]
    weights = [8, 8, 8, 2, 3, 1, 2, 2, 1, 1, 1, 1, 1, 1, 0.2, 1]
    return ["".join(rng.choices(pool, weights, k=rng.randrange(40))) for _ in range(1500)]


def test_tokens():
    for text in random_texts():
        ends = [m.end() for m in TOKEN.finditer(text)]
        assert fim.token_ends(text) == ends


def test_cut_and_inverse():
    whole = fim.Piece(0, 0, 10)
    assert fim.cut(whole, (3, 3)) == [(0, 0, 3), (0, 3, 3), (0, 3, 10)]
    for order in fim.ARRANGEMENTS.values():
        pieces = list("abcdef")
        assert fim.permuted(fim.permuted(pieces, order), fim.inverse(order)) == pieces


def test_operator_against_brute_force(spark):
    texts = random_texts()
    rows = fim.fill_in_middle(documents(spark, texts)).select(
        "doc_id", "text", "infill.*", fim.restored("infill.output", "infill.form").alias("back"),
        fim.restored_digest("infill.output", "infill.form").alias("back_sha256"),
    ).collect()
    forms = set()
    for r in rows:
        n, form, prefix, middle, output = brute(r["doc_id"], r["text"])
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == (
            n, form, prefix, middle, output,
        )
        spelled = "".join(("<P><S><M>" if p["buffer"] else r["text"])[p["start"] : p["end"]] for p in r["pieces"])
        assert spelled == output and r["back"] == r["text"]
        assert r["output_sha256"] == hashlib.sha256(output.encode()).hexdigest()
        assert r["back_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()
        forms.add(form)
    assert len(rows) == len(texts) and forms == {"plain", "psm", "spm"}


@pytest.mark.parametrize("form", ["psm", "spm"])
def test_marks_beside_angle_brackets(form):
    """Text that ends or begins with part of a mark does not move the marks."""
    for text in ("<", "a <S", "P>b", "x < P>", "M><"):
        for low in range(len(text) + 1):
            pieces = fim.cut(fim.Piece(0, 0, len(text)), (low, len(text))) + fim._MARK_PIECES
            output = "".join(fim.strings(fim.permuted(pieces, fim.ARRANGEMENTS[form]), text))
            assert "".join(fim.strings(fim.restored_pieces(output, form), output)) == text


def test_odd_rows(spark):
    docs = odd_documents(spark)
    made = fim.fill_in_middle(docs)
    assert made.columns == [*docs.columns, "infill"]
    rows = made.collect()
    assert len(rows) == docs.count()
    for r in rows:
        name = "" if r["doc_id"] is None else r["doc_id"]
        i = r["infill"]
        assert (i["n"], i["form"], i["prefix_chars"], i["middle_chars"], i["output"]) == brute(name, r["text"])
    assert len({str(r["infill"]) for r in rows if r["doc_id"] == 4}) == 1
    assert fim.fill_in_middle(odd_documents(spark, [])).count() == 0
    assert fim.fill_in_middle(made).columns == made.columns
