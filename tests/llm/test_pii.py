import hashlib
import random
import re

from tillroll.llm import pii

from cases import documents, odd_documents

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(value):
    digits = [int(c) for c in value if c.isdigit()][::-1]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


def holds(kind, value):
    n = sum(c.isdigit() for c in value)
    if kind == "ip":
        return all(int(part) <= 255 for part in value.split("."))
    if kind == "card":
        return 12 <= n <= 19 and luhn(value)
    return kind != "phone" or 9 <= n <= 15


def plain_spans(text):
    found = [
        (m.start(), place, kind, m.end())
        for place, (kind, pattern) in enumerate(PLAIN.items())
        for m in re.finditer(pattern, text or "")
        if holds(kind, m[0])
    ]
    return [f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found)]


def checked(rows, texts):
    for row, text in zip(sorted(rows, key=lambda r: r["doc_id"]), texts):
        spans = plain_spans(text)
        assert row["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest(), text
        counts = [sum(s.startswith(kind) for s in spans) for kind in PLAIN]
        assert [row[f"n_{kind}"] for kind in PLAIN] == counts, text
        assert set(spans) <= set(row["spans"].split(",") if row["spans"] else [])


HAND = [
    "a@b.c_d@e.f x@y z@@q.r .@-.- a@b..c é@é.fr mail:über@x.de",
    "1.2.3.4.5.6.7.8 256.1.1.1 0255.1.1.001 1.2.3 9.9.9.9. 1..2.3.4 000.0.0.0",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111  1111 41111111111111110000000 0000000000000",
    "+1 (499) 555-6503 +1 +12 +1((((((((((( +49.30.123456-7 ++49 30 1234567 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6",
    "𝒳𝒳 4111111111111111 𝒳 a@b.co ~ 1.1.1.1 \r\n +4912345678901",
    "0 0 0 0 0 0 0 0 0 0 0 0-0 1- 2 -3 4--5",
    "12345678901234567890123456789012345678901 5 4111111111111111",
    "", "no data here", "@", "+", ".", "1.1.1.1@x.y 1.1.1.1", "4111111111111111@x.y",
]


def test_base_spans_by_hand(spark):
    checked(pii.personal_data(documents(spark, HAND)).collect(), HAND)


def test_base_spans_on_random_strings(spark):
    rng = random.Random(5)
    texts = [
        "".join(rng.choice("0123456789..--  @+()aZé%_") for _ in range(rng.randrange(120))) for _ in range(400)
    ]
    texts += ["".join(rng.choice("01 -.+") for _ in range(rng.randrange(80))) for _ in range(400)]
    checked(pii.personal_data(documents(spark, texts)).collect(), texts)


def test_long_runs(spark):
    runs = ["a" * 50_000, "1" * 50_000, "a." * 25_000, "1 " * 25_000, "12345 " * 10_000]
    runs += ["a@b.c " * 10_000, "+1" + "(" * 50_000, "a@" + "b." * 25_000, "4111111111111111 " * 3000]
    checked(pii.personal_data(documents(spark, runs)).collect(), runs)


def test_patterns_discover_unseen_identifiers(spark):
    rng = random.Random(6)

    def card():
        head = "".join(rng.choice("0123456789") for _ in range(15))
        return next(head + d for d in "0123456789" if luhn(head + d))

    good = [f"please charge cardno {card()} soon" for _ in range(40)]
    wrong = card()
    wrong = wrong[:-1] + str((int(wrong[-1]) + 1) % 10)
    unseen = [f"please charge cardno {wrong} soon"]
    other = [f"order number {rng.randrange(10**9, 10**10)} shipped" for _ in range(40)]
    rows = {r["doc_id"]: r for r in pii.personal_data(documents(spark, good + unseen + other)).collect()}
    start = unseen[0].index(wrong)
    assert rows[40]["spans"] == f"card:{start}:{start + 16}"
    assert rows[40]["n_card"] == 0 and rows[40]["n_added"] == 1
    assert all(rows[i]["n_added"] == 0 for i in rows if i != 40)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = pii.personal_data(docs).collect()
    assert len(rows) == docs.count()
    seven = next(r for r in rows if r["doc_id"] == 7)
    assert (seven["n_email"], seven["n_card"]) == (1, 1)
    assert pii.personal_data(odd_documents(spark, [])).count() == 0


def test_no_python(spark):
    plan = pii._scan(documents(spark, HAND))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan
