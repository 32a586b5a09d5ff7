import random

from tillroll.llm import decontaminate

from cases import documents, odd_documents


def bench(spark, texts):
    rows = [(i, t, "z", "z") for i, t in texts]
    return spark.createDataFrame(rows, "item_id long, text string, key string, owner string")


ITEM = "A train leaves Oldtown with 40 passengers and after 3 hours it has travelled 250 km to reach Newtown in the north."
OTHER = "Every sparrow on the tall roof sings before dawn while the quiet river carries leaves toward the distant sea shore."


def found(spark, docs, items):
    table = bench(spark, list(enumerate(items)))
    rows = decontaminate.contaminated(documents(spark, docs), table).collect()
    return {(r["doc_id"], r["item_id"]): r for r in rows}


def test_verbatim_and_reparameterised(spark):
    other = ITEM.replace("40", "95").replace("3 hours", "7 days").replace("250 km", "80 miles")
    swapped = other.replace("Oldtown", "Paris").replace("Newtown", "Lyon")
    docs = [f"Before it. {ITEM} After it.", f"Some words. {swapped} More.", ITEM.upper(), "nothing of the kind here at all", f"x {ITEM[:60]} y"]
    rows = found(spark, docs, [ITEM, OTHER])
    assert {k: r["kind"] for k, r in rows.items() if k[1] == 0} == {(0, 0): "verbatim", (1, 0): "reparameterised"} | (
        {(2, 0): "verbatim"} if (2, 0) in rows else {}
    )
    assert not any(item == 1 for _, item in rows)


TOM = "Tom has 5 apples. Tom gives 3 to Ann. Tom buys 12 pears. How many fruits does Tom have?"


def test_names_that_open_sentences(spark):
    """An exchanged name is one throughout, also where it opens a sentence."""
    bob = TOM.replace("Tom", "Bob").replace("5", "8").replace("3", "2").replace("12", "41").replace("Ann", "Eve")
    mixed = "Tom has 5 apples. Bob gives 3 to Ann. Max buys 12 pears. How many fruits does Zoe have?"
    rows = found(spark, [bob, f"Intro words here. {bob} And more.", mixed, "Bob has many pears. How nice they are."], [TOM, ITEM])
    assert {k: r["kind"] for k, r in rows.items()} == {(0, 0): "reparameterised", (1, 0): "reparameterised"}
    assert rows[(0, 0)]["coverage"] == 1.0


def test_texts_in_one_case(spark):
    docs = [t.lower() for t in (TOM, ITEM)] + [t.upper() for t in (TOM, ITEM)]
    rows = found(spark, docs, [TOM, ITEM])
    assert set(rows) == {(0, 0), (1, 1), (2, 0), (3, 1)}
    lower = ITEM.lower().replace("40", "95").replace("250", "80")
    assert set(found(spark, [lower], [ITEM])) == {(0, 0)}


def test_common_windows_are_not_joined_with_every_item(spark, monkeypatch):
    """A window that all items share is asked of none of them; the rare ones are."""
    rng = random.Random(21)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    items = ["what is the value of the sum of " + " ".join(word() for _ in range(12)) for _ in range(60)]
    docs = ["well what is the value of the sum of things " + word() for _ in range(80)] + [f"{word()} {items[7]}"]
    pairs = []
    settled = decontaminate.settle

    def watch(df, label):
        stored = settled(df, label)
        if label == "gate-passed":
            pairs.append(stored.count())
        return stored

    monkeypatch.setattr(decontaminate, "settle", watch)
    assert set(found(spark, docs, items)) == {(80, 7)}
    assert pairs == [1]


def test_the_gate_loses_nothing(spark):
    """Coverage and runs just at the bars, in every place of an item."""
    rng = random.Random(22)
    words = [f"{a}{b}{c}" for a in "bcdf" for b in "aeiou" for c in "klm"]
    items = [" ".join(rng.choices(words, k=k)) for k in (5, 7, 9, 14, 30, 41)]
    docs = []
    for item in items:
        tokens = item.split()
        for start in range(len(tokens)):
            for length in (13, len(tokens) - 1, len(tokens) - 2):
                docs.append(" ".join(["zzz", *tokens[start : start + length], "yyy"]))
    got = set(found(spark, docs, items))
    for d, doc in enumerate(docs):
        have = doc.split()
        held = {tuple(have[i : i + 5]) for i in range(len(have) - 4)}
        for i, item in enumerate(items):
            want = item.split()
            grams = [tuple(want[p : p + 5]) for p in range(len(want) - 4)]
            hit = [g in held for g in grams]
            run = max((len(r) for r in "".join("x" if h else " " for h in hit).split()), default=0)
            assert ((d, i) in got) == (sum(hit) >= 0.8 * len(grams) or run + 4 >= 13)


def test_slots_must_agree(spark):
    item = "take 5 apples then add 5 pears and share 5 plums among 9 friends but keep 5 nuts for 9 others at home"
    good = item.replace("5", "71").replace("9", "12")
    bad = "take 1 apples then add 2 pears and share 3 plums among 4 friends but keep 6 nuts for 7 others at home"
    rows = found(spark, [good, bad], [item])
    assert set(rows) == {(0, 0)}
    assert rows[(0, 0)]["kind"] == "reparameterised" and rows[(0, 0)]["coverage"] == 1.0


def test_numbers_only_meet_where_equal(spark):
    item = " ".join(str(n) for n in range(10, 40))
    rows = found(spark, [item, " ".join(str(n) for n in range(110, 140))], [item])
    assert set(rows) == {(0, 0)}


def test_short_texts(spark):
    rows = found(spark, ["two words", "here two words more to read", "", "two words"], ["two words", ""])
    assert set(rows) == {(0, 0), (3, 0)}


def test_against_brute_force(spark):
    rng = random.Random(10)
    words = [f"{a}{b}" for a in "bcdfghlm" for b in "aeiou"]
    items = [" ".join(rng.choice(words) for _ in range(rng.randrange(8, 40))) for _ in range(12)]
    docs = []
    for _ in range(150):
        text = [rng.choice(words) for _ in range(rng.randrange(120))]
        if rng.random() < 0.5:
            item = rng.choice(items).split()
            cut = item[rng.randrange(3) : len(item) - rng.randrange(12)]
            text[rng.randrange(len(text) + 1) : 0] = cut
        docs.append(" ".join(text))

    def grams(text):
        t = text.split()
        return [tuple(t[i : i + 5]) for i in range(len(t) - 4)]

    expected = set()
    for d, doc in enumerate(docs):
        have = grams(doc)
        for i, item in enumerate(items):
            want = grams(item)
            covered = {p for p, g in enumerate(want) if g in have}
            best = 0
            for shift in range(-len(want), len(have)):
                run = 0
                for p, g in enumerate(want):
                    run = run + 1 if 0 <= p + shift < len(have) and have[p + shift] == g else 0
                    best = max(best, run)
            if len(covered) >= 0.8 * len(want) or best + 4 >= 13:
                expected.add((d, i))
    assert set(found(spark, docs, items)) == expected


def test_odd_rows(spark):
    docs = odd_documents(spark)
    items = bench(spark, [(0, "another text with the id of two"), (None, "no id at all"), (1, None), (2, "")])
    rows = decontaminate.contaminated(docs, items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == {(2, 0), (None, None)}
    clean = decontaminate.drop_contaminated(docs, items)
    assert clean.columns == docs.columns
    left = [(r["doc_id"], r["text"]) for r in clean.collect()]
    assert len(left) == docs.count() - 2 and (2, "one") in left
    assert decontaminate.contaminated(odd_documents(spark, []), items).count() == 0
    assert decontaminate.contaminated(docs, bench(spark, [])).count() == 0
