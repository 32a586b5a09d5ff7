"""Personal data: fixed patterns, and bootstrapped patterns of the context.

The base kinds (email, ip, card, phone) are found by pattern. Their values are seeds. Every
identifier-like string of the corpus, seed or not, is an instance that stands in lexical patterns:
the word to its left and the word to its right. Over this graph two scores are worked out in
turn. A pattern is as sure of a kind as the share of its instances that belong to the kind; an
instance is as sure as its patterns together make it (noisy-or). After ``ROUNDS`` rounds, instances
outside the base kinds that reach ``SURE`` are added with the kind of their patterns.

All of it is DataFrame work. The text is read once; what goes on from there are the found strings
with a word on each side. A pattern such as "the" or a string that stands everywhere is counted
before the shuffle, and both sides of each join are stored tables, of which Spark can split a
partition with a very frequent key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import settle
from tillroll.llm.simhash import text_hash

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 2
#: Least certainty of an added instance, and of the patterns that may speak for it.
SURE = 0.9
PATTERN_SURE = 0.8
#: Distinct instances a pattern must have seen of a kind.
SUPPORT = 5
#: A pattern's instances are counted as if one more, of no kind, stood in it.
DOUBT = 1.0
MIN_LENGTH = 5
#: Matches that one block of the place count holds.
BLOCK = 256

# The patterns give the leftmost non-overlapping matches of the plain ones, in time that grows
# with the text: a start is only tried where a run begins or the last match ended, runs are taken
# whole, and of digit groups only those of a fitting length are matched at all.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
PATTERNS = dict(zip(KINDS, (EMAIL, IP, CARD, PHONE)))
HINTS = {"email": "@", "ip": ".", "phone": "+"}
OTHER = r"(?<![A-Za-z0-9])(?=[A-Za-z0-9./_:-]{5})[A-Za-z]{0,8}+[0-9][A-Za-z0-9]*+(?:[-./_:][A-Za-z0-9]++)*+"
INSTANCE = f"(?:{PHONE})|(?:{EMAIL})|(?:{CARD})|(?:{OTHER})"
_BYTE_PART = r"0*+(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])?"
_PIECES = "array<struct<value:string,size:int,gap:int,head:string,tail:string>>"
#: The first and the last word of a gap, whole.
_FIRST_WORD, _LAST_WORD = r"^\s*+(\S++)", r"(?<!\S)(\S++)\s*+$"
_SPAN = "array<struct<start:int,end:int,value:string>>"


def _pieces(text: F.Column, pattern: str, wanted: F.Column, words: bool = False) -> F.Column:
    """Matches of a pattern, each with the gap before it, and the gap after the last one.

    With ``words``, the words that begin and end each gap come with it.
    """

    def word(gap: F.Column, form: str) -> F.Column:
        return F.lower(F.regexp_extract(gap, form, 1)) if words else F.lit("")

    found, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    both = F.zip_with(
        found,
        gaps,
        lambda v, g: F.struct(
            v.alias("value"),
            F.coalesce(F.length(v), F.lit(0)).alias("size"),
            F.length(g).alias("gap"),
            word(g, _FIRST_WORD).alias("head"),
            word(g, _LAST_WORD).alias("tail"),
        ),
    )
    return F.when(wanted, both).otherwise(F.array().cast(_PIECES))


def _located(pieces: str) -> F.Column:
    """Matches with their places, in code points: lengths of gaps and matches added up.

    Adding to an array copies it, so matches are worked through in blocks: the time grows with
    the number of matches, not with its square.
    """
    both = F.col(pieces)
    blocks = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(both) - 1, F.lit(0)), F.lit(BLOCK)),
        lambda at: F.slice(both, at + 1, F.lit(BLOCK)),
    )
    empty = F.array().cast(_SPAN)

    def step(s: F.Column, x: F.Column) -> F.Column:
        begin = s["at"] + x["gap"]
        end = begin + x["size"]
        span = F.array(F.struct(begin.alias("start"), end.alias("end"), x["value"].alias("value")))
        out = F.when(x["value"].isNull(), s["out"]).otherwise(F.concat(s["out"], span))
        return F.struct(end.alias("at"), out.cast(_SPAN).alias("out"))

    def block(s: F.Column, xs: F.Column) -> F.Column:
        size = F.aggregate(xs, F.lit(0), lambda total, x: total + x["gap"] + x["size"])
        start = F.struct(s["at"].alias("at"), empty.alias("out"))
        spans = F.array(F.aggregate(xs, start, step)["out"])
        out = F.concat(s["out"], spans).cast(f"array<{_SPAN}>")
        return F.struct((s["at"] + size).alias("at"), out.alias("out"))

    nothing = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("out"))
    return F.flatten(F.aggregate(blocks, nothing, block)["out"])


def _digits(value: F.Column) -> F.Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: F.Column) -> F.Column:
    """Whether the digits (19 at most) pass the Luhn check; zeros in front change nothing."""
    padded = F.lpad(_digits(value), 20, "0")

    def add(total: F.Column, at: F.Column) -> F.Column:
        digit = F.substring(padded, at, F.lit(1)).cast("int")
        twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(at % 2 == 1, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.lit(20)), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: F.Column) -> F.Column:
    if kind == "ip":
        return value.rlike(rf"^{_BYTE_PART}(?:\.{_BYTE_PART}){{3}}$")
    if kind == "card":
        return luhn(value)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def seed_kind(value: F.Column) -> F.Column:
    """The base kind that a whole string is, if any."""
    out = F.lit(None).cast("string")
    for kind in reversed(KINDS):
        out = F.when(value.rlike(f"^(?:{PATTERNS[kind]})$") & _valid(kind, value), kind).otherwise(out)
    return out


def _base_spans(kind: str) -> F.Column:
    return F.filter(_located(kind), lambda s: _valid(kind, s["value"]))


def _scan(docs: DataFrame) -> DataFrame:
    """One pass over the texts: base spans per row, and instances with their contexts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text_hash("text").alias("text_hash"), text.alias("text"))
    digit = F.col("text").rlike("[0-9]")
    pieces = []
    for kind in KINDS:
        hint = F.contains("text", F.lit(HINTS[kind])) if kind in HINTS else F.lit(True)
        hint = hint if kind == "email" else hint & digit
        pieces.append(_pieces(F.col("text"), PATTERNS[kind], hint).alias(kind))
    wanted = digit | F.contains("text", F.lit("@"))
    pieces.append(_pieces(F.col("text"), INSTANCE, wanted, words=True).alias("pieces"))
    rows = rows.select("doc_id", "text_hash", *pieces)
    base = [_base_spans(kind).alias(kind) for kind in KINDS]
    left = F.transform("pieces", lambda x: x["tail"])
    after = F.slice(F.col("pieces"), F.lit(2), F.greatest(F.size("pieces"), F.lit(1)))
    right = F.transform(after, lambda x: x["head"])
    spans = _located("pieces")
    instances = F.arrays_zip(spans.alias("span"), left.alias("left"), right.alias("right"))
    kept = F.filter(
        instances, lambda x: x["span"].isNotNull() & (F.length(x["span"]["value"]) >= MIN_LENGTH)
    )
    return rows.select("doc_id", "text_hash", *base, kept.alias("instances"))


def _edges(scanned: DataFrame) -> DataFrame:
    """``instance, pattern, n``: how often a string stands in a pattern."""
    one = scanned.select(F.explode("instances").alias("x"))
    patterns = F.array(
        F.concat(F.lit("< "), F.col("x.left")), F.concat(F.lit("> "), F.col("x.right"))
    )
    pairs = one.select(F.lower("x.span.value").alias("instance"), F.explode(patterns).alias("pattern"))
    return (
        pairs.filter(F.length("pattern") > 2)
        .groupBy("instance", "pattern")
        .agg(F.count(F.lit(1)).cast("double").alias("n"))
    )


def _pattern_scores(edges: DataFrame, instances: DataFrame) -> DataFrame:
    """``pattern`` and its certainty of each kind, of patterns that are sure of one."""
    named = instances.withColumnRenamed("instance", "name")
    joined = edges.join(named, edges["instance"] == named["name"], "left")
    sums = [F.sum(F.col("n") * F.coalesce(kind, F.lit(0.0))).alias(kind) for kind in KINDS]
    support = [F.count_if(F.col(kind) > 0).alias(f"{kind}_n") for kind in KINDS]
    summed = joined.groupBy("pattern").agg(F.sum("n").alias("all_n"), *sums, *support)
    scores = [
        F.when(F.col(f"{kind}_n") >= SUPPORT, F.col(kind) / (F.col("all_n") + DOUBT))
        .otherwise(0.0)
        .alias(kind)
        for kind in KINDS
    ]
    return summed.select("pattern", *scores).filter(F.greatest(*KINDS) >= PATTERN_SURE)


def _instance_scores(edges: DataFrame, patterns: DataFrame, seeds: DataFrame) -> DataFrame:
    """Seeds with certainty one, and other instances by noisy-or over their sure patterns."""
    named = patterns.withColumnRenamed("pattern", "name")
    joined = edges.join(named, edges["pattern"] == named["name"])
    doubt = [F.sum(F.log(F.greatest(1 - F.col(kind), F.lit(1e-9)))).alias(kind) for kind in KINDS]
    voted = joined.groupBy("instance").agg(*doubt)
    scored = voted.select("instance", *[(1 - F.exp(F.col(kind))).alias(kind) for kind in KINDS])
    fresh = scored.join(seeds.select("instance"), "instance", "left_anti")
    return seeds.unionByName(fresh)


def _discovered(scanned: DataFrame, rounds: int) -> DataFrame:
    """``instance, kind`` of the strings that the patterns add to the base kinds."""
    edges = settle(_edges(scanned), "pattern-graph")
    kinds = edges.select("instance").distinct().withColumn("kind", seed_kind(F.col("instance")))
    of_kind = [(F.col("kind") == kind).cast("double").alias(kind) for kind in KINDS]
    seeds = settle(kinds.filter("kind is not null").select("instance", *of_kind), "seeds")
    instances = seeds
    for _ in range(rounds):
        patterns = settle(_pattern_scores(edges, instances), "pattern-scores")
        instances = settle(_instance_scores(edges, patterns, seeds), "instance-scores")
    best = F.array_max(F.array(*[F.struct(F.col(k).alias("score"), F.lit(k).alias("kind")) for k in KINDS]))
    chosen = instances.join(seeds.select("instance"), "instance", "left_anti").select(
        F.col("instance").alias("name"), best.alias("best")
    )
    return chosen.filter(F.col("best.score") >= SURE).select("name", "best.kind")


def _written(spans: F.Column) -> F.Column:
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )


def _ordered(*parts: F.Column) -> F.Column:
    """Spans by start, then kind as listed."""
    return F.array_sort(F.concat(*parts))


def _kinded(kind: str) -> F.Column:
    return F.transform(
        kind,
        lambda s: F.struct(
            s["start"].alias("start"),
            F.lit(KINDS.index(kind)).alias("place"),
            F.lit(kind).alias("kind"),
            s["end"].alias("end"),
        ),
    )


def personal_data(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id``, counts of the base kinds, digest of the base spans, all spans, ``n_added``.

    Spans are ``kind:start:end`` in code points, ends exclusive, by start and then kind. Added
    spans never overlap base ones. A null or empty text has no spans; repeated rows and null ids
    give rows like any other; an empty table gives none. Other columns are ignored, whatever
    their names.
    """
    base = _ordered(*[_kinded(kind) for kind in KINDS])
    scanned = settle(_scan(docs), "scanned-texts").withColumn("base", base)
    found = settle(_discovered(scanned, rounds), "discovered")
    one = scanned.select("doc_id", "text_hash", "base", F.explode("instances").alias("x")).select(
        F.col("doc_id").alias("own_id"), F.col("text_hash").alias("own_hash"), "base",
        F.lower("x.span.value").alias("instance"), "x.span.start", "x.span.end",
    )
    free = ~F.exists("base", lambda s: (s["start"] < F.col("end")) & (F.col("start") < s["end"]))
    place = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int") - 1
    added = (
        one.join(found, one["instance"] == found["name"])
        .filter(free)
        .groupBy("own_id", "own_hash")
        .agg(F.collect_set(F.struct("start", place.alias("place"), "kind", "end")).alias("added"))
    )
    added = settle(added, "added-spans")
    same = scanned["doc_id"].eqNullSafe(added["own_id"]) & (scanned["text_hash"] == added["own_hash"])
    joined = scanned.drop("instances").join(added, same, "left")
    more = F.coalesce("added", F.array().cast(scanned.schema["base"].dataType))
    return joined.select(
        "doc_id",
        *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS],
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
        _written(_ordered(F.col("base"), more)).alias("spans"),
        F.size(more).cast("long").alias("n_added"),
    )
