"""Secrets: fixed patterns, and guess costs of values that stand in credential contexts.

The base kinds are found by pattern. Beyond them, a value named like a credential (``pwd = ...``,
``passphrase: ...``) is held to be a secret if guessing it is dear: a dynamic program cuts the
value into words, dates, repeats, keyboard walks, sequences and brute-force spans, so that the
product of the guesses is smallest. Words that stand for a secret (``changeme``) or plain words
stay cheap and are left alone; random values are dear.

The words are those of the corpus. A word that stands in a share p of all places where documents
hold different words takes at most 1/p guesses of someone who tries frequent words first. Only words
that the values themselves may be cut into are counted, over all documents, and outside of such
values, so that copies of a document do not make a word of its secret. Texts without such a value
are worked on by themselves.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Collection, Iterator, Mapping
from types import MappingProxyType

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from tillroll.llm.common import key_filter, let_through, settle

KINDS = ("assign", "access", "hex")
#: Values with at least this many guesses, as a power of ten, are secrets.
MIN_GUESSES_LOG10 = 10.0
MIN_VALUE = 8
#: Documents a word must stand in before it counts as one.
FREQUENT_WORD = 3
#: Dictionary words are looked up to this length; longer words are cut.
MAX_WORD = 16

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
#: Names of credentials beyond those of the base kind, and what may stand before the value.
_CONTEXT_NAMES = (
    "passphrase", "passcode", "pwd", "credential", "private_key", "private-key", "access_key",
    "access-key", "client_key", "auth_key", "bearer", "authorization", "password", "passwd",
    "secret", "token", "apikey", "api_key", "api-key",
)
_CONTEXT = re.compile(
    rf"""(?<![A-Za-z0-9])(?:{"|".join(_CONTEXT_NAMES)})s?["']?(?:\x20{{0,4}}(?:=>|[:=])\x20{{0,4}}|\x20is:?\x20{{1,4}})["']?([^\s"',;<>]+)""",
    re.ASCII | re.IGNORECASE,
)

#: Common words and words of bad passwords, most frequent first: the rank is the number of guesses.
COMMON_WORDS = (
    "password the and you that was for are with his they this have from one had word but not what "
    "all were when your can said there use each which she how their will other about out many "
    "then them these some her would make like him into time has look two more write see number "
    "way could people than first water been call who oil now find long down day did get come made "
    "may part admin welcome letmein login master dragon monkey football baseball sunshine princess "
    "shadow superman michael jordan summer winter spring autumn hello secret love money test guest "
    "root user default changeme example sample none null true false placeholder your here xxx key "
    "token value string required hidden redacted config server service public private access"
).split()
_RANK = {word: rank for rank, word in reversed(list(enumerate(COMMON_WORDS, 1)))}
_KEY_ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
_PLACE = {c: (r, i) for r, row in enumerate(_KEY_ROWS) for i, c in enumerate(row)}
_LEET = str.maketrans("4@3105$7", "aaeiosst")
_DATE = re.compile(
    r"(?:19|20)\d\d(?:[-/._]?(?:0[1-9]|1[0-2])(?:[-/._]?(?:0[1-9]|[12]\d|3[01]))?)?"
    r"|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)\d\d"
)
_WORD = re.compile(r"[^\W\d_]+")
_LOG_DATE = math.log10(365 * 120)
_LOG_START = math.log10(47)


def _brute(c: str) -> float:
    """Guesses, as a power of ten, of one character met on its own."""
    if c.isdigit():
        return 1.0
    if c.isascii() and c.isalpha():
        return math.log10(26)
    return math.log10(33)


def _spread(value: str, joined) -> list[int]:
    """For each place, where the longest run of neighbours for which ``joined`` holds ends."""
    n = len(value)
    ends = [n] * n
    for i in range(n - 2, -1, -1):
        ends[i] = ends[i + 1] if joined(value[i], value[i + 1]) else i + 1
    return ends


def _beside(a: str, b: str) -> bool:
    p, q = _PLACE.get(a), _PLACE.get(b)
    return p is not None and q is not None and a != b and max(abs(p[0] - q[0]), abs(p[1] - q[1])) <= 1


def guess_cost(value: str, words: Mapping[str, float] = MappingProxyType({})) -> float:
    """Least guesses, as a power of ten, over all cuts of ``value`` into known spans.

    ``words`` has the guesses, as powers of ten, of words beyond ``COMMON_WORDS``.

    A brute-force span pays for each of its characters; a known span pays its own cost and one
    guess in ten for being chosen. The program is linear in the length: words are of bounded
    length, and of a run (repeat, walk, sequence) each place has one longest end.
    """
    n = len(value)
    low = value.lower()
    plain = low.translate(_LEET)
    repeats = _spread(low, lambda a, b: a == b)
    walks = _spread(low, _beside)
    rising = _spread(low, lambda a, b: ord(b) - ord(a) == 1)
    falling = _spread(low, lambda a, b: ord(a) - ord(b) == 1)
    best = [0.0] + [math.inf] * n
    for i in range(n):
        here = best[i]
        best[i + 1] = min(best[i + 1], here + _brute(value[i]))
        for j in range(i + 2, min(n, i + MAX_WORD) + 1):
            part = value[i:j]
            case = 0.0 if part == low[i:j] or part.isupper() or part.istitle() else j - i
            for word, leet in {plain[i:j]: math.log10(2), low[i:j]: 0.0}.items():
                rank = _RANK.get(word)
                known = math.inf if rank is None else math.log10(rank + 1)
                cost = min(known, words.get(word, math.inf)) + leet + case * math.log10(2)
                best[j] = min(best[j], here + cost + 1)
        for ends, start in ((repeats, _brute(value[i])), (walks, _LOG_START), (rising, 1.0), (falling, 1.3)):
            j = ends[i]
            if j - i >= 3:
                best[j] = min(best[j], here + start + math.log10(j - i) + 1)
        if date := _DATE.match(value, i):
            j = date.end()
            best[j] = min(best[j], here + (_LOG_DATE if j - i > 4 else 2.1) + 1)
    return best[n]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base kinds; each is the whole match, ends are exclusive."""
    lower = text.lower()
    found = []
    if any(name in lower for name in ("passw", "secret", "token", "api")):
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def context_spans(text: str, known: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Values in a credential context, outside the known spans: the value, its start and end."""
    lower = text.lower()
    if not any(name in lower for name in _CONTEXT_NAMES):
        return []
    found = []
    for m in _CONTEXT.finditer(text):
        start = m.start(1)
        value = m[1].rstrip(".!?:)]}*#%&$")
        end = start + len(value)
        if len(value) >= MIN_VALUE and not any(s < end and start < e for _, s, e in known):
            found.append((value, start, end))
    return found


def parts_of(value: str) -> set[str]:
    """The words that a value may be cut into: runs of three letters or more, also behind usual swaps."""
    low = value.lower()
    return {
        form[i:j]
        for form in (low, low.translate(_LEET))
        for i in range(len(form))
        for j in range(i + 3, min(len(form), i + MAX_WORD) + 1)
        if form[i:j].isalpha()
    }


def corpus_words(text: str) -> set[str]:
    """The different words of a text outside the values that stand in a credential context."""
    out, at = [], 0
    for _, start, end in context_spans(text, []):
        out.append(text[at:start])
        at = end
    return set(_WORD.findall(" ".join([*out, text[at:]]).lower()))


def _written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


RESULT = StructType(
    [
        *[StructField(f"n_{kind}", LongType()) for kind in KINDS],
        StructField("base_sha256", StringType()),
        StructField("spans", StringType()),
        StructField("n_guess", LongType()),
    ]
)


def guessed_spans(text: str, known: list[tuple[str, int, int]], dear: Collection[str]) -> list[tuple[str, int, int]]:
    """Those of the values in a credential context that are ``dear`` to guess."""
    return [("guess", start, end) for value, start, end in context_spans(text, known) if value in dear] if len(dear) else []


BODY = StructType([StructField("body", StringType())])


def _listed(texts: pd.Series, dear: pd.Series) -> pd.DataFrame:
    """The columns of ``RESULT`` for texts and the dear values in each."""
    rows = []
    for text, values in zip(texts, dear):
        text = text or ""
        base = base_spans(text)
        more = guessed_spans(text, base, values)
        order = (*KINDS, "guess")
        spans = sorted(base + more, key=lambda s: (s[1], order.index(s[0])))
        counts = [sum(s[0] == kind for s in base) for kind in KINDS]
        digest = hashlib.sha256(_written(base).encode()).hexdigest()
        rows.append((*counts, digest, _written(spans), len(more)))
    return pd.DataFrame(rows, columns=RESULT.names)


def _redacted(texts: pd.Series, dear: pd.Series) -> pd.DataFrame:
    """The texts with secrets blotted out."""
    out = []
    for text, values in zip(texts, dear):
        if text:
            base = base_spans(text)
            merged: list[list[int]] = []
            for _, start, end in sorted(base + guessed_spans(text, base, values), key=lambda s: s[1]):
                if merged and start < merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], end)
                else:
                    merged.append([start, end])
            for start, end in reversed(merged):
                text = f"{text[:start]}[SECRET]{text[end:]}"
        out.append(text)
    return pd.DataFrame({"body": pd.Series(out, dtype=object)})


def _values_in(texts: pd.Series) -> pd.Series:
    return pd.Series([[v for v, *_ in context_spans(x, base_spans(x))] if x else [] for x in texts], dtype=object)


# Not pushed below its own result: a filter on it would run it in a second Python step of the same task.
_context_values = F.pandas_udf(_values_in, ArrayType(StringType())).asNondeterministic()


def _first_look(work, kind: StructType):
    """The values in a credential context, ``found``, beside what ``work`` gives where none of them is dear.

    Both come from one Python worker: a task with two such steps in a row holds two workers, which stay
    with the executor afterwards.
    """

    def look(texts: pd.Series) -> pd.DataFrame:
        plain = work(texts, pd.Series([()] * len(texts), dtype=object))
        return pd.DataFrame({"found": _values_in(texts), **plain})

    # See ``_context_values``.
    fields = [StructField("found", ArrayType(StringType())), *kind.fields]
    return F.pandas_udf(look, StructType(fields)).asNondeterministic()


@F.pandas_udf(ArrayType(StringType()))
def _parts(values: pd.Series) -> pd.Series:
    return pd.Series([sorted(parts_of(value)) for value in values], dtype=object)


@F.pandas_udf(DoubleType())
def _costs(values: pd.Series, words: pd.Series, counts: pd.Series, totals: pd.Series) -> pd.Series:
    out = []
    for value, parts, seen, total in zip(values, words, counts, totals):
        guesses = {w: math.log10(total / n) for w, n in zip(parts, seen)}
        out.append(guess_cost(value, guesses))
    return pd.Series(out, dtype="float64")


def _word_counts(bits):
    """In how many documents each word stands that may be asked for, and, as the empty word, the sum over all words."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: Counter[str] = Counter()
            for text in batch.column("text").to_pylist():
                words = corpus_words(text or "")
                held[""] += len(words)
                held.update(w for w in words if 2 < len(w) <= MAX_WORD)
            words = list(held)
            keys = np.array([_word_key(w) for w in words], np.int64)
            here = let_through(bits.value, keys)
            here[0] = True
            kept = [w for w, keep in zip(words, here.tolist()) if keep]
            yield pa.RecordBatch.from_pydict({"word": kept, "n": [held[w] for w in kept]})

    return counts


def _word_key(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), 42) - (1 << 63)


@F.pandas_udf(LongType())
def _word_keys(words: pd.Series) -> pd.Series:
    return pd.Series([_word_key(w) for w in words], dtype="int64")


def dear_values(texts: DataFrame, values: DataFrame) -> DataFrame:
    """The stored, distinct ``values`` (column value) that are dear to guess, by the words of all ``texts``."""
    spark = texts.sparkSession
    parts = settle(values.select("value", F.explode(_parts("value")).alias("word")), "value-parts")
    bits = key_filter(parts.select("word").distinct().select(_word_keys("word").alias("key")))
    shared = spark.sparkContext.broadcast(bits)
    seen = texts.select("text").mapInArrow(_word_counts(shared), "word string, n long")
    seen = settle(seen.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    total = seen.filter("word = ''").agg(F.coalesce(F.max("n"), F.lit(1)).alias("total"))
    known = (
        parts.join(seen.filter(F.col("n") >= FREQUENT_WORD), "word")
        .groupBy("value")
        .agg(F.collect_list("word").alias("words"), F.collect_list("n").alias("counts"))
    )
    asked = values.join(known, "value", "left").crossJoin(total)
    nothing = F.array().cast("array<string>"), F.array().cast("array<long>")
    cost = _costs("value", F.coalesce("words", nothing[0]), F.coalesce("counts", nothing[1]), "total")
    return settle(asked.select("value", cost.alias("cost")).filter(F.col("cost") >= MIN_GUESSES_LOG10), "dear-values")


def _with_context(rows: DataFrame) -> DataFrame:
    """The rows with a value in a credential context in ``body_in``, these values, and a number."""
    found = rows.withColumn("found", _context_values("body_in")).filter(F.size("found") > 0)
    return found.withColumn("row", F.monotonically_increasing_id())


def _worked_on(docs: DataFrame, work, kind: StructType) -> DataFrame:
    """The rows of ``docs`` as columns c0, c1, ..., with the columns ``kind`` that ``work`` makes of the texts.

    Only rows that hold a value in a credential context meet the table of values.
    """
    columns = [F.col(f"`{name}`").alias(f"c{i}") for i, name in enumerate(docs.columns)]
    rows = docs.select(*columns, F.col("text").alias("body_in"))
    kept = rows.columns[:-1]
    seen = rows.select(*kept, _first_look(work, kind)("body_in").alias("seen"))
    plain = seen.filter(F.size("seen.found") == 0).select(*kept, *[f"seen.{name}" for name in kind.names])
    held = settle(_with_context(rows), "context-rows")
    if held.isEmpty():
        return plain
    placed = held.select("row", F.explode(F.array_distinct("found")).alias("value"))
    values = settle(placed.select("value").distinct(), "context-values")
    dear = placed.join(dear_values(docs, values), "value").groupBy("row").agg(F.collect_list("value").alias("values"))
    none = F.array().cast("array<string>")
    done = F.pandas_udf(work, kind)("body_in", F.coalesce("values", none))
    met = held.join(dear, "row", "left").select(*kept, done.alias("done"))
    return plain.unionByName(met.select(*kept, "done.*"))


def secret_spans(docs: DataFrame) -> DataFrame:
    """``doc_id`` and, per row, counts of the base kinds, digest of the base spans, all spans.

    Spans are ``kind:start:end`` in code points, ends exclusive, by start and then kind. A null
    or empty text has none; a text of any length is read whole. Repeated rows and null ids give rows
    like any other; an empty table gives no rows. Other columns are ignored, whatever their names.
    """
    rows = _worked_on(docs.select("doc_id", "text"), _listed, RESULT)
    return rows.select(F.col("c0").alias("doc_id"), *RESULT.names)


def redact_secrets(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with every secret in ``text`` replaced by ``[SECRET]``.

    No row goes, since the rest of a text is as good as before. Null texts stay null; a column
    ``n_chars`` is brought up to date.
    """
    names = docs.columns
    rows = _worked_on(docs, _redacted, BODY)
    places = [F.col(f"c{i}") for i in range(len(names))]
    for i, name in enumerate(names):
        if name == "text":
            places[i] = F.col("body")
        elif name == "n_chars":
            places[i] = F.length("body").cast(docs.schema["n_chars"].dataType)
    return rows.select(*[place.alias(name) for place, name in zip(places, names)])
