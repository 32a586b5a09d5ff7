"""Benchmark decontamination by template windows.

A text becomes a template: numbers, names (capitalised words inside a sentence) and units (after a
number) are replaced by typed placeholders, all other words are lower-cased, and the values that
stood in the slots are kept beside. Windows of five template words of documents and benchmark
items meet in a hash join. Windows that meet at the same offset form an alignment, whose slots
must agree: each value of the item stands for one and the same value of the document
throughout. So a question is found again when its names and figures have been exchanged, but not
where its slots are filled at random; there only windows with equal values count.

Whether a capitalised word that opens a sentence is a name cannot be seen, nor which words of a text
in one case are names. So windows have variants: on both sides one in which opening words are slots
too, and of items one in which names are plain words. Windows meet in any variant; the slots are
checked all the same.

Only documents that pass a gate are joined in full. Who holds ``COVERAGE`` of an item's windows holds
one of any set of more windows than may be missed, and who holds ``RUN_WORDS`` words in a row one of
every so many windows. Of each item the rarest of such windows are asked for first, so that a
window that is common among items is not joined with all of them.

A document is contaminated by an item if it holds at least ``COVERAGE`` of the item's windows, or
``RUN_WORDS`` template words of it in a row.

Windows with fewer than ``MIN_LITERALS`` words outside slots would meet everywhere; their slot
values belong to their key, so they meet where the values are equal. Texts of fewer than five
words are one window, which meets texts of the same length only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import key_filter, let_through, settle
from tillroll.llm.simhash import text_hash

WINDOW = 5
COVERAGE = 0.8
RUN_WORDS = 13
MIN_LITERALS = 2
CACHE_TOKENS = 500_000
UNITS = frozenset(
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams ton tons pound "
    "pounds ounce ounces ml l litre litres liter liters gallon gallons second seconds minute "
    "minutes hour hours day days week weeks month months year years percent dollar dollars euro "
    "euros cent cents degree degrees watt watts volt volts hz khz mhz ghz kb mb gb tb".split()
)

_TOKEN = re.compile(r"[^\W\d_]+|\d+(?:[.,]\d+)*|[.!?:\n]")
_MARK, _NUMBER, _UNIT, _TITLE, _PLAIN = range(5)
_PRIMES = [np.uint64(p) for p in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


class _Codes(dict):
    """Token to ``hash << 3 | class``."""

    def __missing__(self, token: str) -> int:
        if len(self) > CACHE_TOKENS:
            self.clear()
        low = token.lower()
        if token[0] in ".!?:\n":
            kind = _MARK
        elif token[0].isdigit():
            kind = _NUMBER
        elif low in UNITS:
            kind = _UNIT
        elif len(token) > 1 and token.istitle():
            kind = _TITLE
        else:
            kind = _PLAIN
        digest = xxhash.xxh64_intdigest(low.encode("utf-8", "surrogatepass"))
        self[token] = code = (digest >> 4) << 3 | kind
        return code


_codes = _Codes()


def _parts(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words of a text, their slots (0: none) and whether they are capitalised and open a sentence."""
    tokens = _TOKEN.findall(text or "")
    codes = np.fromiter(map(_codes.__getitem__, tokens), np.int64, len(tokens))
    kind = codes & 7
    before = np.concatenate(([_MARK], kind[:-1])) if len(kind) else kind
    slot = np.where(
        kind == _NUMBER,
        1,
        np.where((kind == _UNIT) & (before == _NUMBER), 2, np.where((kind == _TITLE) & (before != _MARK), 3, 0)),
    )
    keep = kind != _MARK
    return (codes >> 3)[keep], slot[keep], ((kind == _TITLE) & (before == _MARK))[keep]


def _filled(word: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.where(slot > 0, slot, word), np.where(slot > 0, word, 0)


def template(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Template words and slot values (0: no slot) of a text, as hashes."""
    word, slot, _ = _parts(text)
    return _filled(word, slot)


def window_variants(text: str | None, of_item: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Keys, places and slot values of a text's windows, then of those that a variant changes."""
    word, slot, opening = _parts(text)
    variants = [(slot, None), (np.where(opening, 3, slot), opening)]
    if of_item:
        variants.append((np.where(slot == 3, 0, slot), slot == 3))
    for changed_slot, changed in variants:
        words, values = _filled(word, changed_slot)
        keys = window_keys(words, values)
        at = np.arange(len(keys))
        if changed is not None and len(keys):
            counts = np.concatenate(([0], np.cumsum(changed)))
            at = at[counts[np.minimum(at + WINDOW, len(word))] > counts[at]]
        yield keys[at], at, values


def window_keys(words: np.ndarray, values: np.ndarray) -> np.ndarray:
    """One signed 64-bit key per window; one key for a short text, none for an empty one."""
    n = len(words)
    if not n:
        return np.empty(0, np.int64)
    size = min(n, WINDOW)
    m = n - size + 1
    key = np.full(m, size, np.uint64)
    slots = np.zeros(m, np.uint64)
    literals = np.zeros(m, np.int8)
    u, v, literal = words.astype(np.uint64), values.astype(np.uint64), values == 0
    for j in range(size):
        key = (key ^ u[j : j + m]) * _PRIMES[j]
        key ^= key >> np.uint64(29)
        literals += literal[j : j + m]
        slots = (slots + v[j : j + m]) * _PRIMES[j]
    return np.where(literals < MIN_LITERALS, key ^ slots, key).view(np.int64)


_SCHEMA = "owner long, text_hash long, key long, at int, n_windows int, slots array<long>"
_ARROW = pa.schema(
    [("owner", pa.int64()), ("text_hash", pa.int64()), ("key", pa.int64()), ("at", pa.int32()),
     ("n_windows", pa.int32()), ("slots", pa.list_(pa.int64()))]
)


def _windows(bits=None):
    """Windows of items; with ``bits``, those of documents that the filter lets through."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if bits is None else bits.value
        for batch in batches:
            out: dict[str, list] = {name: [] for name in _ARROW.names}
            for owner, digest, text in zip(*(batch.column(c).to_pylist() for c in ("owner", "text_hash", "text"))):
                n_windows = 0
                for keys, at, values in window_variants(text, known is None):
                    n_windows = n_windows or len(keys)
                    if known is not None and len(keys):
                        here = let_through(known, keys)
                        keys, at = keys[here], at[here]
                    if not len(at):
                        continue
                    held = [values[i : i + WINDOW] for i in at]
                    out["owner"] += [owner] * len(at)
                    out["text_hash"] += [digest] * len(at)
                    out["key"] += keys.tolist()
                    out["at"] += at.tolist()
                    out["n_windows"] += [n_windows] * len(at)
                    out["slots"] += [v.tolist() if v.any() else [] for v in held]
            if out["key"]:
                yield pa.RecordBatch.from_pydict(out, _ARROW)

    return rows


def _gate(items: DataFrame) -> DataFrame:
    """``item_id, item_hash, item_key`` of the windows one of which every holder of the item has.

    Of the item's places as many as may be missed and one more, those whose windows the fewest items
    hold, and one place of every ``RUN_WORDS - WINDOW + 1``; all variants of these places.
    """
    held = items.groupBy("item_key").agg(F.count_distinct("item_id", "item_hash").alias("held"))
    item = ["item_id", "item_hash"]
    counted = items.join(held, "item_key")
    places = counted.groupBy(*item, "item_windows", "item_at").agg(F.max("held").alias("held"))
    # An item's windows are one text's, not a group that grows with the tables.
    listed = places.groupBy(*item, "item_windows").agg(F.array_sort(F.collect_list(F.struct("held", "item_at"))).alias("all"))
    # A hair less, so that rounding does not ask for a window too many.
    missed = F.col("item_windows") - F.ceil(F.col("item_windows") * COVERAGE - 1e-9)
    rarest = F.slice("all", 1, (missed + 1).cast("int"))["item_at"]
    every = RUN_WORDS - WINDOW + 1
    spaced = F.filter(F.col("all")["item_at"], lambda at: at % every == every - 1)
    chosen = listed.select(
        F.col("item_id").alias("g_id"), F.col("item_hash").alias("g_hash"),
        F.explode(F.array_union(rarest, spaced)).alias("g_at"),
    )
    same = items["item_id"].eqNullSafe(chosen["g_id"]) & (items["item_hash"] == chosen["g_hash"]) & (items["item_at"] == chosen["g_at"])
    return items.join(chosen, same, "left_semi").select(*item, "item_key").distinct()


def _texts(df: DataFrame, id_col: str) -> DataFrame:
    return df.select(
        F.col(id_col).cast("long").alias("owner"), text_hash("text").alias("text_hash"), F.col("text")
    )


def _longest_run(positions: F.Column) -> F.Column:
    start = F.struct(F.lit(-2).alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(s: F.Column, at: F.Column) -> F.Column:
        run = F.when(at == s["last"] + 1, s["run"] + 1).otherwise(1)
        return F.struct(at.alias("last"), run.alias("run"), F.greatest(s["best"], run).alias("best"))

    return F.aggregate(F.array_sort(positions), start, step)["best"]


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item that it holds.

    Columns: doc_id, item_id, n_windows (of the item), n_matched, coverage, run_words, kind
    (``verbatim``: all matched windows have the item's own values, else ``reparameterised``), and
    text_hash, which tells rows with equal ids apart. Repeated rows give one row. Null and empty
    texts hold nothing and are held by nothing; a null id is a name like any other. Empty tables
    give no rows. Other columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    items = settle(
        _texts(benchmark, "item_id").mapInArrow(_windows(), _SCHEMA).select(
            F.col("owner").alias("item_id"),
            F.col("text_hash").alias("item_hash"),
            F.col("key").alias("item_key"),
            F.col("at").alias("item_at"),
            F.col("n_windows").alias("item_windows"),
            F.col("slots").alias("item_slots"),
        ),
        "benchmark-windows",
    )
    bits = spark.sparkContext.broadcast(key_filter(items.select(F.col("item_key").alias("key"))))
    hits = settle(_texts(docs, "doc_id").mapInArrow(_windows(bits), _SCHEMA).distinct(), "window-hits")
    gate = settle(_gate(items), "gate-windows").withColumnRenamed("item_key", "key")
    passed = settle(
        hits.select("owner", "text_hash", "key").distinct().join(gate, "key")
        .select(*[F.col(c).alias(f"g_{c}") for c in ("owner", "text_hash", "item_id", "item_hash")])
        .distinct(),
        "gate-passed",
    )
    own = hits["owner"].eqNullSafe(passed["g_owner"]) & (hits["text_hash"] == passed["g_text_hash"])
    asked = hits.join(passed, own)
    met = asked.join(
        items,
        (asked["key"] == items["item_key"])
        & (asked["g_item_hash"] == items["item_hash"])
        & asked["g_item_id"].eqNullSafe(items["item_id"]),
    )
    same = F.col("slots") == F.col("item_slots")
    pairs = F.filter(
        F.arrays_zip(F.col("item_slots").alias("was"), F.col("slots").alias("now")),
        lambda p: p["was"] != 0,
    )
    pair = ["owner", "text_hash", "item_id", "item_hash", "item_windows"]
    aligned = (
        met.select(
            *pair, (F.col("at") - F.col("item_at")).alias("offset"), "item_at",
            F.when(same, F.col("item_at")).alias("same_at"), pairs.alias("pairs"),
        )
        .groupBy(*pair, "offset")
        .agg(
            F.collect_set("item_at").alias("met_at"),
            F.collect_set("same_at").alias("same_at"),
            F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"),
        )
    )
    values = F.array_distinct(F.transform("pairs", lambda p: p["was"]))
    agree = F.size("pairs") == F.size(values)
    counted = aligned.select(
        *pair, F.when(agree, F.col("met_at")).otherwise(F.col("same_at")).alias("found_at"), "same_at"
    ).withColumn("run", _longest_run(F.col("found_at")))
    whole = counted.groupBy(*pair).agg(
        F.array_distinct(F.flatten(F.collect_list("found_at"))).alias("found_at"),
        F.array_distinct(F.flatten(F.collect_list("same_at"))).alias("same_at"),
        F.max("run").alias("run"),
    )
    n = F.size("found_at")
    found = whole.select(
        F.col("owner").alias("doc_id"),
        "item_id",
        F.col("item_windows").alias("n_windows"),
        n.alias("n_matched"),
        (n / F.col("item_windows")).alias("coverage"),
        F.when(n > 0, F.col("run") + WINDOW - 1).otherwise(0).alias("run_words"),
        F.when(n == F.size("same_at"), "verbatim").otherwise("reparameterised").alias("kind"),
        "text_hash",
    )
    return found.filter((F.col("coverage") >= COVERAGE) | (F.col("run_words") >= RUN_WORDS))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item; columns stay as they are."""
    bad = settle(
        contaminated(docs, benchmark)
        .select(F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_hash"))
        .distinct(),
        "contaminated",
    )
    same = docs["doc_id"].eqNullSafe(bad["bad_id"]) & (text_hash("text") == bad["bad_hash"])
    return docs.join(bad, same, "left_anti")


def _windows_sql(name: str, table: str, id_col: str, of_item: bool = False) -> str:
    """CTEs that end in ``<name>``: a row per window with key, place, count and slot values."""
    units = ", ".join(f"'{unit}'" for unit in sorted(UNITS))
    variants = [("slot", "false"), ("CASE WHEN opening THEN 3 ELSE slot END", "opening")]
    if of_item:
        variants.append(("CASE WHEN slot = 3 THEN 0 ELSE slot END", "slot = 3"))
    variants = " UNION ALL ".join(
        f"SELECT id, text, i, token, {number} AS variant, {slot} AS slot, {changed} AS changed FROM {name}_slots WHERE kind <> 'mark'"
        for number, (slot, changed) in enumerate(variants)
    )
    spread = f"OVER (PARTITION BY id, text, variant ORDER BY pos ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING)"
    return f"""
{name}_tokens AS (
  SELECT id, text, unnest(l) AS token, generate_subscripts(l, 1) AS i
  FROM (SELECT DISTINCT {id_col} AS id, text,
    regexp_extract_all(text, '\\p{{L}}+|[0-9]+(?:[.,][0-9]+)*|[.!?:\n]') AS l FROM {table})
),
{name}_kinds AS (
  SELECT *, CASE WHEN token IN ('.', '!', '?', ':', chr(10)) THEN 'mark'
    WHEN regexp_matches(token, '^[0-9]') THEN 'number' WHEN lower(token) IN ({units}) THEN 'unit'
    WHEN regexp_matches(token, '^\\p{{Lu}}[^\\p{{Lu}}]+$') THEN 'title' ELSE 'plain' END AS kind
  FROM {name}_tokens
),
{name}_slots AS (
  SELECT *, CASE WHEN kind = 'number' THEN 1 WHEN kind = 'unit' AND before = 'number' THEN 2
    WHEN kind = 'title' AND before <> 'mark' THEN 3 ELSE 0 END AS slot,
    kind = 'title' AND before = 'mark' AS opening
  FROM (SELECT *, lag(kind, 1, 'mark') OVER (PARTITION BY id, text ORDER BY i) AS before FROM {name}_kinds)
),
{name}_words AS (
  SELECT id, text, CASE WHEN slot > 0 THEN '<' || slot || '>' ELSE lower(token) END AS word,
    CASE WHEN slot > 0 THEN lower(token) ELSE '' END AS value, variant, changed,
    row_number() OVER (PARTITION BY id, text, variant ORDER BY i) - 1 AS pos,
    count(*) OVER (PARTITION BY id, text, variant) AS n
  FROM ({variants})
),
{name} AS (
  SELECT id, text, pos, n - least(n, {WINDOW}) + 1 AS n_windows, vals,
    array_to_string(ws, ' ') || CASE WHEN len(list_filter(vals, lambda v: v = '')) < {MIN_LITERALS}
      THEN '|' || array_to_string(vals, ' ') ELSE '' END AS key
  FROM (SELECT *, list(word) {spread} AS ws, list(value) {spread} AS vals, bool_or(changed) {spread} AS touched
    FROM {name}_words)
  WHERE pos <= n - least(n, {WINDOW}) AND (variant = 0 OR touched)
)"""


def contaminated_sql(docs: str = "documents", benchmark: str = "benchmark") -> str:
    """The rows of ``contaminated`` (without the text hash) for DuckDB."""
    pair = "id, text, item_id, item_text, n_windows"
    return f"""
WITH {_windows_sql("d", docs, "doc_id")}, {_windows_sql("b", benchmark, "item_id", True)},
met AS (
  SELECT d.id, d.text, b.id AS item_id, b.text AS item_text, b.n_windows, b.pos, d.pos - b.pos AS shift,
    b.vals = d.vals AS same, b.vals AS was, d.vals AS now
  FROM d JOIN b USING (key)
),
agreeing AS (
  SELECT {pair}, shift, count(DISTINCT w) = count(DISTINCT (w, v)) AS agree
  FROM (SELECT {pair}, shift, unnest(was) AS w, unnest(now) AS v FROM met) WHERE w <> ''
  GROUP BY ALL
),
found AS (
  SELECT DISTINCT {pair}, shift, pos, same FROM met LEFT JOIN agreeing
    USING (id, text, item_id, item_text, n_windows, shift)
  WHERE same OR coalesce(agree, true)
),
islands AS (
  SELECT *, pos - row_number() OVER (PARTITION BY {pair}, shift ORDER BY pos) AS island FROM found
),
runs AS (
  SELECT {pair}, max(size) AS run FROM (
    SELECT {pair}, shift, island, count(*) AS size FROM islands GROUP BY ALL
  ) GROUP BY ALL
),
whole AS (
  SELECT {pair}, count(DISTINCT pos) AS n, count(DISTINCT pos) FILTER (WHERE same) AS n_same
  FROM found GROUP BY ALL
)
SELECT id AS doc_id, item_id, n_windows::INT AS n_windows, n::INT AS n_matched, n / n_windows AS coverage,
  (run + {WINDOW - 1})::INT AS run_words,
  CASE WHEN n = n_same THEN 'verbatim' ELSE 'reparameterised' END AS kind
FROM whole JOIN runs USING (id, text, item_id, item_text, n_windows)
WHERE n / n_windows >= {COVERAGE} OR run + {WINDOW - 1} >= {RUN_WORDS}
"""
