"""Near copies: texts whose five-word shingles have a Jaccard similarity of 0.8 or more.

1. Equal texts are one.
2. Shingles have one order: rare ones first, as a sample of the texts shows, then by hash. Of two texts
   that are 0.8 alike the first ``n - ceil(0.8 n) + 1`` of n shingles in that order have one in common
   (prefix filtering), whatever the order; so texts that share none of these are not compared,
   and no pair that is alike is left out.
3. The texts of a shared shingle are a bucket. First all are compared with one of them, its head, and
   again with other heads while many pairs are left; texts that are linked already, through whichever others,
   are not compared any more. Then every pair of different classes is, so that the classes are exact.
4. A comparison is that of the whole sets of shingles, made from the stored texts when they meet. The texts linked are classes, named by their components.
5. With ``with_simhash`` the links of ``simhash`` (at most three of 64 bits apart) count beside these, below the
   similarity too; a class is what links of either kind hold together.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import key_filter, let_through, settle, small_batches
from tillroll.llm.components import connected_components
from tillroll.llm.simhash import text_fingerprint, text_links

SHINGLE_WORDS = 5
SIMILARITY = 0.8
#: Texts that show which shingles are frequent, about, and the frequent shingles that are told apart. They
#: only set the order, and with it the size of the buckets, not what is found.
SAMPLE_TEXTS = 20_000
FREQUENT = 100_000
#: Further heads are tried, as many at most, while more pairs than this, for a row of the buckets, are left
#: and the last heads have left out half of them.
PAIRS_A_ROW = 64
HEADS = 6
#: Sets of shingles that a task keeps while it compares.
RECENT_SETS = 64
#: Stands for the shingles of a text without words.
NO_WORDS = np.uint64(0)


def shingle_hashes(text: str | None) -> np.ndarray:
    """The distinct five-word shingles as sorted 64-bit hashes; of fewer words the whole sequence."""
    words = (text or "").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    span = min(SHINGLE_WORDS, len(words))
    known = {word: xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) for word in set(words)}
    hashed = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = len(words) - span + 1
    mixed = np.full(n, span, np.uint64)
    for place in range(span):
        mixed = (mixed ^ hashed[place : place + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets of hashes; two texts without words are equal."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def prefix(hashes: np.ndarray, frequent: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The shingles of which two texts that are alike share at least one; ``frequent`` is sorted."""
    if not len(hashes):
        return np.array([NO_WORDS])
    keep = len(hashes) - math.ceil(SIMILARITY * len(hashes) - 1e-9) + 1
    place = np.minimum(np.searchsorted(frequent, hashes), max(len(frequent) - 1, 0))
    known = frequent[place] == hashes if len(frequent) else np.zeros(len(hashes), bool)
    late = hashes[known][np.argsort(rank[place[known]])]
    return np.concatenate([hashes[~known], late])[:keep]


def _prefixed(order, with_simhash):
    def prefixed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, rank = order.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            sets = [shingle_hashes(text) for text in texts]
            firsts = [prefix(hashes, frequent, rank).tobytes() for hashes in sets]
            sizes = pa.array(map(len, sets), pa.int32())
            columns = [batch.column("doc_id"), batch.column("text_key"), sizes, pa.array(firsts, pa.binary())]
            names = ["doc_id", "text_key", "size", "firsts"]
            if with_simhash:
                columns.append(pa.array(map(text_fingerprint, texts), pa.int64()))
                names.append("fp")
            yield pa.RecordBatch.from_arrays(columns, names)

    return prefixed


def _all_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingle_hashes(text) for text in batch.column("text").to_pylist()]
        tokens = np.concatenate([np.empty(0, np.uint64), *sets])
        yield pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64))], ["token"])


def _order(plain: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles, sorted, and their places from the rarest to the most frequent."""
    every = max(1, math.ceil(plain.count() / SAMPLE_TEXTS))
    some = plain.filter(F.pmod(F.xxhash64("text"), F.lit(every)) == 0).dropDuplicates(["text_key"])
    counts = some.select("text").mapInArrow(_all_shingles, "token long").groupBy("token").count()
    most = counts.filter("count > 1").orderBy(F.desc("count"), "token").limit(FREQUENT).toArrow()
    tokens = most.column("token").to_numpy().view(np.uint64)
    rank = np.arange(len(tokens))[::-1]
    by_hash = np.argsort(tokens)
    return tokens[by_hash], rank[by_hash]


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each shingle of ``firsts``."""
    for batch in batches:
        firsts = [x.as_py() for x in batch.column("firsts")]
        counts = [len(x) // 8 for x in firsts]
        tokens = np.frombuffer(b"".join(firsts), np.int64)
        node, size = (np.repeat(batch.column(name).to_numpy(), counts) for name in ("node", "size"))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (tokens, node, size)], ["token", "node", "size"])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by token those whose token another row has as well."""
    held, follows = None, False  # the last row so far, and whether the one before it has its token
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.concat_batches([held, batch])
        token = batch.column("token").to_numpy()
        same = token[1:] == token[:-1]
        keep = np.append(follows, same)
        follows = bool(keep[-1])
        keep[:-1] |= same
        held = batch.slice(batch.num_rows - 1)
        yield batch.slice(0, batch.num_rows - 1).filter(pa.array(keep[:-1]))
    if held is not None and follows:
        yield held


def text_key(text: F.Column) -> F.Column:
    """Names a text by 128 bits of the SHA-256 of all of it."""
    return F.unhex(F.substring(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256), 1, 32))


def _buckets(kinds: DataFrame) -> DataFrame:
    """``token, node, size, degree`` for the shingles that several texts have in front, stored.

    ``degree`` is the number of a text's rows here: of a group of near copies, the text that the
    others are made of shares the most.
    """
    rows = kinds.select("node", "size", "firsts").mapInArrow(_spread, "token long, node long, size int")
    rows = rows.repartition("token").sortWithinPartitions("token").mapInArrow(_shared, rows.schema)
    rows = settle(rows, "shared-shingles")
    degrees = rows.groupBy("node").agg(F.count(F.lit(1)).alias("degree"))
    return settle(rows.join(degrees, "node").select("token", "node", "size", "degree"), "buckets")


def _met(x: DataFrame, y: DataFrame) -> DataFrame:
    """Pairs ``a, b, long, short`` of different classes that meet in a bucket and have sizes that allow it."""
    x = x.select("token", F.col("node").alias("x"), F.col("size").alias("x_size"), F.col("class").alias("x_class"))
    y = y.select("token", F.col("node").alias("y"), F.col("size").alias("y_size"), F.col("class").alias("y_class"))
    met = x.join(y, "token").filter("x_class <> y_class")
    sizes = [F.greatest("x_size", "y_size").alias("long"), F.least("x_size", "y_size").alias("short")]
    met = met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), *sizes, (F.col("x") < F.col("y")).alias("once"))
    return met.filter(F.col("short") >= F.col("long") * SIMILARITY - 1e-6)


def _untried(pairs: DataFrame, tried: DataFrame | None) -> DataFrame:
    return pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti")


def _every_pair(rows: DataFrame) -> DataFrame:
    """All pairs of different classes that may be alike, by the number of first shingles they share.

    Beyond these, the two share at most the shingles that follow the first ones of the larger set.
    """
    counted = _met(rows, rows).filter("once").groupBy("a", "b", "long", "short").agg(F.count(F.lit(1)).alias("shared"))
    later = F.ceil(F.col("long") * SIMILARITY - 1e-9) - 1
    needed = (F.col("long") + F.col("short")) * (SIMILARITY / (1 + SIMILARITY)) - 1e-6
    return counted.filter(F.col("shared") + later >= needed).select("a", "b")


def _open_buckets(rows: DataFrame, links: DataFrame | None) -> DataFrame:
    """The rows with their classes by the links so far, of the buckets with more than one class; stored."""
    if links is None:
        return rows.withColumn("class", F.col("node"))
    roots = connected_components(links).distinct()
    named = rows.join(roots, "node", "left").withColumn("class", F.coalesce("root", "node")).drop("root")
    named = settle(named.select(*rows.columns, "class"), "classes-so-far")
    ends = named.groupBy("token").agg(F.min("class").alias("least"), F.max("class").alias("most"))
    return settle(named.join(ends.filter("least < most").select("token"), "token", "left_semi"), "open-buckets")


def _pairs_left(rows: DataFrame) -> tuple[int, int]:
    """Rows of buckets, and the pairs of different classes in them."""
    whole = F.col("n").cast("decimal(38,0)")
    counts = rows.groupBy("token", "class").agg(F.count(F.lit(1)).alias("n"))
    sums = counts.groupBy("token").agg(F.sum("n").alias("n"), F.sum(whole * F.col("n")).alias("squares"))
    row = sums.agg(F.sum("n"), F.sum(F.col("n").cast("decimal(19,0)") * F.col("n") - F.col("squares"))).first()
    return int(row[0] or 0), int(row[1] or 0) // 2


def _links(buckets: DataFrame, texts: DataFrame, known: DataFrame | None) -> DataFrame:
    """The links ``known``, and pairs ``(a, b)`` that are alike; their classes are those of all such pairs and ``known``."""
    links = tried = before = None
    for number in range(HEADS + 1):
        rows = _open_buckets(buckets, links)
        if links is not None:
            count, left = _pairs_left(rows)
            if number == HEADS or left <= PAIRS_A_ROW * count or (before is not None and left > before / 2):
                break
            before = left
        first = F.col("degree") if number == 0 else F.xxhash64("node", F.lit(number))
        heads = rows.groupBy("token").agg(F.max(F.struct(first, F.col("node"), "size", "class")).alias("head"))
        heads = heads.select("token", "head.node", "head.size", "head.class")
        pairs = _met(heads, rows).select("a", "b").distinct()
        links, tried = _compared(_untried(pairs, tried), texts, known if links is None else links, tried)
    return _compared(_untried(_every_pair(rows), tried), texts, links, tried)[0]


def _compared(pairs: DataFrame, texts: DataFrame, links: DataFrame | None, tried: DataFrame | None):
    """The links and the pairs tried so far, with these pairs held against the texts."""
    pairs = settle(pairs, "pairs")
    left = texts.select(F.col("node").alias("a"), F.col("packed").alias("left"))
    right = texts.select(F.col("node").alias("b"), F.col("packed").alias("right"))
    near = settle(pairs.join(left, "a").join(right, "b").mapInArrow(_alike, "a long, b long"), "near-copies")
    return _added(links, near), _added(tried, pairs)


def _added(rows: DataFrame | None, more: DataFrame) -> DataFrame:
    return more if rows is None else rows.unionByName(more)


def _packed_texts(bits):
    """Compressed texts: their shingles, random numbers, would be several times as large."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            chosen = batch.filter(pa.array(let_through(bits.value, batch.column("key").to_numpy())))
            texts = [pack(text.encode("utf-8", "surrogatepass")) for text in chosen.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [chosen.column("text_key"), pa.array(texts, pa.binary())], ["text_key", "packed"]
            )

    return packed


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor().decompress

    @lru_cache(RECENT_SETS)
    def shingles(packed: bytes) -> np.ndarray:
        return shingle_hashes(unpack(packed).decode("utf-8", "surrogatepass"))

    for batch in batches:
        near = []
        for left, right in zip(batch.column("left"), batch.column("right")):
            near.append(similarity(shingles(left.as_py()), shingles(right.as_py())) >= SIMILARITY)
        yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))


def near_copy_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_simhash: bool = False
) -> DataFrame:
    """``text_key, class_key, least`` of each distinct text, stored.

    ``class_key`` is the number of the class the text belongs to, ``least`` the smallest id of its
    rows (null if all are null). Null texts count as empty; case and white space do not tell texts
    apart, other than for equal texts. ``with_simhash`` also links texts by their SimHash fingerprints.
    """
    spark = docs.sparkSession
    small_batches(spark)
    text = F.coalesce(docs[f"`{text_col}`"], F.lit(""))
    plain = docs.select(docs[f"`{id_col}`"].cast("long").alias("doc_id"), text_key(text).alias("text_key"), text.alias("text"))
    order = spark.sparkContext.broadcast(_order(plain))
    schema = "doc_id long, text_key binary, size int, firsts binary" + (", fp long" if with_simhash else "")
    marked = plain.mapInArrow(_prefixed(order, with_simhash), schema)
    first = [F.first(name).alias(name) for name in marked.columns[2:]]
    # The numbers are drawn once, when they are stored.
    kinds = settle(
        marked.groupBy("text_key")
        .agg(F.min("doc_id").alias("least"), *first)
        .withColumn("node", F.monotonically_increasing_id()),
        "distinct-texts",
    )
    buckets = _buckets(kinds)
    wanted = settle(kinds.join(buckets, "node", "left_semi").select("node", "text_key"), "texts-to-compare")
    bits = spark.sparkContext.broadcast(key_filter(wanted.select(F.xxhash64("text_key").alias("key"))))
    texts = (
        plain.select("text_key", F.xxhash64("text_key").alias("key"), "text")
        .mapInArrow(_packed_texts(bits), "text_key binary, packed binary")
        .groupBy("text_key")
        .agg(F.first("packed").alias("packed"))
    )
    texts = settle(wanted.join(texts, "text_key").select("node", "packed"), "packed-texts")
    linked = _links(buckets, texts, text_links(kinds.select("node", "fp")) if with_simhash else None)
    roots = connected_components(linked)
    return settle(
        kinds.join(roots, "node", "left").select("text_key", F.coalesce("root", "node").alias("class_key"), "least"),
        "near-copy-classes",
    )


def keep_one_of_each(docs: DataFrame, with_simhash: bool = False) -> DataFrame:
    """One row of ``docs`` for each class of near copies, with all its columns.

    ``with_simhash`` also links texts by their SimHash fingerprints.
    Of a class the row with the smallest doc_id stays; where ids are null or repeated, one of the
    rows that come first. Rows with equal ids and different texts are told apart. Null and empty
    texts are one text, and texts of fewer than five words are compared whole. An empty table
    gives no rows. Columns of any name stay as they are.
    """
    classes = near_copy_classes(docs, with_simhash=with_simhash)
    order = F.struct(F.col("least").isNull(), "least", "text_key")
    best = classes.groupBy("class_key").agg(F.min(order).alias("best")).select("best.text_key", "best.least")
    best = settle(best, "kept-texts")
    columns = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]
    rows = docs.select(*columns, docs["doc_id"].cast("long").alias("row_id"), text_key(docs["text"]).alias("row_key"))
    names = settle(rows.groupBy("row_key", "row_id").count(), "rows-by-text")
    chosen = (F.col("row_key") == F.col("text_key")) & F.col("row_id").eqNullSafe(F.col("least"))
    # The fewer rows that go are looked up, so that Spark may leave the others where they are.
    gone = _named(settle(names.join(best, chosen, "left_anti"), "copies"))
    same = (F.col("row_key") == F.col("gone_key")) & F.col("row_id").eqNullSafe(F.col("gone_id"))
    kept = rows.join(gone, same, "left_anti")
    repeated = _named(settle(names.join(best, chosen, "left_semi").filter("count > 1"), "repeated-rows"))
    if not repeated.isEmpty():
        once = kept.join(repeated, same, "left_semi").dropDuplicates(["row_key"])
        kept = kept.join(repeated, same, "left_anti").unionByName(once)
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def _named(names: DataFrame) -> DataFrame:
    return names.select(F.col("row_key").alias("gone_key"), F.col("row_id").alias("gone_id"))
