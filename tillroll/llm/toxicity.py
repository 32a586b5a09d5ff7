"""Toxicity by class-conditional Kneser-Ney models.

Two word-pair models, one of toxic and one of ordinary labelled texts, are compared by their
length-normalised log-likelihoods. A pair backs off to the class's single words, and these to
counts that both classes share (in how many different contexts a word was seen), so that a rare
expression is judged by what all texts say of it.

Words and pairs are counted under 64-bit hashes, each with counts of its own, in a stored table that
grows with the corpus. Pairs are dealt by hash to parts, whose number grows with the texts; a part
counts its pairs and hands on only what they add up to by word and by context, and the frequent
ones. A token's log-likelihood ratio is that of its pair where the pair was counted, else the sum of one number of
the word before and one of the word; rare words and contexts without frequent pairs need no row, since
theirs is the same for all. The ``HEAD_ROWS`` most frequent of these numbers go to every task, so that most texts are scored where they are
read. A text that may hold a word or pair of the others is scored exactly too, in blocks: their distinct words and pairs
are joined with the whole table, and what is found goes back to the block. Only the texts of the calibration sample get counts, since
their own share is taken off. Counting covers every labelled training row. Only the last step, the seven weights that turn log-likelihood ratios into a score, is fitted
on a bounded sample: the ``CALIBRATION_ROWS`` training rows with the smallest hash of their id.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import key_filter, let_through, settle, small_batches

#: A pair is its first word, turned by so many bits, xor its second word.
PAIR_TURN = 21
#: Keeps pairs and words apart where both are keys of one join; a word finds its row as a context too.
KIND_MARKS = {"word": 0, "context": 0, "pair": 0x1F83D9ABFB41BD6B}
DISCOUNT = 0.75
THRESHOLD = 0.7
CALIBRATION_ROWS = 5_000
#: Words and pairs seen less often in both classes together are rare: shared counts judge them.
#: On check_s, without the bar for pairs held-out recall falls to 0.49 and precision to 0.83.
FREQUENT_WORD = 3
FREQUENT_PAIR = 30
#: Besides the whole text, the ratio is taken over so many of its strongest expressions.
STRONGEST = (1, 3, 8)
CLASSES = ("ordinary", "toxic")
#: Stands for the label of a text that is scored, not trained on.
UNLABELLED = -1
#: Tokens counted before a task hands its counts on.
FLUSH_TOKENS = 1_000_000
CACHE_WORDS = 200_000
#: Tokens of the texts that are looked up together, about; a longer text is a block of its own.
BLOCK_TOKENS = 1 << 20
#: Ratios that every task holds, at most (16 bytes each); texts that need others are scored in blocks.
HEAD_ROWS = 1 << 22
#: Tokens whose ratios are looked up at once, about.
SCORED_TOKENS = 1 << 18
#: Bytes of all texts for each part of the pairs; a few parts more for small tables.
PART_BYTES, LEAST_PARTS = 32 << 20, 8

_WORD = re.compile(r"[^\W\d_]+")


class _Numbers(dict):
    """Word to 64-bit number (0 begins a text)."""

    def __missing__(self, word: str) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        number = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        number = (number - (1 << 64) if number >> 63 else number) or 1
        self[word] = number
        return number


_numbers = _Numbers()


def word_numbers(text: str | None) -> np.ndarray:
    words = _WORD.findall((text or "").lower())
    return np.fromiter(map(_numbers.__getitem__, words), np.int64, len(words))


def words_before(words: np.ndarray) -> np.ndarray:
    return np.concatenate((np.zeros(1, np.int64), words[:-1])) if len(words) else words


def pair_numbers(words: np.ndarray) -> np.ndarray:
    return _paired(words_before(words), words)


def _paired(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    bits = before.view(np.uint64)
    turned = (bits << np.uint64(PAIR_TURN)) | (bits >> np.uint64(64 - PAIR_TURN))
    return turned.view(np.int64) ^ words


PART_SCHEMA = "part int, pairs binary"


def _dealt_pairs(parts: int):
    """Counts of each pair by class, of about ``FLUSH_TOKENS`` tokens at a time, in a row for each part."""

    def flush(held: dict[int, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        texts = held[0] + held[1]
        words = np.concatenate(texts)
        before = np.concatenate([words_before(x) for x in texts])
        toxic = np.arange(len(words)) >= sum(map(len, held[0]))
        pairs, place, counted = np.unique(_paired(before, words), return_index=True, return_inverse=True)
        counts = [np.bincount(counted[toxic == y], minlength=len(pairs)) for y in (False, True)]
        part = _part(pairs, parts)
        order = np.argsort(part, kind="stable")
        ends = np.cumsum(np.bincount(part, minlength=parts))
        rows = [
            (number, _pack(before[place[chosen]], words[place[chosen]], *[c[chosen] for c in counts]))
            for number, chosen in enumerate(np.split(order, ends[:-1]))
            if len(chosen)
        ]
        numbers, blobs = zip(*rows) if rows else ((), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(numbers, pa.int32()), pa.array(blobs, pa.binary())], ["part", "pairs"]
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {0: [], 1: []}
        size = 0
        for batch in batches:
            for text, label in zip(_texts_of(batch), batch.column("toxic").to_pylist()):
                words = word_numbers(text)
                held[label].append(words)
                size += len(words)
                if size >= FLUSH_TOKENS:
                    yield from flush(held)
                    held, size = {0: [], 1: []}, 0
        if size:
            yield from flush(held)

    return count


def _part(pairs: np.ndarray, parts: int) -> np.ndarray:
    """The part of each pair, by the upper bits of its number, mixed so that near numbers part."""
    mixed = pairs.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % np.uint64(parts)).astype(np.int64)


def _pack(before: np.ndarray, words: np.ndarray, *counts: np.ndarray) -> bytes:
    """Pairs with their counts; a word is written once, and by its place from then on."""
    vocabulary, places = np.unique(np.concatenate((before, words)), return_inverse=True)
    first, second = np.split(places, 2)
    order = np.lexsort((first, second))
    columns = [x[order].astype(np.uint32) for x in (second, first, *counts)]
    # Byte by byte, since most bytes of a column are alike; places of second words rise.
    columns[0] = np.diff(columns[0], prepend=np.uint32(0))
    small = zlib.compress(b"".join(x.view(np.uint8).reshape(-1, 4).T.tobytes() for x in columns), 1)
    return np.array([len(order), len(vocabulary)], np.int64).tobytes() + vocabulary.tobytes() + small


def _unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What ``_pack`` was given, in another order."""
    n, kinds = np.frombuffer(packed, np.int64, 2).tolist()
    vocabulary = np.frombuffer(packed, np.int64, kinds, 16)
    small = np.frombuffer(zlib.decompress(packed[16 + 8 * kinds :]), np.uint8).reshape(4, 4, n)
    second, first, ordinary, toxic = np.ascontiguousarray(small.transpose(0, 2, 1)).view(np.uint32)[..., 0]
    places = np.cumsum(second, dtype=np.int64)
    return vocabulary[first], vocabulary[places], ordinary.astype(np.int64), toxic.astype(np.int64)


SUMS = [*CLASSES, "kept_ordinary", "kept_toxic", "kinds"]
COUNT_SCHEMA = ", ".join(
    ["kind string, bucket long, before long, word long", *[f"{name} double" for name in SUMS]]
)


def _sums_of_part(frequent: int):
    """What the pairs of a part add up to: rows by context and by word, and one for each frequent pair."""

    def added(keys: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        known, place = np.unique(keys, return_inverse=True)
        return known, [np.bincount(place, x, len(known)) for x in columns]

    def table(kind: str, bucket: np.ndarray, sums: list[np.ndarray], *pair: np.ndarray) -> pa.Table:
        none = pa.nulls(len(bucket), pa.int64())
        columns = [pa.array(np.full(len(bucket), kind, object), pa.string()), bucket, *(pair or (none, none))]
        return pa.table([*columns, *[pa.array(x, pa.float64()) for x in sums]], ["kind", "bucket", "before", "word", *SUMS])

    def sums(group: pa.Table) -> pa.Table:
        columns = zip(*[_unpack(x.as_py()) for x in group.column("pairs")])
        before, word, *counts = [np.concatenate(x) for x in columns]
        # Two pairs may have one number, so they are told apart by their words.
        order = np.lexsort((before, word))
        new = np.append(True, (np.diff(before[order]) != 0) | (np.diff(word[order]) != 0))
        at = np.flatnonzero(new)
        before, word = before[order][at], word[order][at]
        ordinary, toxic = [np.add.reduceat(c[order], at).astype(np.float64) for c in counts]
        often = ordinary + toxic >= frequent
        kept = [np.where(often, np.maximum(c - DISCOUNT, 0), 0) for c in (ordinary, toxic)]
        contexts, of_context = added(before, ordinary, toxic, *kept)
        words, of_word = added(word, ordinary, toxic, np.ones(len(word)))
        pairs = _paired(before[often], word[often])
        of_word[2:2] = [np.zeros(len(words))] * 2
        of_pair = [ordinary[often], toxic[often], *[np.zeros(len(pairs))] * 3]
        return pa.concat_tables(
            [
                table("context", contexts, [*of_context, np.zeros(len(contexts))]),
                table("word", words, of_word),
                table("pair", pairs, of_pair, before[often], word[often]),
            ]
        )

    return sums


class Model:
    """Counts of the two classes (index 0 ordinary, 1 toxic) for the words and pairs in ``rows``.

    ``totals`` has the sums over the whole tables; without it, ``rows`` are the whole tables.
    """

    def __init__(self, rows: pd.DataFrame, totals: dict[str, float] | None = None):
        self.keys, self.counts = {}, {}
        for kind in ("pair", "context", "word"):
            part = rows[rows["kind"] == kind].sort_values("bucket")
            self.keys[kind] = part["bucket"].to_numpy(np.int64)
            # The last place stands for what was never seen.
            self.counts[kind] = {
                c: np.append(part[c].to_numpy(np.float64), 0.0)
                for c in (*CLASSES, "kept_ordinary", "kept_toxic", "kinds")
            }
        if totals is None:
            totals = word_totals(rows[rows["kind"] == "word"])
        self.total = np.maximum([totals[c] for c in CLASSES], 1)
        self.rest = self.total - [totals[f"kept_{c}"] for c in CLASSES]
        self.shared = totals["kinds"] + totals["words"] + 1

    def _found(self, kind: str, keys: np.ndarray, *names: str) -> list[np.ndarray]:
        known = self.keys[kind]
        place = np.searchsorted(known, keys)
        if len(known):
            place[known[np.minimum(place, len(known) - 1)] != keys] = len(known)
        return [self.counts[kind][name][place] for name in names]

    def features(self, words: np.ndarray, own_label: int | None = None) -> list[float]:
        """Log-likelihood ratios of a text by length, of its strongest expressions, and its length.

        ``own_label`` names the class whose counts hold this very text; its own share is then
        taken off, so that training texts are scored as unseen ones.
        """
        n = len(words)
        if not n:
            return [0.0] * (len(STRONGEST) + 3)
        before, bucket = words_before(words), pair_numbers(words)
        pair = np.stack(self._found("pair", bucket, *CLASSES))
        *both, kept_ordinary, kept_toxic = self._found(
            "context", before, *CLASSES, "kept_ordinary", "kept_toxic"
        )
        context = np.stack(both)
        left = context - np.stack((kept_ordinary, kept_toxic))
        *both, kinds = self._found("word", words, *CLASSES, "kinds")
        word = np.stack(both)
        word[:, word.sum(axis=0) < FREQUENT_WORD] = 0
        shared = (kinds + 1) / self.shared
        if own_label is not None:
            own_pair, own_word, own_context = map(_occurrences, (bucket, words, before))
            pair[own_label] -= own_pair
            word[own_label] -= own_word
            context[own_label] = np.maximum(context[own_label] - own_context, 0)
            left[own_label] = np.minimum(left[own_label], context[own_label])
        ratio = np.zeros(n)
        for label, sign in ((0, -1), (1, 1)):
            single = np.maximum(word[label] - DISCOUNT, 0) + self.rest[label] * shared
            single = single / self.total[label]
            double = np.maximum(pair[label] - DISCOUNT, 0) + left[label] * single
            seen = (context[label] > 0) & (double > 0)
            ratio += sign * np.log(np.where(seen, double / np.where(seen, context[label], 1), single))
        return summed_up(ratio)


def summed_up(ratio: np.ndarray) -> list[float]:
    """The features of a text from the log-likelihood ratios of its tokens."""
    if not len(ratio):
        return [0.0] * (len(STRONGEST) + 3)
    strong = np.sort(ratio)[::-1][: max(STRONGEST)]
    return [
        float(ratio.mean()),
        float(np.maximum(ratio, 0).mean()),
        *[float(strong[:k].sum()) for k in STRONGEST],
        float(np.log1p(len(ratio))),
    ]


class Ratios:
    """Log-likelihood ratios by marked key: of a pair, or of a word (``own``) and of it as a context (``after``)."""

    def __init__(self, keys: np.ndarray, own: np.ndarray, after: np.ndarray, unknown: float):
        order = np.argsort(keys)
        # The last place stands for what was never counted.
        self.keys = keys[order]
        self.own = np.append(own[order].astype(np.float64), unknown)
        self.after = np.append(after[order].astype(np.float64), 0.0)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        place = np.searchsorted(self.keys, keys)
        if len(self.keys):
            place[self.keys[np.minimum(place, len(self.keys) - 1)] != keys] = len(self.keys)
        return place

    def of_tokens(self, words: np.ndarray, before: np.ndarray) -> np.ndarray:
        """The ratio of each word after the one before it."""
        pair = self._place(_paired(before, words) ^ np.int64(KIND_MARKS["pair"]))
        single = self.own[self._place(words)] + self.after[self._place(before)]
        return np.where(pair < len(self.keys), self.own[pair], single)

    def features(self, words: np.ndarray) -> list[float]:
        return summed_up(self.of_tokens(words, words_before(words)))


def word_totals(words: pd.DataFrame) -> dict[str, float]:
    """What ``Model`` needs of all words, from the rows of kind word; ``_word_totals`` has it in Spark."""
    often = words[words["ordinary"] + words["toxic"] >= FREQUENT_WORD]
    return {
        **{c: float(words[c].sum()) for c in CLASSES},
        **{f"kept_{c}": float(np.maximum(often[c] - DISCOUNT, 0).sum()) for c in CLASSES},
        "kinds": float(words["kinds"].sum()),
        "words": len(words),
    }


def _word_totals(model: DataFrame) -> dict[str, float]:
    often = F.col("ordinary") + F.col("toxic") >= FREQUENT_WORD
    kept = [F.when(often, F.greatest(F.col(c) - DISCOUNT, F.lit(0.0))).alias(f"kept_{c}") for c in CLASSES]
    row = (
        model.filter(F.col("kind") == "word")
        .select(*CLASSES, *kept, "kinds")
        .agg(
            *[F.sum(c).alias(c) for c in (*CLASSES, "kept_ordinary", "kept_toxic", "kinds")],
            F.count(F.lit(1)).alias("words"),
        )
        .first()
    )
    return {name: float(value or 0) for name, value in row.asDict().items()}


def _occurrences(values: np.ndarray) -> np.ndarray:
    _, place, counts = np.unique(values, return_inverse=True, return_counts=True)
    return counts[place]


def fit_weights(features: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Logistic weights by Newton steps with a little shrinkage; the last one is the intercept."""
    mean, spread = features.mean(axis=0), features.std(axis=0) + 1e-9
    x = np.column_stack(((features - mean) / spread, np.ones(len(features))))
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(
            (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w)), x.T @ (labels - p) - 1e-2 * w
        )
        w += step
        if np.abs(step).max() < 1e-9:
            break
    scale = w[:-1] / spread
    return np.append(scale, w[-1] - scale @ mean)


def training_rows(labels: DataFrame) -> DataFrame:
    """``label_id, toxic`` of the rows that training may use: crc32 of the id, mod 3, is not 1.

    Repeated ids count once, as toxic if any of their rows says so; null ids and null labels go.
    """
    held = held_out(F.col("doc_id"))
    return (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held)
        .groupBy(F.col("doc_id").cast("long").alias("label_id"))
        .agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    )


def held_out(doc_id: F.Column) -> F.Column:
    """Whether a row is kept from training; a row without an id has no label and is not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``text`` (compressed) and ``toxic`` of the texts that ``labels`` names.

    A filter of fixed size drops most other texts before the join. The join is a shuffle at every
    size, since labels grow with the corpus.
    """
    spark = docs.sparkSession
    named = key_filter(labels.select(F.xxhash64("label_id").alias("key")))
    bits = spark.sparkContext.broadcast(named)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            here = np.flatnonzero(let_through(bits.value, batch.column("key").to_numpy()))
            chosen = batch.take(pa.array(here))
            texts = [
                zlib.compress((x or "").encode("utf-8", "surrogatepass"), 1)
                for x in chosen.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [chosen.column("doc_id"), pa.array(texts, pa.binary())], ["doc_id", "text"]
            )

    able = docs.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id").alias("key"), "text"
    )
    chosen = able.mapInArrow(pack, "doc_id long, text binary")
    return chosen.join(labels.hint("merge"), F.col("doc_id") == F.col("label_id")).select(
        "label_id", "text", "toxic"
    )


def _texts_of(batch: pa.RecordBatch) -> Iterator[str]:
    """The texts of a batch, which are plain or compressed."""
    for text in batch.column("text"):
        held = text.as_py()
        yield zlib.decompress(held).decode("utf-8", "surrogatepass") if isinstance(held, bytes) else held or ""


def count_model(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The counts behind ``Model``, stored: a row per frequent pair, per context and per word.

    The pairs themselves, most of which occur once, are never stored.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    dealt = _labelled(docs, labels).select("text", "toxic").mapInArrow(
        _dealt_pairs(LEAST_PARTS + size // PART_BYTES), PART_SCHEMA
    )
    rows = dealt.groupBy("part").applyInArrow(_sums_of_part(FREQUENT_PAIR), COUNT_SCHEMA)
    # A pair comes from one part alone; words and contexts come from many.
    model = rows.groupBy("kind", "bucket", "before", "word").agg(*[F.sum(c).alias(c) for c in SUMS])
    return settle(model, "model-counts")


def token_ratios(model: DataFrame, totals: dict[str, float]) -> tuple[DataFrame, float]:
    """``marked, own, after, seen`` of counted words and pairs, stored, and the ratio of a word never seen.

    The same formulas as in ``Model``, without a text's own share. A rare word has the ratio of one never
    seen, since the shared counts cancel out, and a context without frequent pairs adds nothing: these
    get no row. ``seen`` is how often the row was counted.
    """
    total = {c: max(totals[c], 1.0) for c in CLASSES}
    rest = {c: total[c] - totals[f"kept_{c}"] for c in CLASSES}
    everywhere = totals["kinds"] + totals["words"] + 1

    def part(kind: str, prefix: str) -> DataFrame:
        names = [*CLASSES, "kept_ordinary", "kept_toxic", "kinds"]
        chosen = model.filter(F.col("kind") == kind)
        return chosen.select(F.col("bucket").alias(f"{prefix}_key"), *[F.col(n).alias(f"{prefix}_{n}") for n in names])

    def single(c: str) -> F.Column:
        often = F.coalesce(F.col("w_ordinary") + F.col("w_toxic"), F.lit(0.0)) >= FREQUENT_WORD
        kept = F.when(often, F.greatest(F.col(f"w_{c}") - DISCOUNT, F.lit(0.0))).otherwise(0.0)
        shared = (F.coalesce("w_kinds", F.lit(0.0)) + 1) / everywhere
        return (kept + F.lit(rest[c]) * shared) / total[c]

    def left(c: str) -> F.Column:
        return F.coalesce(F.col(f"c_{c}") - F.col(f"c_kept_{c}"), F.lit(0.0))

    def kept_weight(c: str) -> F.Column:
        """What of a context's weight goes to words it was not counted with; all of it where it was never seen."""
        return F.when(left(c) > 0, left(c) / F.col(f"c_{c}")).otherwise(1.0)

    def paired(c: str) -> F.Column:
        double = F.greatest(F.col(f"p_{c}") - DISCOUNT, F.lit(0.0)) + left(c) * single(c)
        seen = (F.coalesce(f"c_{c}", F.lit(0.0)) > 0) & (double > 0)
        return F.when(seen, double / F.col(f"c_{c}")).otherwise(single(c))

    def ratio(value) -> F.Column:
        return (F.log(value("toxic")) - F.log(value("ordinary"))).cast("float")

    def seen(prefix: str) -> F.Column:
        return F.coalesce(F.col(f"{prefix}_ordinary") + F.col(f"{prefix}_toxic"), F.lit(0.0))

    # A frequent pair has words as frequent, and its context keeps some weight for it.
    words = part("word", "w").filter(seen("w") >= min(FREQUENT_WORD, FREQUENT_PAIR))
    contexts = part("context", "c").filter(F.col("c_kept_ordinary") + F.col("c_kept_toxic") > 0)
    alone = words.join(contexts, F.col("w_key") == F.col("c_key"), "full").select(
        F.coalesce("w_key", "c_key").bitwiseXOR(F.lit(KIND_MARKS["word"])).alias("marked"),
        ratio(single).alias("own"),
        ratio(kept_weight).alias("after"),
        F.greatest(seen("w"), seen("c")).alias("seen"),
    )
    pairs = model.filter(F.col("kind") == "pair").select("bucket", "before", "word", *[F.col(c).alias(f"p_{c}") for c in CLASSES])
    pairs = (
        pairs.join(words, F.col("word") == F.col("w_key"))
        .join(contexts, F.col("before") == F.col("c_key"))
        .select(
            F.col("bucket").bitwiseXOR(F.lit(KIND_MARKS["pair"])).alias("marked"),
            ratio(paired).alias("own"),
            F.lit(0.0).cast("float").alias("after"),
            seen("p").alias("seen"),
        )
    )
    unknown = np.log(rest["toxic"] / total["toxic"]) - np.log(rest["ordinary"] / total["ordinary"])
    # As exact as the stored ratios.
    return settle(alone.unionByName(pairs), "token-ratios"), float(np.float32(unknown))


BLOCK_SCHEMA = "block long, names binary, toxic binary, sizes binary, vocabulary binary, words binary"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts (name, text, toxic) in blocks; a block has its distinct words, and their places by text.

    Blocks get random names, so they must be stored before they are read twice.
    """
    held: dict[tuple[int, int], np.ndarray] = {}
    size = 0

    def close() -> pa.RecordBatch:
        names, labels = np.array(list(held), np.int64).T
        sizes = np.array([len(x) for x in held.values()], np.int64)
        vocabulary, words = np.unique(np.concatenate(list(held.values())), return_inverse=True)
        held.clear()
        packed = zlib.compress(words.astype(np.uint32).tobytes(), 1)
        block = int.from_bytes(os.urandom(8), "little") >> 1
        parts = [names.tobytes(), labels.tobytes(), sizes.tobytes(), vocabulary.tobytes(), packed]
        columns = [pa.array([block], pa.int64()), *[pa.array([x], pa.binary()) for x in parts]]
        return pa.RecordBatch.from_arrays(
            columns, ["block", "names", "toxic", "sizes", "vocabulary", "words"]
        )

    for batch in batches:
        keys = zip(batch.column("name").to_pylist(), batch.column("toxic").to_pylist())
        for key, text in zip(keys, _texts_of(batch)):
            if key not in held:
                held[key] = word_numbers(text)
                size += len(held[key])
            if size >= BLOCK_TOKENS:
                yield close()
                size = 0
    if held:
        yield close()


def _texts_of_block(vocabulary: bytes, sizes: bytes, words: bytes) -> list[np.ndarray]:
    places = np.frombuffer(zlib.decompress(words), np.uint32)
    numbers = np.frombuffer(vocabulary, np.int64)[places]
    return np.split(numbers, np.cumsum(np.frombuffer(sizes, np.int64))[:-1])


FEATURES = [f"f{i}" for i in range(len(STRONGEST) + 3)]
FEATURE_SCHEMA = ", ".join(["name long", "toxic long", *[f"{name} double" for name in FEATURES]])


def _asked(known, kinds: tuple[str, ...]):
    """The distinct marked keys of each block, those that the filter lets through."""

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                vocabulary = np.frombuffer(row["vocabulary"], np.int64)
                texts = _texts_of_block(row["vocabulary"], row["sizes"], row["words"])
                keys = {"pair": np.unique(np.concatenate([pair_numbers(x) for x in texts])), "word": np.append(vocabulary, 0)}
                for kind in kinds:
                    marked = keys[kind] ^ np.int64(KIND_MARKS[kind])
                    marked = marked[let_through(known.value, marked)]
                    block = np.full(len(marked), row["block"], np.int64)
                    yield pa.RecordBatch.from_pydict({"block": block, "asked": marked})

    return asked


def _scored_texts(block: pa.Table, features) -> pa.Table:
    """The rows of ``FEATURE_SCHEMA`` for the texts of the blocks in a table."""
    names, labels, rows = [np.empty(0, np.int64)], [np.empty(0, np.int64)], []
    for row in block.to_pylist():
        names.append(np.frombuffer(row["names"], np.int64))
        labels.append(np.frombuffer(row["toxic"], np.int64))
        texts = _texts_of_block(row["vocabulary"], row["sizes"], row["words"])
        rows += [features(words, label) for words, label in zip(texts, labels[-1].tolist())]
    columns = np.array(rows, np.float64).reshape(len(rows), len(FEATURES)).T
    return pa.table([np.concatenate(names), np.concatenate(labels), *columns], ["name", "toxic", *FEATURES])


def text_features(blocks: DataFrame, ratios: DataFrame, unknown: float) -> DataFrame:
    """``name, toxic`` and the features of each text of the stored ``blocks``.

    A filter of fixed size keeps words and pairs that were not counted from the join, or most of them.
    """
    known = blocks.sparkSession.sparkContext.broadcast(key_filter(ratios.select(F.col("marked").alias("key"))))

    def features(block: pa.Table, found: pa.Table) -> pa.Table:
        columns = [found.column(c).to_numpy() for c in ("marked", "own", "after")]
        model = Ratios(*columns, unknown)
        return _scored_texts(block, lambda words, label: model.features(words))

    wanted = blocks.mapInArrow(_asked(known, ("pair", "word")), "block long, asked long")
    found = wanted.join(ratios, F.col("asked") == F.col("marked")).select("block", "marked", "own", "after")
    return blocks.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(features, FEATURE_SCHEMA)


def _head_and_rest(ratios: DataFrame) -> tuple[pa.Table, DataFrame | None]:
    """The most frequent of the stored ratios, ``HEAD_ROWS`` at most, and the others, if there are any."""
    level = F.floor(F.log2(F.greatest("seen", F.lit(1.0))) * 8)
    bar, size = 0, 0
    for row in sorted(ratios.groupBy(level.alias("level")).count().collect(), reverse=True):
        size += row["count"]
        if size > HEAD_ROWS:
            bar = row["level"] + 1
            break
    head = ratios.filter(level >= bar).select("marked", "own", "after").toArrow()
    return head, ratios.filter(level < bar) if size > HEAD_ROWS else None


def _grouped_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[str], list[np.ndarray]]]:
    """Names, texts and words of texts, about ``SCORED_TOKENS`` at a time."""
    names, texts, words, size = [], [], [], 0
    for batch in batches:
        for name, text in zip(batch.column("name").to_pylist(), _texts_of(batch)):
            names.append(name)
            texts.append(text)
            words.append(word_numbers(text))
            size += len(words[-1])
            if size >= SCORED_TOKENS:
                yield names, texts, words
                names, texts, words, size = [], [], [], 0
    if names:
        yield names, texts, words


def _needs_rest(rest, words: list[np.ndarray]) -> np.ndarray:
    """Whether each text may hold a word, context or pair behind the filter ``rest``."""
    if rest is None:
        return np.zeros(len(words), bool)
    here, before = np.concatenate(words), np.concatenate([words_before(x) for x in words])
    hit = let_through(rest.value, here) | let_through(rest.value, before)
    hit |= let_through(rest.value, _paired(before, here) ^ np.int64(KIND_MARKS["pair"]))
    ends = np.cumsum([len(x) for x in words])
    so_far = np.append(0, np.cumsum(hit))
    return so_far[ends] > so_far[np.append(0, ends[:-1])]


def scored_features(texts: DataFrame, ratios: DataFrame, unknown: float) -> DataFrame:
    """``name, toxic`` and the features of the texts (name, text, toxic), each where it is read or in a block."""
    context = texts.sparkSession.sparkContext
    head, others = _head_and_rest(ratios)
    known = context.broadcast([head.column(c).to_numpy() for c in ("marked", "own", "after")])
    rest = others and context.broadcast(key_filter(others.select(F.col("marked").alias("key"))))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Ratios(*known.value, unknown)
        for names, _, words in _grouped_texts(batches):
            here = np.flatnonzero(~_needs_rest(rest, words))
            if not len(here):
                continue
            words = [words[i] for i in here]
            before = np.concatenate([words_before(x) for x in words])
            ratio = model.of_tokens(np.concatenate(words), before)
            rows = [summed_up(x) for x in np.split(ratio, np.cumsum([len(x) for x in words])[:-1])]
            columns = np.array(rows, np.float64).reshape(len(rows), len(FEATURES)).T
            fixed = [np.array(names, np.int64)[here], np.full(len(here), UNLABELLED, np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*fixed, *columns)], ["name", "toxic", *FEATURES])

    def others_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names, held, words in _grouped_texts(batches):
            there = np.flatnonzero(_needs_rest(rest, words)).tolist()
            columns = [[names[i] for i in there], [held[i] for i in there], [UNLABELLED] * len(there)]
            kinds = (pa.int64(), pa.string(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds)], ["name", "text", "toxic"])

    direct = texts.select("name", "text").mapInArrow(features, FEATURE_SCHEMA)
    if rest is None:
        return direct
    left = texts.select("name", "text").mapInArrow(others_only, "name long, text string, toxic int")
    blocks = settle(left.mapInArrow(_blocks, BLOCK_SCHEMA), "text-blocks")
    return direct.unionByName(text_features(blocks, ratios, unknown))


def calibration_features(blocks: DataFrame, model: DataFrame, totals: dict[str, float]) -> DataFrame:
    """The same for blocks of training texts, each without its own counts."""
    kinds = list(KIND_MARKS)
    mark, code = F.lit(0), F.lit(0)
    for number, (kind, value) in enumerate(KIND_MARKS.items()):
        mark = F.when(F.col("kind") == kind, F.lit(value)).otherwise(mark)
        code = F.when(F.col("kind") == kind, F.lit(number)).otherwise(code)
    marked = model.select(F.col("bucket").bitwiseXOR(mark).alias("marked"), code.cast("tinyint").alias("code"), "bucket", *SUMS)
    known = blocks.sparkSession.sparkContext.broadcast(key_filter(marked.select(F.col("marked").alias("key"))))

    def features(block: pa.Table, found: pa.Table) -> pa.Table:
        # Kinds as numbers: as strings they would be larger than all the rest.
        rows = pd.DataFrame({name: found.column(name).to_numpy() for name in ("bucket", *SUMS)})
        rows["kind"] = pd.Categorical.from_codes(found.column("code").to_numpy(), kinds)
        return _scored_texts(block, Model(rows, totals).features)

    wanted = blocks.mapInArrow(_asked(known, ("pair", "word")), "block long, asked long")
    found = wanted.join(marked, F.col("asked") == F.col("marked")).select("block", "code", "bucket", *SUMS)
    return blocks.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(features, FEATURE_SCHEMA)


def calibration_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``name, text, toxic`` of at most ``CALIBRATION_ROWS`` training rows, by hash of the id."""
    order = F.xxhash64("label_id")
    first = settle(
        labels.orderBy(order, "label_id").limit(CALIBRATION_ROWS), "calibration-labels"
    )
    # One text a label: where its id is repeated, that of the least hash.
    chosen = _labelled(docs, first).groupBy("label_id").agg(
        F.min_by("text", F.xxhash64("text")).alias("text"), F.max("toxic").alias("toxic")
    )
    return chosen.select(F.col("label_id").alias("name"), "text", "toxic")


def text_name(text: F.Column) -> F.Column:
    """Equal texts have one name and one score."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def text_scores(docs: DataFrame, labels: DataFrame) -> DataFrame | None:
    """``name, score`` of each distinct text, stored; None without training rows of both classes."""
    small_batches(docs.sparkSession)
    train = settle(training_rows(labels), "toxic-labels")
    model = count_model(docs, train)
    totals = _word_totals(model)
    texts = docs.select(
        text_name(F.col("text")).alias("name"), "text", F.lit(UNLABELLED).alias("toxic")
    )
    known = settle(calibration_texts(docs, train).mapInArrow(_blocks, BLOCK_SCHEMA), "calibration-blocks")
    sample = settle(calibration_features(known, model, totals), "calibration-features")
    sample = sample.select(*FEATURES, "toxic").toPandas().to_numpy(np.float64)
    if len(np.unique(sample[:, -1])) < 2:
        return None
    # A fixed order keeps sums, and so the last bits of the weights, the same in every run.
    sample = sample[np.lexsort(sample.T)]
    weights = fit_weights(sample[:, :-1], sample[:, -1]).tolist()
    ratios, unknown = token_ratios(model, totals)
    features = scored_features(texts, ratios, unknown)
    raw = F.lit(weights[-1])
    for i, weight in enumerate(weights[:-1]):
        raw = raw + F.col(f"f{i}") * F.lit(weight)
    raw = F.greatest(F.least(raw, F.lit(30.0)), F.lit(-30.0))
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-raw))
    return settle(features.groupBy("name").agg(F.max(score).alias("score")), "text-scores")


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` with ``score`` added (0 to 1; higher: toxic is likelier).

    Null texts count as empty; an empty text gets the score of a text with no evidence. Without
    training rows of both classes every score is 0.0, which rejects nothing. Repeated rows are
    scored alike. Other columns stay as they are; a column named ``score`` is replaced.
    """
    scores = text_scores(docs, labels)
    if scores is None:
        return docs.withColumn("score", F.lit(0.0))
    # Columns get numbers meanwhile, so that none can clash and those not asked for are not shuffled.
    columns = docs.columns
    numbered = docs.select(
        *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)],
        text_name(F.col("text")).alias("text_name"),
    )
    joined = numbered.join(scores, numbered["text_name"] == scores["name"], "left")
    out = [(c, F.col("score" if c == "score" else f"c{i}")) for i, c in enumerate(columns)]
    if "score" not in columns:
        out.append(("score", F.col("score")))
    return joined.select(*[value.alias(c) for c, value in out])


def reject_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score below ``THRESHOLD``, with the columns of ``docs``."""
    scores = text_scores(docs, labels)
    if scores is None:
        return docs
    toxic = settle(scores.filter(F.col("score") >= THRESHOLD).select("name"), "toxic-texts")
    return docs.join(toxic, text_name(docs["text"]) == toxic["name"], "left_anti")
