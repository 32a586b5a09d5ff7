"""Removal of repeated passages by column-wise construction over many documents.

A passage is a string of ``LENGTH`` bytes. It is repeated if it starts anywhere else too, in another
document or the same one.

1. Each passage has an anchor: of the ``GRAM``-byte strings in it the first with the least hash.
   Equal passages have equal anchors at equal places. Passages that follow each other and share an
   anchor form a stretch. Stretches whose anchor occurs once in the collection are done with.
2. The stretches with one anchor are laid over each other, anchor above anchor, and become the
   documents of a small collection. It is built column by column from the right: each round inserts
   one symbol of every document. The symbols, read in the order of the suffixes behind them, are
   the column's Burrows-Wheeler transform; sorting it (stably) gives the order of the longer suffixes,
   and the common prefix of neighbours grows by one where their symbols agree, from the least of
   those between them. Suffixes that begin in different columns cannot be equal passages, so that a
   round reads and writes one column in sequence, not the whole transform.
3. A passage whose suffix shares ``LENGTH`` symbols with a neighbour is repeated, and so is every
   passage of a stretch that occurs more than once: equal stretches are one document of a collection,
   and a collection of one document needs no rounds.
4. Collections are worked through in blocks of a bounded number of documents. An anchor with more
   than ``MOST`` different stretches is split: narrower stretches share more than the anchor, and are
   laid together by all that they share, down to single passages, of which only equal ones meet.

What lies between the steps are tables in the shared folder, written and read in sequence. Rows are
named by a number, so that equal ids and texts are told apart.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import key_filter, let_through, settle

LENGTH = 200
GRAM = 100
#: Places an anchor can have in a passage; a passage begins at most so many, less one, before its anchor.
PLACES = LENGTH - GRAM + 1
#: Different stretches that are laid over each other at most, and documents of a block, about.
MOST = 2048
BLOCK = 16_384
#: Passages in a stretch, where too many share an anchor, level by level.
WIDTHS = (25, 5, 1)
#: Bytes that are hashed together, about; a longer text is cut, with all its passages whole.
BUFFER = 1 << 18
#: Rows that a task hands on at once, about.
CHUNK = 8192
#: More than any place in a text.
FAR = 1 << 40
_PLACE_BITS = np.uint64(2 * BUFFER - 1)
#: Any odd number; the hash of a string is that of its bytes as digits to this base, mod 2^64.
BASE = 0x9E3779B97F4A7C15


@cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse."""
    out = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        steps = np.full(2 * BUFFER, base, np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each ``GRAM``-byte string of ``data``."""
    powers, inverses = _powers()
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=sums[1:])
    h = (sums[GRAM:] - sums[:-GRAM]) * inverses[: len(data) - GRAM + 1]
    for shift, factor in ((31, 0xBF58476D1CE4E5B9), (29, 0x94D049BB133111EB)):
        h ^= h >> np.uint64(shift)
        h *= np.uint64(factor)
    return h ^ (h >> np.uint64(32))


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    up = np.minimum.accumulate(blocks, axis=1).ravel()
    down = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(down[:n], up[width - 1 : width - 1 + n])


def _laid_out(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Data, and of each piece in it: the number of its text, its place in the text and in the data."""
    parts: list[bytes] = []
    held: list[tuple[int, int, int]] = []
    size = 0
    for number, text in enumerate(texts):
        for at in range(0, len(text) - LENGTH + 1, BUFFER - LENGTH + 1):
            part = text[at : at + BUFFER]
            parts.append(part)
            held.append((number, at, size))
            size += len(part)
            if size >= BUFFER:
                yield (np.frombuffer(b"".join(parts), np.uint8), *np.array(held, np.int64).T)
                parts, held, size = [], [], 0
    if parts:
        yield (np.frombuffer(b"".join(parts), np.uint8), *np.array(held, np.int64).T)


def stretches_of(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The stretches of all texts: number of the text, first passage, how many, its column, the anchor.

    The column is the place of the first passage against the anchor, from ``1 - PLACES`` to 0.
    """
    found: list[tuple[np.ndarray, ...]] = []
    for data, numbers, places, begins in _laid_out(texts):
        lengths = np.diff(np.append(begins, len(data)))
        h = gram_hashes(data)
        marked = (h & ~_PLACE_BITS) | np.arange(len(h), dtype=np.uint64)
        anchor = (least_of(marked, PLACES) & _PLACE_BITS).astype(np.int64)
        ends = begins + lengths - LENGTH + 1
        steps = np.zeros(len(data) + 1, np.int8)
        steps[begins] += 1
        steps[ends] -= 1
        inside = np.cumsum(steps[: len(anchor)], dtype=np.int8) > 0
        first = np.ones(len(anchor), bool)
        first[1:] = anchor[1:] != anchor[:-1]
        first[begins] = True
        start = np.flatnonzero(first & inside)
        piece = np.searchsorted(begins, start, side="right") - 1
        stop = np.minimum(np.append(start[1:], len(data)), ends[piece])
        found.append(
            (numbers[piece], start - begins[piece] + places[piece], stop - start, start - anchor[start],
             h[anchor[start]].view(np.int64))
        )
    names = ("number", "start", "passages", "col", "anchor")
    empty = np.empty(0, np.int64)
    return {name: np.concatenate([empty, *(f[i] for f in found)]) for i, name in enumerate(names)}


def _bodies(batch: pa.RecordBatch) -> list[bytes]:
    unpack = zstandard.ZstdDecompressor().decompress
    return [unpack(x) for x in batch.column("body").to_pylist()]


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        bodies = pa.array([pack(x) for x in batch.column("text").to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), bodies], ["doc_id", "body"])


def _count_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        anchors, counts = np.unique(stretches_of(_bodies(batch))["anchor"], return_counts=True)
        yield pa.RecordBatch.from_pydict({"anchor": anchors, "n": counts})


def _candidates(bits):
    """The stretches whose anchor may occur elsewhere, with a hash of what they hold."""

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _bodies(batch)
            found = stretches_of(texts)
            here = let_through(bits.value, found["anchor"])
            number, start, passages, col, anchor = (values[here] for values in found.values())
            stops = start + passages + LENGTH - 1
            hashes = (
                xxhash.xxh3_64_intdigest(texts[i][a:b]) - (1 << 63)
                for i, a, b in zip(number.tolist(), start.tolist(), stops.tolist())
            )
            rows = batch.column("row_id").to_numpy()[number]
            held = np.fromiter(hashes, np.int64, len(rows))
            columns = [rows, start, passages, col, anchor, held]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], CANDIDATE_COLUMNS)

    return candidates


CANDIDATE_COLUMNS = ["row_id", "start", "passages", "col", "grp", "key"]
CANDIDATES = ", ".join(f"{name} long" for name in CANDIDATE_COLUMNS)
CONTENTS = "grp long, key long, col long, n long, content binary"
CONTENT_COLUMNS = ["grp", "key", "col", "n", "content"]


def _batches(rows: Iterator[tuple], kinds: list[pa.DataType], names: list[str]) -> Iterator[pa.RecordBatch]:
    """The rows in batches of bounded size."""
    while chunk := list(islice(rows, CHUNK)):
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*chunk), kinds)], names)


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the stretches that are listed for each text."""

    def contents(batch: pa.RecordBatch) -> Iterator[tuple]:
        texts, found = _bodies(batch), batch.column("found")
        listed = found.flatten()
        names = ("grp", "key", "col", "n", "start", "passages")
        columns = (listed.field(name).to_numpy().tolist() for name in names)
        owners = pc.list_parent_indices(found).to_pylist()
        for owner, grp, key, col, n, start, passages in zip(owners, *columns):
            yield grp, key, col, n, texts[owner][start : start + passages + LENGTH - 1]

    for batch in batches:
        yield from _batches(contents(batch), [*[pa.int64()] * 4, pa.binary()], CONTENT_COLUMNS)


def insert_columns(
    contents: list[bytes], cols: np.ndarray, groups: np.ndarray
) -> np.ndarray:
    """Whether each passage of each content is held by another content of its group.

    ``groups`` rises. The result has a row per content and a column per place a passage can begin
    at, ``1 - PLACES`` first.
    """
    n = len(contents)
    width = PLACES - 1 + LENGTH
    matrix = np.zeros((width, n), np.uint16)  # zero: no symbol of this document in this column
    for i, (content, at) in enumerate(zip(contents, (cols + PLACES - 1).tolist())):
        matrix[at : at + len(content), i] = np.frombuffer(content, np.uint8)
        matrix[at : at + len(content), i] += 1
    repeated = np.zeros((PLACES, n), bool)
    order = np.arange(n)
    shift = (groups - groups[0] if n else groups) * 257
    common = np.zeros(n + 1, np.int16)  # of each suffix and the one before it
    for column in range(width - 1, -1, -1):
        transform = matrix[column, order]
        keys = shift[order] + transform
        place = np.argsort(keys, kind="stable")
        order, keys = order[place], keys[place]
        grown = np.zeros(n + 1, np.int16)
        same = (keys[1:] == keys[:-1]) & (transform[place[1:]] > 0)
        at = np.flatnonzero(same) + 1
        grown[at] = 1 + _least_between(common, place[at - 1] + 1, place[at])
        common = grown
        if column < PLACES:
            long_enough = common >= LENGTH
            repeated[column, order] = long_enough[:-1] | long_enough[1:]
    return repeated.T


def _least_between(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The least of ``values[first..last]``, both included."""
    out = values[last]
    level, size = values, 1
    spans = last - first + 1
    while len(spans) and 2 * size <= spans.max():
        level = np.minimum(level[: len(level) - size], level[size:])
        size *= 2
        here = (spans >= size) & (spans < 2 * size)
        out[here] = np.minimum(level[first[here]], level[last[here] - size + 1])
    return out


FLAGS = "grp long, key long, place long, flags binary"


def _columnwise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Flags of the passages of each content, of rows sorted by group; contents without a repeat give none."""
    held: list[tuple] = []

    def close(rows: list[tuple]) -> pa.RecordBatch:
        groups, keys, cols, counts, contents = zip(*rows)
        # Few numbers, in the same order, instead of hashes.
        _, number, size = np.unique(np.array(groups), return_inverse=True, return_counts=True)
        n, cols = np.array(counts), np.array(cols)
        once = np.bincount(number, n == 1, len(size)) > 0
        todo = np.flatnonzero((size > 1)[number] & once[number])
        todo = todo[np.argsort(number[todo], kind="stable")]
        found = insert_columns([contents[i] for i in todo], cols[todo], number[todo])
        flags = {i: b"\x01" * (len(contents[i]) - LENGTH + 1) for i in np.flatnonzero(n > 1).tolist()}
        for i, row in zip(todo.tolist(), found):
            if i not in flags and row.any():
                at = cols[i] + PLACES - 1
                flags[i] = row[at : at + len(contents[i]) - LENGTH + 1].tobytes()
        columns = [[groups[i] for i in flags], [keys[i] for i in flags], [0] * len(flags)]
        return pa.RecordBatch.from_arrays(
            [*[pa.array(c, pa.int64()) for c in columns], pa.array(flags.values(), pa.binary())],
            ["grp", "key", "place", "flags"],
        )

    for batch in batches:
        held += zip(*(batch.column(c).to_pylist() for c in CONTENT_COLUMNS))
        if len(held) >= BLOCK:
            # The last group may go on in the next batch.
            stop = len(held)
            while stop and held[stop - 1][0] == held[-1][0]:
                stop -= 1
            if stop:
                yield close(held[:stop])
                held = held[stop:]
    if held:
        yield close(held)


PIECE_COLUMNS = ["whole_grp", "whole_key", "place", "n", "grp", "key", "col", "content"]
PIECES = ", ".join([*[f"{name} long" for name in PIECE_COLUMNS[:-1]], "content binary"])


def _narrower(width: int):
    """Stretches of at most ``width`` passages, grouped by all the bytes that these can share."""

    def pieces(batch: pa.RecordBatch) -> Iterator[tuple]:
        for grp, key, col, n, content in zip(*(batch.column(c).to_pylist() for c in CONTENT_COLUMNS)):
            last = col + len(content) - LENGTH
            for cell in range((col + PLACES - 1) // width, (last + PLACES - 1) // width + 1):
                begin = cell * width - PLACES + 1
                end = begin + width - 1
                low, high = max(col, begin), min(last, end)
                piece = content[low - col : high - col + LENGTH]
                core = struct.pack("<qq", grp, cell) + content[end - col : begin - col + LENGTH]
                group, held = (xxhash.xxh3_64_intdigest(x) - (1 << 63) for x in (core, piece))
                yield grp, key, low - col, n, group, held, low, piece

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _batches(pieces(batch), [*[pa.int64()] * 7, pa.binary()], PIECE_COLUMNS)

    return split


def repeated_passages(contents: DataFrame, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """``grp, key, place, flags`` of the repeated passages of stored, distinct stretches."""
    hot = settle(contents.groupBy("grp").count().filter(F.col("count") > MOST).select("grp"), "hot-anchors")
    crowded = widths and not hot.isEmpty()
    plain = contents.join(hot, "grp", "left_anti") if crowded else contents
    found = (
        plain.select(*CONTENT_COLUMNS).repartition("grp").sortWithinPartitions("grp").mapInArrow(_columnwise, FLAGS)
    )
    if not crowded:
        return found
    dense = contents.join(hot, "grp", "left_semi").select(*CONTENT_COLUMNS)
    pieces = settle(dense.mapInArrow(_narrower(widths[0]), PIECES), "narrow-stretches")
    first = [F.first(c).alias(c) for c in ("col", "content")]
    distinct = pieces.groupBy("grp", "key").agg(*first, F.sum("n").alias("n"))
    below = repeated_passages(settle(distinct, "distinct-narrow-stretches"), widths[1:])
    below = below.withColumnRenamed("place", "further")
    up = pieces.select("whole_grp", "whole_key", "place", "grp", "key").join(below, ["grp", "key"])
    place = F.col("place") + F.col("further")
    return found.union(up.select("whole_grp", "whole_key", place, "flags"))


def _spans(found: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, begin and end of the maximal runs of bytes that repeated passages cover, by text and begin.

    Without flags all passages of a stretch are repeated.
    """
    listed = found.flatten()
    owner = pc.list_parent_indices(found).to_numpy().astype(np.int64)
    start, passages = (listed.field(name).to_numpy() for name in ("start", "passages"))
    flags = listed.field("flags")
    whole = flags.is_null().to_numpy(zero_copy_only=False)
    owners, first, last = [owner[whole]], [start[whole]], [(start + passages - 1)[whole]]
    for i in np.flatnonzero(~whole).tolist():
        edges = np.flatnonzero(np.diff(np.frombuffer(flags[i].as_py(), np.int8), prepend=0, append=0))
        owners.append(np.full(len(edges) // 2, owner[i]))
        first.append(start[i] + edges[::2])
        last.append(start[i] + edges[1::2] - 1)
    owner, first, last = map(np.concatenate, (owners, first, last))
    order = np.lexsort((first, owner))
    owner, first, last = owner[order], first[order], last[order]
    # No run reaches from one text into the next.
    reach = np.maximum.accumulate(owner * FAR + last + LENGTH)
    opens = np.ones(len(owner), bool)
    opens[1:] = owner[1:] * FAR + first[1:] > reach[:-1]
    opens = np.flatnonzero(opens)
    closes = np.append(opens[1:], len(owner))[: len(opens)] - 1
    return owner[opens], first[opens], reach[closes] - owner[opens] * FAR


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        owner, begin, end = _spans(batch.column("found"))
        counts = np.bincount(owner, minlength=batch.num_rows)
        offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
        spans = pa.ListArray.from_arrays(
            pa.array(offsets), pa.StructArray.from_arrays([pa.array(begin), pa.array(end)], ["start", "end"])
        )
        unpack = zstandard.ZstdDecompressor().decompress
        kept, sizes = [], []
        for i, body in enumerate(batch.column("body").to_pylist()):
            text = unpack(body)
            mine = slice(offsets[i], offsets[i + 1])
            bounds = [0, *np.column_stack((begin[mine], end[mine])).ravel().tolist(), len(text)]
            kept.append(b"".join(text[a:b] for a, b in zip(bounds[::2], bounds[1::2])))
            sizes.append(len(text))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), spans, pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "spans", "kept"],
        )


def _rows_among(rows: DataFrame, named: DataFrame) -> DataFrame:
    """The rows that ``named`` may hold, by a filter of fixed size, so that a join need not shuffle all of them."""
    bits = rows.sparkSession.sparkContext.broadcast(key_filter(named.select(F.xxhash64("row_id").alias("key"))))

    def among(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(let_through(bits.value, batch.column("key").to_numpy()))).drop_columns("key")

    return rows.withColumn("key", F.xxhash64("row_id")).mapInArrow(among, rows.schema)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` of each row: the repeated runs of bytes and the bytes outside them.

    Places count the bytes of the text in UTF-8; ``kept`` is binary, since a run may end inside a
    character. Null texts count as empty; texts shorter than a passage keep all. Every row is a
    document of its own: equal texts repeat each other, whatever their ids, and each loses all of
    its passages. Texts of any length are hashed in pieces that overlap by a passage. An empty table
    gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    plain = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("text"),
    )
    # The numbers of the rows are drawn once, when they are stored.
    rows = settle(
        plain.mapInArrow(_pack, "doc_id long, body binary").withColumn("row_id", F.monotonically_increasing_id()),
        "bodies",
    )
    counted = rows.select("body").mapInArrow(_count_anchors, "anchor long, n long")
    repeated = settle(
        counted.groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1").select("anchor"), "repeated-anchors"
    )
    bits = spark.sparkContext.broadcast(key_filter(repeated.select(F.col("anchor").alias("key"))))
    stretches = settle(rows.select("row_id", "body").mapInArrow(_candidates(bits), CANDIDATES), "stretches")
    one = [F.first(c).alias(c) for c in ("row_id", "start", "passages", "col")]
    distinct = settle(
        stretches.groupBy("grp", "key").agg(F.count(F.lit(1)).alias("n"), *one), "distinct-stretches"
    )
    # Only where different stretches share an anchor need their bytes be looked at.
    open_ = distinct.groupBy("grp").agg(F.count("key").alias("kinds"), F.count_if(F.col("n") == 1).alias("single"))
    open_ = settle(open_.filter("kinds > 1 AND single > 0").select("grp"), "shared-anchors")
    wanted = settle(
        distinct.join(open_, "grp", "left_semi")
        .groupBy("row_id")
        .agg(F.collect_list(F.struct("grp", "key", "col", "n", "start", "passages")).alias("found")),
        "wanted-stretches",
    )
    contents = settle(
        _rows_among(rows.select("row_id", "body"), wanted).join(wanted, "row_id").mapInArrow(_cut_out, CONTENTS),
        "contents",
    )
    flags = repeated_passages(contents).select("grp", "key", "place", "flags")
    whole = distinct.filter("n > 1").select("grp", "key", F.lit(0).alias("place"), F.lit(None).cast("binary").alias("flags"))
    marks = (
        stretches.select("grp", "key", "row_id", "start", "passages")
        .join(whole.union(flags), ["grp", "key"])
        .groupBy("row_id")
        .agg(F.collect_list(F.struct((F.col("start") + F.col("place")).alias("start"), "passages", "flags")).alias("found"))
    )
    schema = "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"
    return rows.join(marks, "row_id", "left").select("doc_id", "body", "found").mapInArrow(_removed, schema)
