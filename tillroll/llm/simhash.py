"""SimHash near-duplicates by a hierarchical index in Gray order.

1. One 64-bit fingerprint per text, from all its three-word shingles.
2. Distinct fingerprints are routed: the bits form ``BLOCKS`` blocks, and two fingerprints with
   at most three differing bits agree on at least ``BLOCKS - 3`` whole blocks, so they meet under
   one of the routes. A route's key is the fingerprint with the other blocks masked out.
3. Below a key, fingerprints lie in Gray order (neighbours differ in few bits), cut into pages.
   Over each page stands a tree: every upper node keeps the bits its members share (mask and
   pattern). Two nodes are compared on the shared bits that their parents had not yet decided,
   and the differences add up on the way down: more than three drop the whole group, and too few
   open bits to exceed three take it whole, as a star instead of all pairs.
4. Pages of one key are compared page against page, after the same test on their root patterns.
5. Connected components over the links; the smallest doc_id of a component names it.

A key with very many fingerprints is cut by its Gray rank over many partitions and pages, so
no group is gathered in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tillroll.llm.common import settle
from tillroll.llm.components import connected_components

SEED = 42
SHINGLE_WORDS = 3
MAX_DIFFERENCES = 3
BLOCKS = 5
PAGE = 1024
FANOUT = 8
CHUNK = 1 << 15
ALL_BITS = np.uint64(0xFFFFFFFFFFFFFFFF)


def text_fingerprint(text: str | None) -> int:
    """Signed 64-bit fingerprint; zero for a null text and a text without words."""
    return text_fingerprints(text, 1)[0]


def text_fingerprints(text: str | None, count: int) -> list[int]:
    """So many independent fingerprints, each of the hashes of the one before, mixed; zeros without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return [0] * count
    if len(words) < SHINGLE_WORDS:
        words = [b" ".join(words)]
        span = 1
    else:
        span = SHINGLE_WORDS
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    joined = b" ".join(words)
    n = len(words) - span + 1
    digest = xxhash.xxh64_intdigest
    ones = np.zeros((count, 64), np.int64)
    for at in range(0, n, CHUNK):
        stop = min(n, at + CHUNK)
        hashes = np.array(
            [
                digest(joined[a:b], SEED)
                for a, b in zip(
                    starts[at:stop].tolist(), ends[at + span - 1 : stop + span - 1].tolist()
                )
            ],
            dtype="<u8",
        )
        for number in range(count):
            if number:
                hashes = _mixed(hashes)
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones[number] += bits.sum(axis=0, dtype=np.int64)
    return np.packbits(ones * 2 > n, axis=1, bitorder="little").view("<i8").ravel().tolist()


def _mixed(hashes: np.ndarray) -> np.ndarray:
    """Other 64 bits of the same shingles (the finaliser of splitmix64)."""
    h = hashes ^ (hashes >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_hash(text_col: str) -> F.Column:
    """Tells rows with equal ids and different texts apart."""
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


@F.pandas_udf(LongType())
def fingerprint(texts: pd.Series) -> pd.Series:
    return pd.Series([text_fingerprint(x) for x in texts], dtype="int64")


def routes(blocks: int = BLOCKS, differences: int = MAX_DIFFERENCES) -> list[int]:
    """Masks, as signed longs, of all choices of ``blocks - differences`` whole blocks."""
    return masks(blocks, blocks - differences)


def masks(blocks: int, whole: int) -> list[int]:
    """Masks, as signed longs, of all choices of ``whole`` of the blocks."""
    cuts = np.linspace(0, 64, blocks + 1).round().astype(int)
    parts = [((1 << int(b)) - 1) ^ ((1 << int(a)) - 1) for a, b in zip(cuts[:-1], cuts[1:])]
    chosen = [sum(choice) for choice in combinations(parts, whole)]
    return [m - (1 << 64) if m >> 63 else m for m in chosen]


def gray_rank(fp: F.Column) -> F.Column:
    """Place of a code in the Gray sequence, shifted so that signed order is its order."""
    rank = fp
    for step in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, step))
    return rank.bitwiseXOR(F.lit(-(1 << 63)))


class PatternTree:
    """Masked bit patterns over fingerprints in Gray order, ``FANOUT`` nodes below each node."""

    def __init__(self, fps: np.ndarray):
        self.levels = [(np.full(len(fps), ALL_BITS), fps, np.arange(len(fps)))]
        while len(self.levels[-1][0]) > 1:
            masks, patterns, _ = self.levels[-1]
            first = np.arange(0, len(masks), FANOUT)
            low = np.bitwise_and.reduceat(patterns, first)
            high = np.bitwise_or.reduceat(patterns, first)
            mask = np.bitwise_and.reduceat(masks, first) & ~(low ^ high)
            self.levels.append((mask, low & mask, first))

    def members(self, level: int, node: int) -> np.ndarray:
        size = FANOUT**level
        return np.arange(node * size, min((node + 1) * size, len(self.levels[0][0])))


def tree_links(
    left: PatternTree, right: PatternTree, limit: int
) -> tuple[np.ndarray, np.ndarray]:
    """Links ``(left item, right item)`` whose closure equals that of all pairs within ``limit``.

    Items of the right tree count on from those of the left one, unless both are the same tree.
    """
    own = left is right
    shift = 0 if own else len(left.levels[0][0])
    top = max(len(left.levels), len(right.levels)) - 1
    a, b, spent = np.zeros(1, int), np.zeros(1, int), np.zeros(1, np.int64)
    decided = np.zeros(1, np.uint64)
    us: list[np.ndarray] = []
    vs: list[np.ndarray] = []
    for level in range(top, -1, -1):
        at_left, at_right = min(level, len(left.levels) - 1), min(level, len(right.levels) - 1)
        mask_l, pattern_l, _ = left.levels[at_left]
        mask_r, pattern_r, _ = right.levels[at_right]
        shared = mask_l[a] & mask_r[b]
        spent = spent + np.bitwise_count((pattern_l[a] ^ pattern_r[b]) & shared & ~decided)
        near = spent <= limit
        a, b, spent, shared = a[near], b[near], spent[near], shared[near]
        whole = spent + np.bitwise_count(~shared) <= limit
        if not level:
            us.append(a[whole])
            vs.append(b[whole] + shift)
            break
        for x, y in zip(a[whole].tolist(), b[whole].tolist()):
            ms, ns = left.members(at_left, x), right.members(at_right, y) + shift
            us += [np.full(len(ns), ms[0]), ms]
            vs += [ns, np.full(len(ms), ns[0])]
        a, b, spent, decided = a[~whole], b[~whole], spent[~whole], shared[~whole]
        if len(a):
            a, pick = _children(a, at_left, level, len(left.levels[max(at_left - 1, 0)][0]))
            b, spent, decided = b[pick], spent[pick], decided[pick]
            b, pick = _children(b, at_right, level, len(right.levels[max(at_right - 1, 0)][0]))
            a, spent, decided = a[pick], spent[pick], decided[pick]
            if own:
                once = a <= b
                a, b, spent, decided = a[once], b[once], spent[once], decided[once]
        if not len(a):
            break
    if not us:
        return np.empty(0, int), np.empty(0, int)
    return np.concatenate(us), np.concatenate(vs)


def _children(nodes: np.ndarray, at: int, level: int, below: int) -> tuple[np.ndarray, np.ndarray]:
    """The nodes under ``nodes`` and the place of each one's parent; a lower tree waits."""
    if at < level:
        return nodes, np.arange(len(nodes))
    first = nodes * FANOUT
    counts = np.minimum(first + FANOUT, below) - first
    pick = np.repeat(np.arange(len(nodes)), counts)
    within = np.arange(len(pick)) - np.repeat(np.cumsum(counts) - counts, counts)
    return first[pick] + within, pick


def _forest(u: np.ndarray, v: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links: at most one link per fingerprint."""
    label = np.arange(len(fps))
    while True:
        low = np.minimum(label[u], label[v])
        after = label.copy()
        np.minimum.at(after, u, low)
        np.minimum.at(after, v, low)
        np.minimum.at(after, label[u], low)
        np.minimum.at(after, label[v], low)
        after = after[after]
        if np.array_equal(after, label):
            break
        label = after
    moved = np.flatnonzero(label != np.arange(len(fps)))
    signed = fps.view(np.int64)
    return signed[moved], signed[label[moved]]


def _nearest_forest(u: np.ndarray, v: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links that takes near pairs before far ones; each link is one of those given.

    So the links of it within any distance span what all links within that distance do.
    """
    signed = fps.view(np.int64)
    apart = np.bitwise_count(fps[u] ^ fps[v])
    label = np.arange(len(fps))
    us: list[int] = []
    vs: list[int] = []
    for distance in np.unique(apart):
        here = np.flatnonzero(apart == distance)
        here = here[label[u[here]] != label[v[here]]]
        ends = np.sort(np.column_stack((label[u[here]], label[v[here]])), axis=1)
        _, first = np.unique(ends[:, 0] * len(fps) + ends[:, 1], return_index=True)
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while x in parent:
                x = parent[x]
            return x

        for link in here[first].tolist():
            a, b = root(int(label[u[link]])), root(int(label[v[link]]))
            if a != b:
                parent[max(a, b)] = min(a, b)
                us.append(u[link])
                vs.append(v[link])
        if parent:
            moved = np.arange(len(fps))
            for x in parent:
                moved[x] = root(x)
            label = moved[label]
    return signed[us], signed[vs]


PAGE_SCHEMA = "a long, b long, route int, key long, first long, mask long, pattern long, fps array<long>"


def _page_rows(route, key, rank, fps, store, limit, forest) -> dict:
    tree = PatternTree(fps)
    a, b = forest(*tree_links(tree, tree, limit), fps)
    n = len(a)
    out = {"a": a.tolist(), "b": b.tolist()}
    for name in ("route", "key", "first", "mask", "pattern", "fps"):
        out[name] = [None] * n
    if store:
        mask, pattern, _ = tree.levels[-1]
        row = {
            "a": None,
            "b": None,
            "route": route,
            "key": key,
            "first": rank,
            "mask": int(mask.view(np.int64)[0]),
            "pattern": int(pattern.view(np.int64)[0]),
            "fps": fps.view(np.int64).tolist(),
        }
        for name, value in row.items():
            out[name].append(value)
    return out


def _cut_pages(page: int, limit: int, forest=_forest):
    """Links within each page of a sorted partition, and the pages that can have neighbours.

    A key that begins or ends a partition may go on in another one; its pages are handed on, and
    so are those of a key with several pages. At most one page of rows is held.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("a", pa.int64()), ("b", pa.int64()), ("route", pa.int32()), ("key", pa.int64()),
             ("first", pa.int64()), ("mask", pa.int64()), ("pattern", pa.int64()),
             ("fps", pa.list_(pa.int64()))]
        )

        held: tuple | None = None  # route, key, ranks, fps of the run that is still open
        opened = True  # the open run began the partition or has given a page already

        def close(run, store):
            route, key, ranks, fps = run
            rows = _page_rows(route, key, int(ranks[0]), fps, store, limit, forest)
            return pa.RecordBatch.from_pydict(rows, schema) if rows["a"] else None

        for batch in batches:
            if not batch.num_rows:
                continue
            route = batch.column("route").to_numpy()
            key = batch.column("key").to_numpy()
            rank = batch.column("rank").to_numpy()
            fps = batch.column("fp").to_numpy().view(np.uint64)
            turn = np.flatnonzero((np.diff(route) != 0) | (np.diff(key) != 0)) + 1
            starts = np.concatenate(([0], turn))
            ends = np.concatenate((turn, [len(route)]))
            last = len(starts) - 1
            single = ends - starts == 1
            for i in np.flatnonzero(~single | (np.arange(last + 1) == 0) | (np.arange(last + 1) == last)):
                s, e = int(starts[i]), int(ends[i])
                run = (int(route[s]), int(key[s]), rank[s:e], fps[s:e])
                if held is not None and held[:2] == run[:2]:
                    run = (*run[:2], np.concatenate((held[2], run[2])), np.concatenate((held[3], run[3])))
                elif held is not None:
                    if out := close(held, opened):
                        yield out
                    opened = False
                while len(run[2]) > page:
                    opened = True
                    if out := close((*run[:2], run[2][:page], run[3][:page]), True):
                        yield out
                    run = (*run[:2], run[2][page:], run[3][page:])
                held = run
        if held is not None and (out := close(held, True)):
            yield out

    return cut


def _compare_pages(limit: int, forest=_forest):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in zip(batch.column("fps"), batch.column("other")):
                left = x.values.to_numpy().view(np.uint64)
                right = y.values.to_numpy().view(np.uint64)
                links = tree_links(PatternTree(left), PatternTree(right), limit)
                a, b = forest(*links, np.concatenate((left, right)))
                yield pa.RecordBatch.from_pydict({"a": pa.array(a), "b": pa.array(b)})

    return compare


def near_links(
    fingerprints: DataFrame,
    blocks: int = BLOCKS,
    page: int = PAGE,
    limit: int = MAX_DIFFERENCES,
    whole: int | None = None,
) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints (column fp) with at most ``limit`` bits apart.

    The links span the components of the full link graph; within a group they are a forest, not
    all pairs. With ``whole``, routes ask for so many whole blocks in common, which may be more than
    ``limit`` differing bits leave: then not every pair meets, and the links are pairs of
    fingerprints themselves, near ones first, that something else may be asked of.
    """
    forest = _forest if whole is None else _nearest_forest
    routed = F.array(
        *[
            F.struct(F.lit(i).alias("route"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
            for i, m in enumerate(masks(blocks, blocks - limit if whole is None else whole))
        ]
    )
    routed = fingerprints.select("fp", gray_rank(F.col("fp")).alias("rank"), F.explode(routed).alias("m"))
    ordered = (
        routed.select("m.route", "m.key", "rank", "fp")
        .repartitionByRange("route", "key", "rank")
        .sortWithinPartitions("route", "key", "rank")
    )
    pages = settle(ordered.mapInArrow(_cut_pages(page, limit, forest), PAGE_SCHEMA), "pages")
    within = pages.filter("a is not null").select("a", "b")
    roots = pages.filter("a is null").drop("a", "b")
    other = roots.select(
        "route", "key", *[F.col(c).alias(f"{c}_2") for c in ("first", "mask", "pattern")],
        F.col("fps").alias("other"),
    )
    shared = F.col("mask").bitwiseAND(F.col("mask_2"))
    apart = F.bit_count(F.col("pattern").bitwiseXOR(F.col("pattern_2")).bitwiseAND(shared))
    pairs = roots.join(other, ["route", "key"]).filter(
        (F.col("first") < F.col("first_2")) & (apart <= limit)
    )
    across = pairs.select("fps", "other").mapInArrow(_compare_pages(limit, forest), "a long, b long")
    return within.union(across)


def fingerprint_classes(nodes: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """``fp, least, root`` for distinct fingerprints (columns fp, least), stored; ``root`` names those that are linked."""
    labels = settle(connected_components(near_links(nodes, blocks)), "labels")
    return settle(
        nodes.join(labels, nodes["fp"] == labels["node"], "left").select(
            "fp", "least", F.coalesce("root", "fp").alias("root")
        ),
        "rooted",
    )


def text_links(texts: DataFrame) -> DataFrame:
    """Links ``(a, b)`` between texts (columns node, fp: BIGINT) whose fingerprints are linked, stored.

    Each class of linked fingerprints is a star around its smallest node.
    """
    nodes = settle(texts.groupBy("fp").agg(F.min("node").alias("least")), "distinct-fingerprints")
    rooted = fingerprint_classes(nodes)
    heads = rooted.groupBy("root").agg(F.min("least").alias("a"))
    heads = settle(rooted.join(heads, "root").select("fp", "a"), "heads")
    return settle(
        texts.join(heads, "fp").filter("a <> node").select("a", F.col("node").alias("b")), "fingerprint-links"
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", blocks: int = BLOCKS
) -> DataFrame:
    """``doc_id, fingerprint, component_id, text_hash`` per row of ``docs``.

    Null texts count as empty; texts without words have fingerprint zero and link like others.
    Rows with equal ids are separate rows with the same name. A null id never names a component:
    a component of null ids only has a null component_id. An empty table gives no rows. Other
    columns of ``docs`` are ignored, whatever their names.
    """
    marked = settle(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            fingerprint(F.col(text_col)).alias("fp"),
            text_hash(text_col).alias("text_hash"),
        ),
        "fingerprints",
    )
    nodes = settle(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    rooted = fingerprint_classes(nodes, blocks)
    named = settle(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "named")
    classes = settle(rooted.join(named, "root").select("fp", "component_id"), "classes")
    return marked.join(classes, "fp").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
        "text_hash",
    )


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id names their component; other columns stay as they are.

    Rows that repeat the kept document (same id, same text) stay with it. Rows with a null doc_id
    have no name to be held against and stay.
    """
    copies = settle(
        near_duplicates(docs)
        .filter("doc_id <> component_id")
        .select(F.col("doc_id").alias("copy_id"), F.col("text_hash").alias("copy_hash"))
        .distinct(),
        "copies",
    )
    same = (docs["doc_id"] == copies["copy_id"]) & (text_hash("text") == copies["copy_hash"])
    return docs.join(copies, same, "left_anti")
