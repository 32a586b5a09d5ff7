"""Token counts by rank-synchronous merging of ragged arrays.

For vocabulary files in the JSON form of byte-pair models with word ends: texts are normalised
(NFC, lower case), cut into pre-tokens, and each pre-token is merged on its own. All pre-tokens of
a batch that are not known yet lie end to end in one array of symbols. In each round every
pre-token finds its lowest-ranked neighbouring pair, and all occurrences of these pairs are
merged at once; pre-tokens without a pair left are done and give their number of symbols. A
symbol is made by one merge only, so a merge cannot bring about a pair of lower rank, and the
rounds end where merging pair by pair would.

The merge table is broadcast: its size is that of the vocabulary file. Texts are independent of
each other, and nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

LIMIT = 2048
#: Pre-tokens of the texts that are counted together, about.
GATHERED = 200_000
CACHE_PRE_TOKENS = 500_000
#: White space as the vocabulary's patterns mean it (Unicode White_Space).
_SPACE = r"\t-\r \x85\xa0  -     　"
_PRE_TOKEN = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{_SPACE}\p{{L}}\p{{N}}]+")
#: Lower case that str.lower() lacks: a sigma at the end of a word, two letters of Unicode 16.
_LOWER = {0x3A3: 0x3C3, 0xA7CB: 0x264, 0xA7DC: 0x19B}
_NO_PAIR = np.int32(2**31 - 1)


def byte_symbols() -> list[str]:
    """The character that stands for each byte: printable ones for themselves, others from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b if b in printable else next(spare)) for b in range(256)]


class MergeTable:
    """A vocabulary as arrays: symbols of bytes, and ranks and results of pairs."""

    def __init__(self, vocabulary: dict):
        model = vocabulary["model"]
        ids = model["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        symbols = byte_symbols()
        self.inner = np.array([ids[c] for c in symbols], np.int64)
        self.final = np.array([ids[c + suffix] for c in symbols], np.int64)
        self.width = max(ids.values()) + 1
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        key = np.array([ids[a] * self.width + ids[b] for a, b in merges], np.int64)
        order = np.argsort(key, kind="stable")
        self.key = key[order]
        self.rank = order.astype(np.int32)
        self.result = np.array([ids[a + b] for a, b in merges], np.int64)
        self.special = [t["content"] for t in vocabulary.get("added_tokens", [])]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.rank[at], _NO_PAIR)

    def lengths(self, pre_tokens: list[str]) -> np.ndarray:
        """Number of tokens of each pre-token (none is empty)."""
        raw = [p.encode("utf-8", "surrogatepass") for p in pre_tokens]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        data = np.frombuffer(b"".join(raw), np.uint8)
        symbols = self.inner[data]
        last = np.cumsum(sizes) - 1
        symbols[last] = self.final[data[last]]
        owner = np.repeat(np.arange(len(raw)), sizes)
        out = sizes.copy()
        while len(symbols) > 1:
            rank = self.ranks(symbols[:-1], symbols[1:])
            rank[owner[:-1] != owner[1:]] = _NO_PAIR
            first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            low = np.minimum.reduceat(np.append(rank, _NO_PAIR), first)
            group = np.cumsum(np.concatenate(([0], (owner[1:] != owner[:-1]).astype(np.int64))))
            chosen = np.flatnonzero((rank == low[group[:-1]]) & (rank != _NO_PAIR))
            if not len(chosen):
                break
            chosen = _apart(chosen)
            symbols[chosen] = self.result[rank[chosen]]
            keep = np.ones(len(symbols), bool)
            keep[chosen + 1] = False
            live = low[group] != _NO_PAIR
            out -= np.bincount(owner[chosen], minlength=len(out))
            keep &= live
            symbols, owner = symbols[keep], owner[keep]
        return out


def _apart(chosen: np.ndarray) -> np.ndarray:
    """Of places in a row, the first, third, fifth...: a symbol is merged once in a round."""
    starts = np.concatenate(([True], np.diff(chosen) != 1))
    at = np.arange(len(chosen))
    return chosen[(at - np.maximum.accumulate(np.where(starts, at, 0))) % 2 == 0]


def normalised(text: str) -> str:
    """NFC and lower case, each character by itself (so a final sigma is no exception)."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).translate(_LOWER).lower()


class Counter:
    """Counts the tokens of texts; lengths of pre-tokens are remembered from batch to batch."""

    def __init__(self, table: MergeTable):
        self.table = table
        self.known: dict[str, int] = {}
        self.special = re.compile("|".join(map(re.escape, table.special))) if table.special else None

    def pieces(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of a text, and the number of special strings between them."""
        if self.special is None or not (marks := len(self.special.findall(text))):
            return _PRE_TOKEN.findall(normalised(text)), 0
        parts = self.special.split(text)
        return [p for part in parts for p in _PRE_TOKEN.findall(normalised(part))], marks

    def count(self, texts: Iterable[str | None]) -> list[int]:
        """Tokens of each text. Pre-tokens not met before are merged together, those of many texts at a time."""
        out: list[int] = []
        held: list[tuple[list[str], int]] = []
        size = 0
        for text in texts:
            held.append(self.pieces(text or ""))
            size += len(held[-1][0])
            if size >= GATHERED:
                out += self._counted(held)
                held, size = [], 0
        return out + self._counted(held)

    def _counted(self, held: list[tuple[list[str], int]]) -> list[int]:
        distinct = set().union(*(pieces for pieces, _ in held))
        fresh = list(distinct.difference(self.known))
        if fresh:
            if len(self.known) + len(fresh) > CACHE_PRE_TOKENS:
                self.known.clear()
                fresh = list(distinct)
            self.known.update(zip(fresh, self.table.lengths(fresh).tolist()))
        return [marks + sum(map(self.known.__getitem__, pieces)) for pieces, marks in held]


#: Counters of this worker process, by the digest of their vocabulary; the newest only.
_counters: dict[str, Counter] = {}


def _counter(digest: str, table) -> Counter:
    if digest not in _counters:
        _counters.clear()
        _counters[digest] = Counter(table.value)
    return _counters[digest]


def load_table(path: str) -> MergeTable:
    with open(path, encoding="utf-8") as file:
        return MergeTable(json.load(file))


def token_counts(docs: DataFrame, vocabulary_path: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` per row of ``docs``.

    A null text counts as empty: no bytes, no tokens, not over the limit. Repeated rows and null
    ids give rows like any other; an empty table gives none. Other columns are ignored, whatever
    their names. The vocabulary file is read by the driver only.
    """
    table = docs.sparkSession.sparkContext.broadcast(load_table(vocabulary_path))
    with open(vocabulary_path, "rb") as file:
        digest = hashlib.sha256(file.read()).hexdigest()

    @F.pandas_udf(LongType())
    def count(texts: pd.Series) -> pd.Series:
        return pd.Series(_counter(digest, table).count(texts), dtype="int64")

    n = docs.select(
        "doc_id",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        count(F.col("text")).alias("n_tokens"),
    )
    return n.select("*", (F.col("n_tokens") > limit).alias("over_limit"))
