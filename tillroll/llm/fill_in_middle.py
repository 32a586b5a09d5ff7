"""Fill-in-middle transformation by piece tables.

A document is a list of pieces over two buffers that never change: its text and the sentinels. A
piece is a descriptor ``(buffer, start, end)`` in code points. Cutting splits the descriptor that
covers a place; an arrangement is a permutation of the descriptors; its inverse brings an arranged
document back, whose pieces then lie over the arranged text; digests are taken piece by piece. No
text is copied until the arranged document is written out.

Where a document is cut, and in which form it is arranged, follows from a hash of its id.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import pairwise
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

SEED = 42
#: Of 100 documents so many are arranged, and of 100 arranged ones so many suffix first.
ARRANGED_PERCENT = 50
SUFFIX_FIRST_PERCENT = 80

#: Fixed values of the format.
SENTINELS = "<P><S><M>"
PLAIN, PREFIX_FIRST, SUFFIX_FIRST = "plain", "psm", "spm"

TEXT, MARKS = 0, 1

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


class Piece(NamedTuple):
    buffer: int
    start: int
    end: int


def cut(piece: Piece, places: Iterable[int]) -> list[Piece]:
    """The descriptor split at each of the rising ``places``; equal places leave an empty piece between."""
    bounds = [piece.start, *places, piece.end]
    return [Piece(piece.buffer, start, end) for start, end in pairwise(bounds)]


#: The unarranged list: prefix, middle, suffix, then the marks of prefix, suffix and middle.
_MARK_PIECES = cut(Piece(MARKS, 0, 9), (3, 6))
_MARKS = {number: SENTINELS[p.start : p.end] for number, p in enumerate(_MARK_PIECES, 3)}
#: Which piece of the unarranged list stands at each place of the arranged one.
ARRANGEMENTS = {PREFIX_FIRST: (3, 0, 4, 2, 5, 1), SUFFIX_FIRST: (4, 2, 3, 0, 5, 1)}


def permuted(pieces: list[Piece], order: Iterable[int]) -> list[Piece]:
    return [pieces[i] for i in order]


def inverse(order: tuple[int, ...]) -> list[int]:
    return sorted(range(len(order)), key=order.__getitem__)


def strings(pieces: Iterable[Piece], text: str) -> Iterator[str]:
    for buffer, start, end in pieces:
        yield (SENTINELS if buffer else text)[start:end]


def digest(pieces: Iterable[Piece], text: str) -> str:
    """Hex SHA-256 of the document's UTF-8 bytes, taken piece after piece."""
    out = hashlib.sha256()
    for part in strings(pieces, text):
        out.update(part.encode("utf-8", "surrogatepass"))
    return out.hexdigest()


def token_ends(text: str) -> list[int]:
    """Where each token ends: a word with the white space before it, or white space that ends the text."""
    ends = [word.end() for word in _WORD.finditer(text)]
    if text and (not ends or ends[-1] < len(text)):
        ends.append(len(text))
    return ends


class Plan(NamedTuple):
    n: int
    form: str
    pieces: list[Piece]
    prefix_chars: int | None
    middle_chars: int | None


def plan(name: str, text: str, seed: int = SEED) -> Plan:
    """How the document ``name`` is cut and arranged."""
    hashed = hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()
    first, second, arrange, suffix_first = (int(hashed[i : i + 8], 16) for i in (0, 8, 16, 24))
    ends = token_ends(text)
    n = len(ends)
    whole = Piece(TEXT, 0, len(text))
    marked = any(mark in text for mark in _MARKS.values())
    if not text or marked or arrange % 100 >= ARRANGED_PERCENT:
        return Plan(n, PLAIN, [whole], None, None)
    low, high = sorted((first % (n + 1), second % (n + 1)))
    places = [0, *ends]
    pieces = cut(whole, (places[low], places[high])) + _MARK_PIECES
    form = SUFFIX_FIRST if suffix_first % 100 < SUFFIX_FIRST_PERCENT else PREFIX_FIRST
    arranged = permuted(pieces, ARRANGEMENTS[form])
    return Plan(n, form, arranged, places[low], places[high] - places[low])


def restored_pieces(output: str, form: str) -> list[Piece]:
    """Pieces over an arranged text that spell the text it was made from.

    The text holds no mark, and no mark overlaps itself or another, so the first one found is the
    one that was put there.
    """
    whole = Piece(TEXT, 0, len(output))
    if form == PLAIN:
        return [whole]
    order = ARRANGEMENTS[form]
    starts = [output.index(_MARKS[number]) for number in order[::2]]
    pieces = cut(whole, [place for at in starts for place in (at, at + 3)][1:])
    return permuted(pieces, inverse(order))[:3]


_SCHEMA = (
    "n long, form string, prefix_chars long, middle_chars long, "
    "pieces array<struct<buffer:int,start:long,end:long>>, output string, output_sha256 string"
)
_PIECES = pa.list_(pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))
_TYPE = pa.struct(
    [
        ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
        ("pieces", _PIECES), ("output", pa.string()), ("output_sha256", pa.string()),
    ]
)


def _arranged(seed: int) -> F.Column:
    @F.arrow_udf(_SCHEMA)
    def arranged(names: pa.Array, texts: pa.Array) -> pa.Array:
        rows = []
        for name, text in zip(names.to_pylist(), texts.to_pylist()):
            made = plan(name, text, seed)
            rows.append(
                {
                    "n": made.n,
                    "form": made.form,
                    "prefix_chars": made.prefix_chars,
                    "middle_chars": made.middle_chars,
                    "pieces": [piece._asdict() for piece in made.pieces],
                    "output": "".join(strings(made.pieces, text)),
                    "output_sha256": digest(made.pieces, text),
                }
            )
        return pa.array(rows, _TYPE)

    return arranged


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED
) -> DataFrame:
    """The rows of ``docs`` with a column ``infill`` added (one of that name is replaced).

    ``infill`` holds the number of tokens ``n``, the ``form``, the ``pieces`` over text (buffer 0)
    and sentinels (buffer 1), the arranged text ``output`` with its digest, and the code points of
    prefix and middle (null if plain). Null texts count as empty and stay plain, and so do texts
    that hold a mark; a null id is hashed as no digits; rows with equal ids are cut by the same
    draw, each over its own tokens, so equal rows come out alike. A text of any length is one list
    of at most six pieces. An empty table gives no rows. Other columns stay as they are.
    """
    name = F.coalesce(docs[f"`{id_col}`"].cast("string"), F.lit(""))
    text = F.coalesce(docs[f"`{text_col}`"], F.lit(""))
    return docs.withColumn("infill", _arranged(seed)(name, text))


@F.arrow_udf(StringType())
def restored(outputs: pa.Array, forms: pa.Array) -> pa.Array:
    """The exact text behind each arranged one; null where either is null."""
    texts = []
    for output, form in zip(outputs.to_pylist(), forms.to_pylist()):
        known = output is not None and form is not None
        texts.append("".join(strings(restored_pieces(output, form), output)) if known else None)
    return pa.array(texts, pa.string())


@F.arrow_udf(StringType())
def restored_digest(outputs: pa.Array, forms: pa.Array) -> pa.Array:
    """The digest of the text behind each arranged one, without writing that text out."""
    digests = []
    for output, form in zip(outputs.to_pylist(), forms.to_pylist()):
        known = output is not None and form is not None
        digests.append(digest(restored_pieces(output, form), output) if known else None)
    return pa.array(digests, pa.string())


def infill_sql() -> str:
    """The digest columns of the query in SQL, for comparison."""
    draws = ", ".join(
        f"('0x' || substr(hashed, {1 + 8 * i}, 8))::BIGINT AS {name}"
        for i, name in enumerate(("first", "second", "arrange", "suffix_first"))
    )
    marked = " OR ".join(f"contains(txt, '{mark}')" for mark in _MARKS.values())
    prefix, suffix, middle = _MARKS.values()
    return f"""
    WITH named AS (
        SELECT doc_id, coalesce(text, '') AS txt, sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS hashed
        FROM documents
    ), drawn AS (
        SELECT doc_id, txt, {draws},
               regexp_extract_all(txt, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tokens
        FROM named
    ), sized AS (
        SELECT *, len(tokens) AS n,
               txt = '' OR {marked} OR arrange % 100 >= {ARRANGED_PERCENT} AS whole
        FROM drawn
    ), placed AS (
        SELECT *, least(first % (n + 1), second % (n + 1)) AS low,
               greatest(first % (n + 1), second % (n + 1)) AS high
        FROM sized
    ), parts AS (
        SELECT *, array_to_string(tokens[1:low], '') AS prefix,
               array_to_string(tokens[low + 1:high], '') AS middle,
               array_to_string(tokens[high + 1:], '') AS suffix,
               CASE WHEN whole THEN '{PLAIN}' WHEN suffix_first % 100 < {SUFFIX_FIRST_PERCENT}
                    THEN '{SUFFIX_FIRST}' ELSE '{PREFIX_FIRST}' END AS form
        FROM placed
    )
    SELECT doc_id, n::BIGINT AS n, form,
           CASE WHEN form <> '{PLAIN}' THEN length(prefix) END AS prefix_chars,
           CASE WHEN form <> '{PLAIN}' THEN length(middle) END AS middle_chars,
           sha256(CASE form WHEN '{PLAIN}' THEN txt
                  WHEN '{SUFFIX_FIRST}' THEN '{suffix}' || suffix || '{prefix}' || prefix || '{middle}' || middle
                  ELSE '{prefix}' || prefix || '{suffix}' || suffix || '{middle}' || middle END) AS output_sha256,
           sha256(txt) AS restored_sha256
    FROM parts
    """
