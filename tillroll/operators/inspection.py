"""What a raw table holds, found in one scan: rows, broken rules, gates, date format and id types."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions import clip, to_moment, to_number
from tillroll.functions.coerce import DATE_FORMATS, ID_COLUMNS, SWAPPED_FORMATS, whole_number
from tillroll.operators.cleaning import CLIPPED, usable_row
from tillroll.operators.validation import gate_rules, parsed, raw_rules, with_parsed
from tillroll.schema import MALFORMED

#: Asks for the date format that the data vote for.
AUTO = "auto"


@dataclass(frozen=True)
class Inspection:
    raw_rows: int
    rules: dict[str, int]
    #: Usable rows and failing rows per gate, as ``raise_on_gate`` takes them.
    gates: dict[str, int]
    date_format: str
    #: Id columns of which every number is a whole one that a BIGINT holds.
    integral: tuple[str, ...]

    @property
    def clean_rows(self) -> int:
        return self.gates["row_count"]

    @property
    def broken(self) -> dict[str, int]:
        return {name: count for name, count in self.rules.items() if count}


def candidate_formats(raw: DataFrame, date_format: str) -> list[str]:
    """The formats to try: the one that was named, or all that a text column may follow."""
    text = isinstance(raw.schema["order_date"].dataType, T.StringType)
    if date_format != AUTO:
        return [date_format]
    return list(DATE_FORMATS) if text else [DATE_FORMATS[0]]


def _moment(number: int) -> str:
    return f"_moment_{number}"


def inspected_columns(raw: DataFrame, formats: Sequence[str]) -> DataFrame:
    """The raw table with the parsed numbers and moments that ``inspection_counts`` looks at."""
    moments = {_moment(i): to_moment(raw, "order_date", f) for i, f in enumerate(formats)}
    return with_parsed(raw).withColumns(moments)


def inspection_counts(raw: DataFrame, formats: Sequence[str], gates=gate_rules) -> list[Column]:
    """The counts of an inspection, over ``inspected_columns``; for ``agg`` or ``observe``.

    The gates look at the values that cleaning would keep, so they are known before anything is
    published. Which rows are kept depends on the date format, so the gates are counted for each.
    """

    def cleaned(name: str) -> Column:
        return clip(parsed(name), *CLIPPED[name]) if name in CLIPPED else parsed(name)

    whole = F.col(MALFORMED).isNull() if MALFORMED in raw.columns else F.lit(True)
    counts = {"raw_rows": F.count(F.lit(1))}
    counts |= {f"rule {rule.name}": F.count_if(rule.breach) for rule in raw_rules(raw)}
    for i in range(len(formats)):
        moment = F.col(_moment(i))
        usable = whole & usable_row(lambda name, m=moment: m if name == "order_date" else parsed(name))
        counts[f"dated {i}"] = F.count_if(whole & moment.isNotNull())
        counts[f"gate {i} row_count"] = F.count_if(usable)
        for rule in gates(cleaned):
            counts[f"gate {i} {rule.name}"] = F.count_if(usable & rule.breach)
    for a, b in _swapped(formats):
        left, right = F.col(_moment(a)), F.col(_moment(b))
        counts[f"only {a} {b}"] = F.count_if(whole & left.isNotNull() & right.isNull())
        counts[f"only {b} {a}"] = F.count_if(whole & right.isNotNull() & left.isNull())
        counts[f"apart {a} {b}"] = F.count_if(whole & (left != right))
    for name in ID_COLUMNS:
        if isinstance(raw.schema[name].dataType, T.StringType):
            broken = parsed(name).isNotNull() & whole_number(F.col(name)).isNull()
            counts[f"broken {name}"] = F.count_if(whole & broken)
    return [count.alias(name) for name, count in counts.items()]


def _swapped(formats: Sequence[str]) -> list[tuple[int, int]]:
    """Places of formats that differ in the order of day and month only."""
    return [(formats.index(a), formats.index(b)) for a, b in SWAPPED_FORMATS if a in formats and b in formats]


def chosen_format(counts: Mapping[str, int], formats: Sequence[str]) -> int:
    """The place of the format that most dates follow.

    Day first or month first is decided by the dates that follow only one of the two. Where some
    follow only the one and some only the other, or where none decides, the column is ambiguous.
    """
    best = max(range(len(formats)), key=lambda i: (counts[f"dated {i}"], -i))
    for a, b in _swapped(formats):
        if best not in (a, b):
            continue
        first, second = counts[f"only {a} {b}"], counts[f"only {b} {a}"]
        if first and second:
            raise ValueError(
                f"Dates are mixed: {first} follow only {formats[a]} and {second} only {formats[b]}."
            )
        if not first and not second and counts[f"apart {a} {b}"]:
            raise ValueError(
                f"Dates are ambiguous: all of them follow both {formats[a]} and {formats[b]}; name the format."
            )
    return best


def decoded(counts: Mapping[str, int], formats: Sequence[str]) -> Inspection:
    best = chosen_format(counts, formats)

    def part(prefix: str) -> dict[str, int]:
        return {name.removeprefix(prefix): n for name, n in counts.items() if name.startswith(prefix)}

    integral = tuple(name for name, n in part("broken ").items() if not n)
    return Inspection(counts["raw_rows"], part("rule "), part(f"gate {best} "), formats[best], integral)


def inspect_raw(raw: DataFrame, date_format: str = DATE_FORMATS[0], gates=gate_rules) -> Inspection:
    """Row count, usable rows, broken rules, failed gates, date format and id types, from one scan."""
    formats = candidate_formats(raw, date_format)
    counts = inspection_counts(raw, formats, gates)
    return decoded(inspected_columns(raw, formats).agg(*counts).first().asDict(), formats)


def integral_ids(raw: DataFrame) -> tuple[str, ...]:
    """The text id columns that hold whole numbers only, from one scan of these columns."""
    names = [name for name in ID_COLUMNS if isinstance(raw.schema[name].dataType, T.StringType)]
    broken = [
        F.count_if(to_number(raw, name).isNotNull() & whole_number(F.col(name)).isNull()).alias(name)
        for name in names
    ]
    row = raw.agg(*broken).first() if names else {}
    return tuple(name for name in names if not row[name])


def probable(raw: DataFrame, formats: Sequence[str]) -> str:
    """The first format that the first date there is follows; a guess, to be held against the votes."""
    if len(formats) == 1:
        return formats[0]
    tried = [to_moment(raw, "order_date", f).isNotNull().alias(str(i)) for i, f in enumerate(formats)]
    row = raw.where(F.col("order_date").isNotNull()).limit(1).select(*tried).first()
    follows = [f for f, does in zip(formats, row or ()) if does]
    return follows[0] if follows else formats[0]
