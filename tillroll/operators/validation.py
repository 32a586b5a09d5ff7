"""Rule checks on raw rows and gates on cleaned rows. Each check set costs one pass."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions import to_number
from tillroll.operators.contracts import require_columns
from tillroll.schema import MALFORMED, NUMBER_COLUMNS, PLACE

NOT_NULL = [
    "order_id",
    "order_date",
    "product_id",
    "product_category",
    "price",
    "discount_percent",
    "quantity_sold",
]
# Inclusive lower and upper limits of numeric columns.
DOMAINS = {
    "price": (0, None),
    "discount_percent": (0, 100),
    "rating": (0, 5),
    "review_count": (0, None),
    "discounted_price": (0, None),
    "total_revenue": (0, None),
}
MINIMAL_COLUMNS = NOT_NULL


@dataclass(frozen=True)
class Rule:
    """``breach`` is true for a failing row; null and false both mean the row is fine."""

    name: str
    column: str
    breach: Column


def _domain_rules(column: str, number: Column) -> Iterable[Rule]:
    low, high = DOMAINS[column]
    yield Rule(f"{column}_ge_{low}", column, number < low)
    if high is not None:
        yield Rule(f"{column}_le_{high}", column, number > high)


def parsed(name: str) -> Column:
    """The number a raw column stands for, in a table that went through ``with_parsed``."""
    return F.col(f"_parsed_{name}")


def with_parsed(df: DataFrame) -> DataFrame:
    """Add the parsed numbers as columns, so that several rules share one parse."""
    present = [name for name in NUMBER_COLUMNS if name in df.columns]
    return df.withColumns({f"_parsed_{name}": to_number(df, name) for name in present})


def raw_rules(df: DataFrame, profile: str = "full") -> list[Rule]:
    """Rules for a raw table: nullability, numeric type and value domain per column.

    They apply to ``with_parsed(df)``. The ``minimal`` profile needs seven columns and checks
    the quantity only.
    """
    quantity = Rule("quantity_sold_gt_0", "quantity_sold", parsed("quantity_sold") <= 0)
    if profile == "minimal":
        return [quantity]
    if profile != "full":
        raise ValueError(f"unknown rule profile: {profile}")
    rules = [Rule(f"{name}_not_null", name, F.col(name).isNull()) for name in NOT_NULL]
    if MALFORMED in df.columns:
        rules.insert(0, Rule("row_malformed", MALFORMED, F.col(MALFORMED).isNotNull()))
    for name in NUMBER_COLUMNS:
        number = parsed(name)
        if isinstance(df.schema[name].dataType, T.StringType):
            broken = F.col(name).isNotNull() & number.isNull()
            rules.append(Rule(f"{name}_numeric", name, broken))
        if name in DOMAINS:
            rules.extend(_domain_rules(name, number))
    return [*rules, quantity]


def count_breaches(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row: ``row_count`` and one count per rule."""
    counts = [F.count_if(rule.breach).alias(rule.name) for rule in rules]
    return df.agg(F.count(F.lit(1)).alias("row_count"), *counts)


def schema_violations(df: DataFrame, profile: str = "full") -> DataFrame:
    """Rows ``(rule, column, violations)`` for every rule, also those nothing broke."""
    require_columns(df, MINIMAL_COLUMNS) if profile == "minimal" else require_columns(df)
    rules = raw_rules(df, profile)
    entries = [
        F.struct(
            F.lit(rule.name).alias("rule"),
            F.lit(rule.column).alias("column"),
            F.col(rule.name).alias("violations"),
        )
        for rule in rules
    ]
    return count_breaches(with_parsed(df), rules).select(F.inline(F.array(*entries)))


def violating_rows(df: DataFrame, profile: str = "full") -> DataFrame:
    """One row per broken rule and input row: the order id, the rule and the offending text.

    Where the table says what place a row has (see ``load_raw_sales_data``), so does the result:
    ``source_file``, ``block_start`` and ``position`` name the row also where its order id is null or
    repeated. Of a malformed line the text is the whole line.
    """
    require_columns(df, MINIMAL_COLUMNS) if profile == "minimal" else require_columns(df)
    rules = raw_rules(df, profile)
    found = [
        F.when(
            rule.breach,
            F.struct(
                F.lit(rule.name).alias("rule"),
                F.lit(rule.column).alias("column"),
                F.col(rule.column).cast("string").alias("value"),
            ),
        )
        for rule in rules
    ]
    place = []
    if PLACE in df.columns:
        shown = {"file": "source_file", "block": "block_start", "position": "position"}
        place = [F.col(f"{PLACE}.{name}").alias(label) for name, label in shown.items()]
    return with_parsed(df).select("order_id", *place, F.inline(F.array_compact(F.array(*found))))


def validate_raw_sales_data(df: DataFrame, profile: str = "full") -> DataFrame:
    """Raise with the counts of all broken rules, otherwise hand the table back."""
    broken = schema_violations(df, profile).where("violations > 0").collect()  # one row per rule
    if broken:
        listing = ", ".join(f"{row['rule']}: {row['violations']}" for row in broken)
        raise ValueError(f"Raw data failed the schema check ({listing})")
    return df


def gate_rules(value: Callable[[str], Column] = F.col) -> list[Rule]:
    """Gates of a cleaned table, in the order in which they are reported.

    ``value`` gives the cleaned value of a column, for gates that are counted before the clean
    table is written.
    """
    discount, rating = value("discount_percent"), value("rating")
    return [
        Rule("discount_percent_out_of_range", "discount_percent", ~discount.between(0, 100)),
        Rule("rating_out_of_range", "rating", ~rating.between(0, 5)),
        Rule("quantity_sold_not_positive", "quantity_sold", value("quantity_sold") <= 0),
        Rule("price_negative", "price", value("price") < 0),
    ]


def gate_counts(df: DataFrame) -> DataFrame:
    """One row with the row count and the failing rows per gate."""
    return count_breaches(df, gate_rules())


def raise_on_gate(counts: dict[str, int]) -> None:
    """Raise for the first failed gate in ``counts`` (the single row of ``gate_counts``)."""
    if not counts["row_count"]:
        raise ValueError("Quality gate failed: the clean dataset must not be empty.")
    for rule in gate_rules():
        if counts[rule.name]:
            raise ValueError(
                f"Quality gate failed: {rule.column} breaks {rule.name} "
                f"in {counts[rule.name]} rows."
            )


def enforce_clean_quality_gates(df: DataFrame) -> None:
    raise_on_gate(gate_counts(df).first().asDict())
