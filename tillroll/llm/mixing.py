"""Mixing sources to target weights by Poisson replication.

A document of a source gets a number of copies drawn from a Poisson distribution whose mean is
the source's target repetition: target share of the mix over the source's own share. The draw
inverts the distribution at a number hashed from seed and document, so it needs no state and
comes out the same in every run and after every lost task. All copies are then shuffled together:
dealt out by a hash and put in the order of that hash.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import packed, settle

SEED = 42
#: Weights follow the source's size to this power where none are given: small sources gain.
TEMPERATURE = 0.7
#: Total of expected copies over the documents there are.
EPOCHS = 1.0
#: Means above this are drawn as a sum of equal parts, so that exp(-mean) stays in range.
PART_MEAN = 16.0
#: Copies one part can have: beyond this the distribution leaves less than 2**-53, the
#: step of the hashed numbers.
PART_COPIES = 80


def source_rates(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    temperature: float = TEMPERATURE,
    epochs: float = EPOCHS,
) -> DataFrame:
    """``rate_source, rate``: mean number of copies of a document, per source.

    ``weights`` names target weights by source (any scale; sources left out get none). Without
    it, a source of n documents weighs ``n ** temperature``. A null source is a source of its own.
    """
    sizes = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        weight = F.pow(F.col("n").cast("double"), F.lit(temperature))
    else:
        if any(not value >= 0 for value in weights.values()):
            raise ValueError("Weights must not be negative.")
        pairs = [F.lit(x) for item in weights.items() for x in (item[0], float(item[1]))]
        given = F.create_map(*pairs) if pairs else F.lit(None).cast("map<string,double>")
        weight = F.coalesce(F.try_element_at(given, F.col("source")), F.lit(0.0))
    weighed = sizes.withColumn("weight", weight)
    total = weighed.agg(F.sum("n").alias("all_docs"), F.sum("weight").alias("all_weight"))
    share = F.try_divide(F.col("weight"), F.col("all_weight"))
    rate = F.lit(epochs) * F.col("all_docs") * share / F.col("n")
    return weighed.crossJoin(total).select(
        F.col("source").alias("rate_source"), F.coalesce(rate, F.lit(0.0)).alias("rate")
    )


def unit_number(*parts: F.Column) -> F.Column:
    """A number in (0, 1) from 52 bits of an MD5 digest over the parts."""
    digest = F.substring(F.md5(F.concat_ws(":", *[p.cast("string") for p in parts])), 1, 13)
    return (F.conv(digest, 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def _steps(rate: F.Column) -> F.Column:
    """Upper bounds P(X <= 0), P(X <= 1), ... of one part with mean ``rate / parts``."""
    mean = rate / F.greatest(F.ceil(rate / PART_MEAN), F.lit(1))
    first = F.exp(-mean)
    start = F.struct(first.alias("p"), first.alias("total"), F.array(first).alias("bounds"))

    def add(state: F.Column, k: F.Column) -> F.Column:
        p = state["p"] * mean / k
        total = state["total"] + p
        return F.struct(
            p.alias("p"), total.alias("total"), F.concat(state["bounds"], F.array(total)).alias("bounds")
        )

    counts = F.transform(F.sequence(F.lit(1), F.lit(PART_COPIES)), lambda k: k.cast("double"))
    return F.aggregate(counts, start, add)["bounds"]


def replicate(docs: DataFrame, rates: DataFrame, seed: int = SEED) -> DataFrame:
    """Each row of ``docs`` (packed in ``row``) as often as its draw says, with ``copy`` and ``mix_key``.

    Copies count from 1. Equal ids have equal draws; rows without an id are drawn by their text.
    Rows of a source that ``rates`` lacks have no copies.
    """
    stored = settle(
        rates.select(
            "rate_source",
            F.greatest(F.ceil(F.col("rate") / PART_MEAN), F.lit(1)).cast("int").alias("rate_parts"),
            _steps(F.col("rate")).alias("rate_steps"),
        ),
        "source-rates",
    )
    by_text = F.concat(F.lit("text:"), F.coalesce("text", F.lit("")))
    name = F.coalesce(F.col("doc_id").cast("string"), by_text)
    rows = packed(docs, "source", "doc_id", "text").select("source", name.alias("name"), "row")
    joined = rows.join(stored, rows["source"].eqNullSafe(stored["rate_source"]))

    def drawn(part: F.Column) -> F.Column:
        u = unit_number(F.lit(seed), F.col("name"), part)
        return F.size(F.filter(F.col("rate_steps"), lambda bound: bound < u))

    parts = F.sequence(F.lit(1), F.col("rate_parts"))
    copies = F.aggregate(parts, F.lit(0), lambda total, part: total + drawn(part))
    drawn_copies = F.slice(F.sequence(F.lit(0), copies), 2, F.greatest(copies, F.lit(1)))
    spread = joined.select("row", "name", F.explode(drawn_copies).alias("copy"))
    place = unit_number(F.lit(seed), F.lit("order"), F.col("name"), F.col("copy"))
    return spread.select("row", "copy", place.alias("mix_key"))


def mix(
    docs: DataFrame, weights: Mapping[str, float] | None = None, seed: int = SEED
) -> DataFrame:
    """``docs`` replicated to the target weights and shuffled over all partitions.

    Returns the columns of ``docs``, then ``copy`` (from 1) and ``mix_key`` (the place in the mix;
    columns of ``docs`` with these names give way). Empty tables give no rows; empty and null texts
    count like others.
    """
    spread = replicate(docs, source_rates(docs, weights), seed)
    shuffled = spread.repartition("mix_key").sortWithinPartitions("mix_key")
    names = [name for name in docs.columns if name not in ("copy", "mix_key")]
    return shuffled.select(*[F.col("row")[name].alias(name) for name in names], "copy", "mix_key")


def mix_sql(table: str = "documents") -> str:
    """The rows of ``mix`` with default weights, for DuckDB."""
    return f"""
WITH RECURSIVE sizes AS (SELECT source, count(*) AS n FROM {table} GROUP BY source),
weighed AS (SELECT source, n, pow(n::DOUBLE, {TEMPERATURE}) AS weight FROM sizes),
rates AS (
  SELECT source, {EPOCHS} * sum(n) OVER () * (weight / sum(weight) OVER ()) / n AS rate FROM weighed
),
means AS (
  SELECT source, greatest(ceil(rate / {PART_MEAN}), 1)::INT AS parts,
         rate / greatest(ceil(rate / {PART_MEAN}), 1) AS mean
  FROM rates
),
steps(source, mean, k, p, bound) AS (
  SELECT source, mean, 0, exp(-mean), exp(-mean) FROM means
  UNION ALL
  SELECT source, mean, k + 1, p * mean / (k + 1)::DOUBLE, bound + p * mean / (k + 1)::DOUBLE
  FROM steps WHERE k < {PART_COPIES}
),
bounds AS (SELECT source, list(bound ORDER BY k) AS bounds FROM steps GROUP BY source),
parts AS (
  SELECT d.doc_id, b.bounds,
         unnest(range(1, m.parts + 1)) AS part
  FROM {table} d JOIN means m ON d.source IS NOT DISTINCT FROM m.source
  JOIN bounds b ON d.source IS NOT DISTINCT FROM b.source
),
drawn AS (
  SELECT doc_id, sum(len(list_filter(bounds, lambda b: b <
    (('0x' || substr(md5('{SEED}:' || doc_id || ':' || part), 1, 13))::BIGINT + 0.5::DOUBLE) / {float(1 << 52)}
  ))) AS copies
  FROM parts GROUP BY doc_id
)
SELECT d.doc_id, d.text, d.source, c.copy::INT AS copy,
  (('0x' || substr(md5('{SEED}:order:' || d.doc_id || ':' || c.copy), 1, 13))::BIGINT + 0.5::DOUBLE) / {float(1 << 52)} AS mix_key
FROM {table} d JOIN (SELECT doc_id, unnest(range(1, copies::BIGINT + 1)) AS copy FROM drawn) c USING (doc_id)
"""
