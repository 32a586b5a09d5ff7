"""The corpus pipeline: five stages over ``documents``, each stored before the next one reads it.

Stages: documents that score as toxic go; of each group of near-duplicates one stays; documents
that hold a benchmark item go; secrets are blotted out in the texts; what is left is replicated
to target weights of the sources and shuffled. All but the last return the columns of documents.

Every stage takes null and empty texts, which count as texts without words: they are kept by
toxicity, decontamination and secrets, and are one text to near-duplicates. Texts are worked on whole,
however long. Rows with a null doc_id have no label, and stay under the rules for others; rows with
equal ids and different texts are told apart; of equal rows near-duplicates keep one. Other columns,
whatever their names, are carried along (mixing adds ``copy`` and ``mix_key``). An empty table gives
an empty table of the same columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import decontaminate, mixing, near_copies, secrets, toxicity
from tillroll.llm.common import read_table, settle

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without training rows of both classes, and in a text without words, nothing is toxic."""
    return toxicity.reject_toxic(docs, read_table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by SimHash (three bits) or a five-word similarity of 0.8 or more, the row with the smallest doc_id stays."""
    return near_copies.keep_one_of_each(docs, with_simhash=True)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """An empty benchmark, and a text of no words, contaminate nothing and are not contaminated."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """No row goes; a null text stays null."""
    return secrets.redact_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A null source is a source like others; every copy carries the whole row."""
    return mixing.mix(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark),
    ("secret_redaction", redact_secrets),
    ("source_mixing", mix_sources),
]

#: Fingerprints, language models and guess costs are beyond SQL; a test holds the pipeline
#: against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored as Parquet and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
