"""One query per operator, applied to the whole of its table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import decontaminate, fill_in_middle, licenses, mixing, permutation_index, pii, repeats, secrets, simhash
from tillroll.llm import token_counts, toxicity, warc, whitening
from tillroll.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]
#: Cosines are rounded for comparison with SQL, which adds up in another order.
SCORE_PLACES = 9


def op1_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents lie in directories of source and language, as files named by their id."""
    docs = read_table(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", "lang", F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    found = licenses.license_scan(docs, path)
    return found.withColumn("score", F.round("score", SCORE_PLACES))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(read_table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = warc.archive_captures(read_table(spark, sf_dir, "pages"))
    return captures.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    )
    return found.drop("text_hash")


def op6_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return permutation_index.nearest(vectors, F.col("id") % 100 == 0)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents")
    return token_counts.token_counts(docs, public_tokenizers.path("word_bpe_49k.json"))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "text", "source", "copy", "mix_key")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic")
    scored = toxicity.toxicity_scores(docs, labels)
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_spans(read_table(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    made = fill_in_middle.fill_in_middle(docs)
    return made.select(
        "doc_id",
        "infill.n",
        "infill.form",
        "infill.prefix_chars",
        "infill.middle_chars",
        "infill.output_sha256",
        fill_in_middle.restored_digest("infill.output", "infill.form").alias("restored_sha256"),
    )


def op12_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


def llm_queries() -> dict[str, Query]:
    found = [
        op1_simhash_groups,
        op2_license_scan,
        op3_personal_data,
        op4_warc,
        op5_decontamination,
        op6_permutation_index,
        op7_token_counts,
        op8_source_mix,
        op9_toxicity,
        op10_secrets,
        op11_fill_in_middle,
        op12_repeated_passages,
        op13_whitening,
    ]
    return {query.__name__: query for query in found}


def llm_oracles() -> dict[str, str]:
    path = "source || '/' || lang || '/' || doc_id || '.txt'"
    return {
        "op2_license_scan": licenses.scan_sql("documents", path, SCORE_PLACES),
        "op4_warc": warc.records_sql(),
        "op5_decontamination": decontaminate.contaminated_sql(),
        "op8_source_mix": mixing.mix_sql(),
        "op11_fill_in_middle": fill_in_middle.infill_sql(),
    }
