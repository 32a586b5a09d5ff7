"""What several operators share: reading tables and stored intermediate tables."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.sources.scratch import shared_folder


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The folder for stored intermediate tables, shared by driver and executors; see ``shared_folder``."""
    return f"{shared_folder(spark)}/tables"


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """Store the table and go on from the stored copy.

    This cuts lineage, survives lost executors, and gives the reader its true size, so that
    Spark's own choice between broadcast and shuffle rests on a checked figure.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of texts that go to a Python worker at once, at most.
TEXT_ROWS = 1000
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Have the session hand on texts, which are long rows, in small batches.

    Executor and worker each hold whole batches; at the default of 10,000 rows these are many
    megabytes a task. A smaller setting is left as it is.
    """
    if not 0 < int(spark.conf.get(_BATCH_ROWS)) <= TEXT_ROWS:
        spark.conf.set(_BATCH_ROWS, str(TEXT_ROWS))


def packed(df: DataFrame, *keys: str) -> DataFrame:
    """The rows of ``df`` as one column ``row``, beside copies of the columns ``keys``.

    Columns that an operator adds meanwhile cannot clash with columns of ``df``; ``select("row.*")``
    gives them back.
    """
    whole = F.struct(*[df[f"`{name}`"] for name in df.columns])
    return df.select(*[F.col(key) for key in keys], whole.alias("row"))


#: Bits of a key filter: its size is fixed, whatever the number of keys.
FILTER_BITS = 1 << 25


def key_filter(keys: DataFrame) -> np.ndarray:
    """A bitmap of the hashed keys in column ``key``, for a first look before an exact join.

    At most ``FILTER_BITS / 64`` numbers reach the driver. With many more keys than bits, the filter
    lets everything through and only saves less.
    """
    place = F.col("key").bitwiseAND(F.lit(FILTER_BITS - 1))
    words = (
        keys.select(
            F.shiftright(place, 6).alias("word"), F.expr("shiftleft(1L, cast(key & 63 AS int))").alias("bit")
        )
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()  # as two flat columns: rows of Python objects would be many times as large
    )
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out


def let_through(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each hashed key may be one of those behind the bitmap."""
    place = keys & (FILTER_BITS - 1)
    return (bits[place >> 6] >> (place & 63) & 1).astype(bool)
