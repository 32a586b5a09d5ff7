"""Reading raw and processed sales tables and stored results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions import blank_missing, to_number
from tillroll.schema import MALFORMED, NUMBER_COLUMNS, PLACE
from tillroll.sources.runs import published_path


#: A whole date, with or without a time: Spark's cast alone would also take "2024".
STORED_MOMENT = r"^\d{4,6}-\d{1,2}-\d{1,2}([T ]\d{1,2}:\d{2}(:\d{2}(\.\d{1,9})?)?Z?)?$"


def _missing_path(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def _text_table(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    """A delimited file, directory or glob with every column as text, named by its header.

    Without type inference only the header of one file is read up front. Reading with that
    header and without ``enforceSchema`` makes Spark compare the header of every other file
    to it, so that files with another column order are refused and not misread. A line with too
    few or too many fields keeps its text in ``MALFORMED``; all fields are parsed for that,
    whatever columns are asked for.
    """
    options = {"header": True, "multiLine": multi_line, "quote": '"', "escape": '"'}
    try:
        header = spark.read.options(**options).csv(path).columns
    except AnalysisException as error:
        if _missing_path(error):
            raise FileNotFoundError(f"Raw sales data not found: {path}") from error
        raise
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*header, MALFORMED]])
    kept = {"columnNameOfCorruptRecord": MALFORMED, "columnPruning": False, "enforceSchema": False}
    return spark.read.options(**options, **kept).schema(schema).csv(path)


def load_raw_sales_data(
    spark: SparkSession, path: str, multi_line: bool = False, with_place: bool = False
) -> DataFrame:
    """The raw table: all columns as text, missing-value tokens as null.

    ``with_place`` adds a column ``PLACE`` that no two rows share: the file, the place in the file
    where its block begins, and a number that rises from row to row of the block.

    Lines with too few or too many fields are marked in column ``MALFORMED``. ``multi_line`` allows
    line breaks inside quotes, but such files cannot be split; without it, the parts of such a line
    are malformed lines.
    """
    table = _text_table(spark, path, multi_line)
    if with_place:
        place = F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("position"),
        )
        table = table.select("*", place.alias(PLACE))
    return blank_missing(table)


def read_clean_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """A processed table kept as delimited text, with the clean types restored."""
    text = load_raw_sales_data(spark, path, multi_line)
    typed = {name: to_number(text, name) for name in NUMBER_COLUMNS if name in text.columns}
    whole = F.when(F.col("order_date").rlike(STORED_MOMENT), F.col("order_date"))
    typed["order_date"] = whole.try_cast("timestamp_ntz")
    broken = F.raise_error(F.concat(F.lit("Malformed line in the processed table: "), F.col(MALFORMED)))
    # Joined to a column that every reader needs, so that the check is not pruned away.
    typed["order_id"] = F.when(F.col(MALFORMED).isNotNull(), broken.cast("double")).otherwise(
        typed.get("order_id", F.col("order_id"))
    )
    return text.withColumns(typed).drop(MALFORMED)


def read_clean_table(spark: SparkSession, path: str) -> DataFrame:
    """The processed table as written by ``save_processed_data``, with year and month.

    ``path`` is the table, or the output of ``run_pipeline``, of which the newest whole run is read.
    """
    try:
        return spark.read.parquet(published_path(spark, path, "processed"))
    except AnalysisException as error:
        if _missing_path(error):
            raise FileNotFoundError(f"Processed sales data not found: {path}") from error
        raise


def read_processed(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    if file_format == "csv":
        return read_clean_csv(spark, path)
    if file_format == "parquet":
        return read_clean_table(spark, path)
    raise ValueError(f"unknown file format: {file_format}")


def read_or_compute(
    spark: SparkSession, path: str, schema: T.StructType, compute: Callable[[], DataFrame]
) -> DataFrame:
    """The stored table if a finished write left one, otherwise the plan that computes it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    files = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(hadoop_path):
        return compute()
    return spark.read.schema(schema).parquet(path)
