"""Writing processed tables, reports, alerts and one-row records."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.contracts import contract_snapshot
from tillroll.schema import CONTRACT_VERSION


def save_processed_data(df: DataFrame, path: str) -> str:
    """Write the clean table as parquet, partitioned by year and month.

    Without a shuffle every task would write a small file into every month. The rebalance
    hint brings each month together and lets Spark split a month that is too large for one
    task and merge small ones. Sorting by date gives each row group a narrow date range.
    """
    dated = df.withColumns({"year": F.year("order_date"), "month": F.month("order_date")})
    (
        dated.hint("rebalance", F.col("year"), F.col("month"))
        .sortWithinPartitions("year", "month", "order_date")
        .write.mode("overwrite")
        .partitionBy("year", "month")
        .parquet(path)
    )
    return path


def save_processed_csv(df: DataFrame, path: str) -> str:
    """Write the clean table as delimited text with a header, for interchange."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path


def save_table(df: DataFrame, path: str, file_format: str = "parquet") -> str:
    """Write a table of any size, in as many files as it has partitions."""
    writer = df.write.mode("overwrite").format(file_format)
    if file_format == "csv":
        writer = writer.option("header", True).option("escape", '"')
    writer.save(path)
    return path


def save_reports(
    tables: Mapping[str, DataFrame], path: str, file_format: str = "parquet"
) -> dict[str, str]:
    """Write each report to ``path/name``.

    Spark merges small partitions by their measured size, so a small report is one file, and one
    that grows with the number of categories is not forced through one task.
    """
    return {name: save_table(table, f"{path}/{name}", file_format) for name, table in tables.items()}


def export_discount_spike_alerts(alerts: DataFrame, path: str, file_format: str = "parquet") -> str:
    return save_table(alerts, path, file_format)


def save_record(record: DataFrame, path: str) -> str:
    """Write a one-row record as a JSON line, null fields included."""
    record.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return path


save_product_metrics = save_record


def export_contract_snapshot(spark, path: str, contract_version: str = CONTRACT_VERSION) -> str:
    return save_record(contract_snapshot(spark, contract_version), path)
