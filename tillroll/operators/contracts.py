"""Contract of the raw table: required columns and at least one row."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.schema import (
    CONTRACT_DESCRIPTION,
    CONTRACT_VERSION,
    METRICS_REQUIRED_FIELDS,
    RAW_COLUMNS,
)


@dataclass(frozen=True)
class ContractResult:
    errors: list[str] = field(default_factory=list)

    @property
    def is_valid(self) -> bool:
        return not self.errors


def missing_columns(df: DataFrame, required: list[str] = RAW_COLUMNS) -> list[str]:
    """Required columns the table lacks, sorted. Looks at the schema only."""
    return sorted(set(required).difference(df.columns))


def require_columns(df: DataFrame, required: list[str] = RAW_COLUMNS) -> None:
    absent = missing_columns(df, required)
    if absent:
        raise ValueError(f"Required columns are missing: {', '.join(absent)}")


def validate_raw_contract(df: DataFrame) -> ContractResult:
    """Check columns and emptiness; the emptiness probe stops at the first row found."""
    errors = []
    absent = missing_columns(df)
    if absent:
        errors.append(f"Required columns are missing: {', '.join(absent)}")
    if df.isEmpty():
        errors.append("The raw dataset must not be empty.")
    return ContractResult(errors)


def enforce_raw_contract(df: DataFrame) -> None:
    result = validate_raw_contract(df)
    if not result.is_valid:
        raise ValueError(" | ".join(result.errors))


def contract_snapshot(
    spark: SparkSession, contract_version: str = CONTRACT_VERSION
) -> DataFrame:
    """One row describing the contract, to be stored beside the table."""
    return spark.range(1).select(
        F.lit(contract_version).alias("contract_version"),
        F.array(*[F.lit(name) for name in sorted(RAW_COLUMNS)]).alias("required_columns"),
        F.lit(CONTRACT_DESCRIPTION).alias("description"),
    )


def missing_metric_fields(metrics: DataFrame) -> list[str]:
    """Fields a product-metrics record lacks, sorted."""
    return missing_columns(metrics, METRICS_REQUIRED_FIELDS)
