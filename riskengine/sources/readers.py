"""Typed readers. Every one takes an explicit schema; none scans to infer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from riskengine import schemas
from riskengine.functions.scalars import tolerant_double, tolerant_label

CORRUPT = "_corrupt_record"


def read_table_csv(spark: SparkSession, path: str, schema: T.StructType = schemas.CARDS) -> DataFrame:
    """Headered CSV; a value that does not fit its type fails the read."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def read_labeled_csv(
    spark: SparkSession, path: str, features: Sequence[str] = schemas.CARD_FEATURES
) -> DataFrame:
    """Headerless, label-first CSV read tolerantly from a file or a folder of part files.

    A bad label becomes 0 and a bad feature 0.0; blank lines and lines with fewer than
    two fields are dropped; a short line leaves its last features null. A failed read raises.
    """
    parts = F.col("parts")
    fields = [
        F.when(F.size(parts) > i + 1, tolerant_double(F.get(parts, F.lit(i + 1)))).alias(name)
        for i, name in enumerate(features)
    ]
    lines = spark.read.text(path).filter(F.trim("value") != "")
    return (
        lines.select(F.split("value", ",").alias("parts"))
        .filter(F.size("parts") >= 2)
        .select(tolerant_label(F.get(parts, F.lit(0))).alias("label"), *fields)
    )


def read_split(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One split of a folder written by split: partition pruning reads only its files."""
    return spark.read.parquet(folder).filter(F.col("split") == name).drop("split")


def read_tx_batch(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """JSON-array batch, with text that is not a transaction kept in ``_corrupt_record``.

    ``multiline`` reads a pretty-printed array per file, which one task must parse whole;
    without it each line holds an array or an object and files are split between tasks.
    """
    schema = T.StructType([*schemas.TRANSACTION.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(schema)
        .option("multiLine", multiline)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def good_rows(batch: DataFrame) -> DataFrame:
    return batch.filter(F.col(CORRUPT).isNull() & F.col("id").isNotNull()).drop(CORRUPT)


def bad_rows(batch: DataFrame) -> DataFrame:
    return batch.filter(F.col(CORRUPT).isNotNull() | F.col("id").isNull())


def read_daily(spark: SparkSession, folder: str, start: str, end: str) -> DataFrame:
    """Daily metrics of a date range; days without a file are simply absent."""
    day = F.col("batch_date")
    return (
        spark.read.schema(schemas.DAILY_METRICS)
        .parquet(folder)
        .filter(day.between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    )
