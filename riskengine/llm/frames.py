"""Readers, written tables and Arrow batches shared by the operators.

Every operator takes a DataFrame with an id and a text column, selects just those, and so
is blind to other columns; operators that return whole rows carry them in one struct.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from riskengine.session import work_dir

# Rows of one Arrow batch: long texts must fit a Python worker many times over.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Later passes see the same rows, and a lost executor loses none of them.
    """
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the UTF-8 bytes of the text; null text becomes empty."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """A hash of a row's id and whole text; rows equal in both have one key."""
    return F.xxhash64(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_text`` with the ``row_key`` of each row as ``key``."""
    return id_text(docs, id_col, text_col).withColumn("key", F.xxhash64("doc_id", "text"))


def with_keys(docs: DataFrame, keys: DataFrame, how: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Whole rows whose key is (``left_semi``) or is not (``left_anti``) among ``keys`` (key); columns of any name pass."""
    rows = docs.select(row_key(id_col, text_col).alias("key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return rows.join(keys, "key", how).select("row.*")


def map_batches(
    df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str
) -> DataFrame:
    small_batches(df.sparkSession)
    return df.mapInArrow(fn, schema)


def as_fraction(hash_col: Column) -> Column:
    """A 64-bit hash column as a number in (0, 1)."""
    return (F.shiftrightunsigned(hash_col, 11).cast("double") + 0.5) / F.lit(float(1 << 53))


def held_out(id_col: str, parts: int, part: int) -> Column:
    """True for ids whose crc32 of the decimal text leaves the remainder ``part``; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == part, F.lit(False))
