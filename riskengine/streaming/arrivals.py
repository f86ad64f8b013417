"""Batch files as they arrive: scoring into the store, daily totals, dropped re-deliveries.

Each job reads a folder of Parquet files as a bounded stream and stops when it has read
them all. Progress lives under ``checkpoint``, which must be a shared folder. There is no
watermark: rows of any age count.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from riskengine.functions import scalars as X
from riskengine.operators.projections import banded
from riskengine.operators.quality import accepted, rejected
from riskengine.operators.risk import risk_summary
from riskengine.session import checkpointed
from riskengine.sources.sinks import clear_folder, overwrite_days, path_exists, upsert_scored
from riskengine.sources.versions import NO_VALUE, PART, named


def arriving(spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """New files of a folder; all that wait come in one batch unless ``files_per_batch`` says otherwise."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def _run(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    query = (
        stream.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    query.awaitTermination()


def stream_score(
    stream: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    store: str,
    checkpoint: str,
    quarantine: str | None = None,
    upsert: Callable[[DataFrame, str], object] = upsert_scored,
) -> None:
    """Score and band every arriving row into the keyed store; rows without a valid score are set aside.

    ``upsert`` writes a batch: into a plain folder, or with ``versions.upsert`` into a store
    that can be read meanwhile and whose cost per batch does not follow its history.

    A batch that runs twice upserts the same keys with the same rows, and replaces its own
    part of the quarantine, so both end as if it had run once.
    """
    aside = quarantine or f"{store.rstrip('/')}-quarantine"

    def write(batch: DataFrame, number: int) -> None:
        scored = score(batch).persist()
        try:
            rejected(scored, "fraud_score").write.mode("overwrite").parquet(f"{aside}/batch={number}")
            upsert(banded(accepted(scored, "fraud_score")), store)
        finally:
            scored.unpersist()

    _run(stream, write, checkpoint)


MERGED = 8  # partial totals that become one of the next level


def spans(batches: int, base: int = MERGED) -> list[tuple[int, int]]:
    """(level, number) of the fewest partial totals that cover the first ``batches`` batches.

    Number ``i`` of level ``l`` covers the batches from ``i * base**l`` on, ``base**l`` of
    them. The answer follows the digits of ``batches``: at most ``base - 1`` per level.
    """
    found, level = [], 0
    while batches:
        batches, rest = divmod(batches, base)
        found += [(level, batches * base + i) for i in range(rest)]
        level += 1
    return found


def _part(parts: str, level: int, number: int) -> str:
    return f"{parts}/level={level}/number={number}"


def _totalled(rows: DataFrame) -> DataFrame:
    sums = ("total", "high", "medium", "low", "valid", "score_sum")
    return rows.groupBy("batch_date").agg(*[F.sum(c).alias(c) for c in sums])


def daily_parts(spark: SparkSession, parts: str, batches: int) -> DataFrame | None:
    """Partial totals of the first ``batches`` batches; one that had no batch behind it is skipped."""
    folders = [_part(parts, *span) for span in spans(batches)]
    found = [f for f in folders if path_exists(spark, f)]
    return spark.read.parquet(*found) if found else None


def _merge_parts(spark: SparkSession, parts: str, batches: int) -> None:
    """After ``batches`` batches: each level that has just become full is written as one of the next.

    What the merges of the batch before replaced goes here, one batch late: until then that
    batch may run again and need them.
    """
    level, count = 0, batches
    while count and count % MERGED == 0:
        folders = [_part(parts, level, count - 1 - i) for i in range(MERGED)]
        found = [f for f in folders if path_exists(spark, f)]
        count //= MERGED
        if found:
            _totalled(spark.read.parquet(*found)).write.mode("overwrite").parquet(_part(parts, level + 1, count - 1))
        level += 1
    level, count = 0, batches - 1
    while count > 0 and count % MERGED == 0:
        for i in range(MERGED):
            clear_folder(spark, _part(parts, level, count - 1 - i))
        count //= MERGED
        level += 1


def stream_daily(stream: DataFrame, out: str, checkpoint: str, ts: str = "event_ts") -> None:
    """Daily risk totals over calendar days, each changed day rewritten when it changes.

    No row is too late: a batch leaves its partial totals, one row per day, in a folder of
    its own (replaced if the batch runs again), and the days it touches are summed anew.
    Every ``MERGED`` partial totals become one of the next level, so a batch reads a number of
    folders that is logarithmic in the batches before it. Batch numbers are those of
    ``checkpoint``: an ``out`` belongs to one checkpoint.
    """
    parts = f"{out.rstrip('/')}-parts"

    def write(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn("batch_date", F.to_date(ts))
        valid = rows.groupBy("batch_date").agg(
            F.count(X.number("fraud_score")).alias("valid"),
            F.coalesce(F.sum(X.number("fraud_score")), F.lit(0.0)).alias("score_sum"),
        )
        partial = risk_summary(rows).drop("avg_score").join(valid, "batch_date")
        own = _part(parts, 0, number)
        partial.write.mode("overwrite").parquet(own)
        spark = batch.sparkSession
        touched = spark.read.parquet(own).select("batch_date").distinct()
        _merge_parts(spark, parts, number + 1)
        every = _totalled(daily_parts(spark, parts, number + 1).join(touched, "batch_date", "left_semi")).select(
            "batch_date", "total", "high", "medium", "low",
            F.coalesce(F.try_divide("score_sum", "valid"), F.lit(0.0)).alias("avg_score"),
        )
        overwrite_days(every, out)

    _run(stream, write, checkpoint)


def stream_dedup(stream: DataFrame, keys: list[str], out: str, checkpoint: str, part: Column | None = None) -> None:
    """Keep one delivery of each key, however long after the first another one comes.

    The written rows are the memory: a batch is made unique and joined against their keys
    (a scan of the key columns only), so there is no state to grow or expire, and a batch
    that runs twice adds nothing. With ``part``, a column computed from the keys alone (their
    day, or a bucket of their hash), the rows are written in a folder per part and a batch
    scans the parts of its own keys only; null is a part.
    """

    def write(batch: DataFrame, _: int) -> None:
        fresh = batch.dropDuplicates(keys)
        spark = batch.sparkSession
        if part is None:
            known, writer = batch.schema, lambda rows: rows.write
        else:
            # Read for its parts, joined and written: made once.
            fresh = checkpointed(fresh.withColumn(PART, named(part)))
            known, writer = fresh.schema, lambda rows: rows.hint("rebalance", PART).write.partitionBy(PART)
        if path_exists(spark, out):
            kept = held_keys(spark.read.schema(known).parquet(out), keys, None if part is None else fresh)
            same = [F.col(k).eqNullSafe(F.col(f"_kept_{k}")) for k in keys]
            fresh = fresh.join(kept, functools.reduce(lambda a, b: a & b, same), "left_anti")
        writer(fresh).mode("append").parquet(out)

    _run(stream, write, checkpoint)


def held_keys(written: DataFrame, keys: list[str], batch: DataFrame | None = None) -> DataFrame:
    """Keys of the written rows, of the parts of ``batch`` only if it is given (one value per part reaches the driver)."""
    if batch is not None:
        parts = [r[0] for r in batch.select(PART).distinct().collect()]
        literal = [p for p in parts if p != NO_VALUE]
        wanted = F.col(PART).isin(literal)
        written = written.filter(wanted | F.col(PART).isNull() if len(literal) < len(parts) else wanted)
    return written.select([F.col(k).alias(f"_kept_{k}") for k in keys])
