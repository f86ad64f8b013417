"""Writers. Data sinks replace what an earlier run wrote, so a job can be repeated;
logs only append, and their readers take the newest record."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.storagelevel import StorageLevel

from riskengine.operators.projections import target_first
from riskengine.operators.risk import latest_per_key
from riskengine.schemas import TARGET
from riskengine.session import checkpointed

STORE_KEYS = ("transaction_id", "timestamp_ms")


def write_parquet(df: DataFrame, path: str, target: str = TARGET, partition_by: Sequence[str] = ()) -> None:
    target_first(df, target).write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_labeled_csv(df: DataFrame, path: str, target: str = TARGET, single_file: bool = False) -> None:
    """Label-first CSV without header. ``single_file`` sends all rows through one task:
    only for a consumer that cannot read a folder."""
    out = target_first(df, target)
    (out.coalesce(1) if single_file else out).write.mode("overwrite").option("header", False).csv(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def clear_folder(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def clear_days(spark: SparkSession, path: str, days: Iterable[object], day: str = "batch_date") -> None:
    """Remove the folders of these days."""
    for value in days:
        clear_folder(spark, f"{path.rstrip('/')}/{day}={value}")


def drop_old_days(spark: SparkSession, path: str, keep: int, as_of: str | dt.date, day: str = "batch_date") -> list[str]:
    """Delete the folders of days older than the last ``keep`` days up to ``as_of``; returns the days.

    Only folder names are read. Rows without a day are left alone, as are days after ``as_of``.
    """
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)
    names = [entry.getPath().getName() for entry in listed]
    days = [n.removeprefix(f"{day}=") for n in names if n.startswith(f"{day}=") and not n.endswith("__HIVE_DEFAULT_PARTITION__")]
    last_gone = dt.date.fromisoformat(str(as_of)) - dt.timedelta(days=keep)
    old = sorted(d for d in days if dt.date.fromisoformat(d) <= last_gone)
    clear_days(spark, path, old, day)
    return old


def overwrite_days(
    df: DataFrame, path: str, sort: Sequence[str] = (), day: str = "batch_date", days: Iterable[object] = ()
) -> None:
    """Replace the days present in ``df`` and leave the others.

    A day named in ``days`` is replaced even if ``df`` has no row of it, so it ends up
    empty. The rebalance hint gathers a day's rows into few files and splits a day that
    holds most of the rows over several tasks.
    """
    clear_days(df.sparkSession, path, days, day)
    out = df.hint("rebalance", day).sortWithinPartitions(day, *sort)
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def read_store(spark: SparkSession, path: str, like: DataFrame) -> DataFrame | None:
    """The store at ``path`` with the columns of all its files, or None before the first write.

    A store without any row yet has the columns of ``like``.
    """
    if not path_exists(spark, path):
        return None
    try:
        return spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException as failed:
        if failed.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
    return spark.read.schema(like.schema).parquet(path)


def upsert_frame(new: DataFrame, existing: DataFrame, keys: Sequence[str] = STORE_KEYS) -> DataFrame:
    """Last write wins per key: a new row beats a stored one, a later scoring an earlier.

    A column that one side lacks is null in its rows.
    """
    both = existing.withColumn("_write", F.lit(0)).unionByName(new.withColumn("_write", F.lit(1)), allowMissingColumns=True)
    return latest_per_key(both, keys, ["_write", "scoring_ms", "fraud_score"]).drop("_write")


def upsert_scored(new: DataFrame, path: str, keys: Sequence[str] = STORE_KEYS) -> None:
    """Keyed upsert into a store partitioned by day and sorted by score.

    The key has no day in it: the days of ``new`` and those that hold a stored row of one
    of its keys (found by a scan of the key columns) are read and rewritten, the others are
    left alone. The merged rows go to the shared folder first; the replacement itself is not
    atomic, so a store must not be read while a run replaces its days.
    """
    spark = new.sparkSession
    existing = read_store(spark, path, new)
    # Read several times below: kept, so that scoring runs once.
    new = new.persist(StorageLevel.MEMORY_AND_DISK)
    days: list[object] = []
    try:
        if existing is None:
            existing = new.limit(0)
        else:
            held = existing.select(*keys, "batch_date").join(new.select(*keys), list(keys), "left_semi")
            touched = held.select("batch_date").union(new.select("batch_date")).distinct()
            # One value per calendar day reaches the driver; literals prune the store's folders.
            days = [r[0] for r in touched.collect()]
            days = [x for x in days if x is not None]
            existing = existing.filter(F.col("batch_date").isin(days))
        merged = checkpointed(upsert_frame(new, existing, keys))
    finally:
        new.unpersist()
    overwrite_days(merged, path, sort=["fraud_score"], days=days)


def write_daily(df: DataFrame, path: str) -> None:
    overwrite_days(df, path)


def publish_alerts(messages: DataFrame, path: str, days: Iterable[object] = ()) -> None:
    """Alert batches by day; publishing a day again replaces its batches, one in ``days`` also if it has none left."""
    overwrite_days(messages, path, sort=["batch_index"], days=days)


def append_rows(df: DataFrame, path: str, day: str | None = None) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(day) if day else writer).parquet(path)


def log_runs(df: DataFrame, path: str) -> None:
    """Experiment log: one row per run with its parameter and metric maps."""
    append_rows(df, path)


def manifest_row(
    spark: SparkSession,
    execution_id: str,
    stage: str,
    status: str,
    paths: dict[str, str] | None = None,
    counts: dict[str, int] | None = None,
    features: Sequence[str] = (),
    error: str | None = None,
) -> DataFrame:
    """One run record; a failed run must say why."""
    if status not in ("SUCCESS", "FAILED"):
        raise ValueError(f"status must be SUCCESS or FAILED, got {status!r}")
    if status == "FAILED" and not (error and error.strip()):
        raise ValueError("a failed run needs an error text")
    schema = (
        "execution_id string, stage string, status string, paths map<string,string>, "
        "record_counts map<string,bigint>, features array<string>, error string"
    )
    row = (execution_id, stage, status, dict(paths or {}), dict(counts or {}), list(features), error)
    return spark.createDataFrame([row], schema).withColumn("ts", F.current_timestamp())


def write_manifest(row: DataFrame, path: str) -> None:
    append_rows(row, path)


def observed_counts(df: DataFrame, name: str, **counters: Column) -> tuple[DataFrame, Observation]:
    """Counters filled by the write itself, in place of a counting job per split."""
    seen = Observation(name)
    return df.observe(seen, *[c.alias(n) for n, c in counters.items()]), seen
