"""A keyed store of scored rows that can be read while it is written.

A write puts the days it changes, and the keys of those rows, into fresh folders, and
becomes visible by one small record that names the folder of every day. Readers take the
newest record, or an earlier version, and keep it: what they read is never changed under
them. A write that dies leaves folders that no record names; ``clean`` removes them.

    <path>/data/commit=<id>/batch_date=<day>/   rows, sorted by score
    <path>/keys/commit=<id>/part=<part>/        (keys, batch_date) of the stored rows
    <path>/commits/<version>.json               day -> folder, part -> folder, schema

``part`` is computed from the key alone, so a key has one part for good and a batch finds
the days that hold its keys by reading its own parts only. The default part is the UTC day
in the key's time: what a batch reads then follows the days it brings, not the history.
The record has one entry per day and per part. It is put in place by a rename that fails
if the version exists; where the file system has no such rename, allow one writer at a time.
"""

from __future__ import annotations

import dataclasses
import functools
import json
import urllib.parse
import uuid
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from riskengine.operators.risk import latest_per_key
from riskengine.session import checkpointed
from riskengine.sources.sinks import STORE_KEYS

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # fixed value: Spark's folder name of a null
DAY = "batch_date"
PART = "part"


class ConcurrentWrite(RuntimeError):
    """Another write has taken the version; nothing of this one is visible, and it can be repeated."""


@dataclasses.dataclass(frozen=True)
class Snapshot:
    """One version: the folder of each day and of each part, below the store's path."""

    path: str
    version: int = 0
    days: dict[str, str] = dataclasses.field(default_factory=dict)
    parts: dict[str, str] = dataclasses.field(default_factory=dict)
    schema: str | None = None

    def rows(self, spark: SparkSession, days: Iterable[str] | None = None) -> DataFrame | None:
        """The rows, of all days or of those named; None before the first write."""
        if self.schema is None:
            return None
        schema = T.StructType.fromJson(json.loads(self.schema))
        return _read(spark, f"{self.path}/data", self.days, days, schema)

    def keys(self, spark: SparkSession, parts: Iterable[str], keys: Sequence[str]) -> DataFrame:
        """(keys, batch_date) of the rows whose key is of one of these parts."""
        schema = T.StructType.fromJson(json.loads(self.schema))
        fields = [schema[k] for k in (*keys, DAY)]
        listed = _read(spark, f"{self.path}/keys", self.parts, parts, T.StructType([*fields, T.StructField(PART, T.StringType())]))
        return listed.withColumn(PART, named(F.col(PART)))


def _read(spark: SparkSession, base: str, folders: dict[str, str], names: Iterable[str] | None, schema: T.StructType) -> DataFrame:
    named = folders.values() if names is None else [folders[n] for n in names if n in folders]
    paths = [f"{base}/{folder}" for folder in sorted(named)]
    if not paths:
        return spark.createDataFrame([], schema)
    # The record's schema, so that no file is opened for one and a column that a file lacks is null.
    return spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*[F.col(f"`{n}`") for n in schema.names])


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _names(spark: SparkSession, path: str) -> list[str]:
    files, where = _files(spark, path)
    return [entry.getPath().getName() for entry in files.listStatus(where)] if files.exists(where) else []


def versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in _names(spark, f"{path.rstrip('/')}/commits") if n.endswith(".json"))


def snapshot(spark: SparkSession, path: str, version: int | None = None) -> Snapshot:
    """The newest version, or the one asked for; version 0 is the store before its first write."""
    path = path.rstrip("/")
    if version is None:
        version = max(versions(spark, path), default=0)
    if version == 0:
        return Snapshot(path)
    files, where = _files(spark, f"{path}/commits/{version:010d}.json")
    if not files.exists(where):
        raise ValueError(f"{path} has no version {version}")
    stream = files.open(where)
    try:
        record = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Snapshot(path, version, record["days"], record["parts"], record["schema"])


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    return snapshot(spark, path, version).rows(spark)


def _publish(spark: SparkSession, after: Snapshot) -> None:
    record = json.dumps({"days": after.days, "parts": after.parts, "schema": after.schema}, sort_keys=True)
    files, draft = _files(spark, f"{after.path}/commits/.draft-{uuid.uuid4().hex}")
    out = files.create(draft)
    try:
        out.write(bytearray(record.encode()))
    finally:
        out.close()
    final = spark._jvm.org.apache.hadoop.fs.Path(f"{after.path}/commits/{after.version:010d}.json")
    fs = spark._jvm.org.apache.hadoop.fs
    context = fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    # No options: the rename fails if the version is there already.
    options = spark._sc._gateway.new_array(getattr(fs, "Options$Rename"), 0)
    try:
        context.rename(files.makeQualified(draft), files.makeQualified(final), options)
    except Py4JJavaError as failed:
        files.delete(draft, False)
        if failed.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        raise ConcurrentWrite(f"version {after.version} of {after.path} is taken") from failed


def _write(rows: DataFrame, base: str, commit: str, by: str, sort: Sequence[str]) -> dict[str, str]:
    """Write rows by folder; returns folder by value."""
    folder = f"{base}/commit={commit}"
    rows.hint("rebalance", by).sortWithinPartitions(by, *sort).write.partitionBy(by).parquet(folder)
    written = [n for n in _names(rows.sparkSession, folder) if n.startswith(f"{by}=")]
    return {urllib.parse.unquote(n.removeprefix(f"{by}=")): f"commit={commit}/{n}" for n in written}


def named(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(NO_VALUE))


def key_day() -> Column:
    """The UTC day in a key's time, whatever the session's time zone."""
    return F.expr("timestamp_ms div 86400000").cast("string")


def key_bucket(keys: Sequence[str], buckets: int = 256) -> Column:
    """A part for keys without a time in them: every batch reads the parts its keys hash to."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("string")


def _same(left: str, right: str, keys: Sequence[str]) -> Column:
    return functools.reduce(lambda a, b: a & b, [F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`")) for k in keys])


def upsert(new: DataFrame, path: str, keys: Sequence[str] = STORE_KEYS, part: Column | None = None) -> int:
    """Last write wins per key; returns the version that shows it.

    Of rows of ``new`` with one key the latest scoring counts, then the higher score, then a
    hash of the row. Null keys are keys and a null day is a day. A column that one side lacks
    is null in its rows. An empty ``new`` gives a version with the same rows. Days that
    hold no key of ``new`` and get no row are neither read nor written.
    """
    spark = new.sparkSession
    before = snapshot(spark, path)
    part = key_day() if part is None else part
    order = [c for c in ("scoring_ms", "fraud_score") if c in new.columns]
    tied = new.withColumn("_tie", F.xxhash64(*[F.col(f"`{c}`") for c in sorted(new.columns)]))
    # In reliable storage: rows and keys below are written from the same winners, also after a lost executor.
    winners = checkpointed(latest_per_key(tied, keys, [*order, "_tie"]).drop("_tie"))
    # One value per day and per part reaches the driver.
    found = winners.agg(F.collect_set(named(F.col(DAY))).alias("days"), F.collect_set(named(part)).alias("parts")).first()
    days, parts = set(found.days), set(found.parts)
    commit = f"{before.version + 1:010d}-{uuid.uuid4().hex[:8]}"

    schema = winners.schema
    rows, index = winners, winners.select(*keys, DAY, named(part).alias(PART))
    if before.schema is not None:
        mine = winners.select(*keys).alias("new")
        held = before.keys(spark, parts, keys).alias("old")
        gone = held.join(mine, _same("old", "new", keys), "left_semi")
        days |= {r[0] for r in gone.select(named(F.col(DAY))).distinct().collect()}
        index = held.join(mine, _same("old", "new", keys), "left_anti").unionByName(index)
        old = before.rows(spark, days).alias("old")
        rows = old.join(mine, _same("old", "new", keys), "left_anti").unionByName(winners, allowMissingColumns=True)
        schema = rows.schema

    sort = [c for c in ("fraud_score",) if c in schema.names]
    with ThreadPoolExecutor(2) as pool:  # neither needs the other
        write = inheritable_thread_target(spark)(_write)
        data = pool.submit(write, rows, f"{before.path}/data", commit, DAY, sort)
        listed = pool.submit(write, index, f"{before.path}/keys", commit, PART, [])
    written, indexed = data.result(), listed.result()
    after = Snapshot(
        before.path,
        before.version + 1,
        {**{d: f for d, f in before.days.items() if d not in days}, **written},
        {**{p: f for p, f in before.parts.items() if p not in parts}, **indexed},
        T.StructType([T.StructField(f.name, f.dataType) for f in schema]).json(),
    )
    _publish(spark, after)
    return after.version


def drop_days(spark: SparkSession, path: str, days: Iterable[object]) -> int:
    """A version without these days; their rows go from disk with the versions that name them."""
    before = snapshot(spark, path)
    gone = {str(d) for d in days}
    kept = {d: f for d, f in before.days.items() if d not in gone}
    # Their keys stay listed: a day that the record does not name has no rows.
    _publish(spark, dataclasses.replace(before, version=before.version + 1, days=kept))
    return before.version + 1


def clean(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Forget all but the newest ``keep`` versions and remove what only they, or dead writes, hold.

    Readers of a forgotten version fail from then on. Folders of a write under way have a
    version still to come and are left alone. Returns the forgotten versions.
    """
    path = path.rstrip("/")
    if keep < 1:
        raise ValueError("the newest version is always kept")
    known = versions(spark, path)
    kept, gone = known[-keep:], known[:-keep]
    shown = [snapshot(spark, path, v) for v in kept]
    used = {
        "data": {f for s in shown for f in s.days.values()},
        "keys": {f for s in shown for f in s.parts.values()},
    }
    for version in gone:
        files, where = _files(spark, f"{path}/commits/{version:010d}.json")
        files.delete(where, False)
    for kind, folders in used.items():
        commits = {f.split("/")[0] for f in folders}
        for name in _names(spark, f"{path}/{kind}"):
            if not name.startswith("commit=") or int(name[7:17]) > kept[-1]:
                continue
            inside = [f"{name}/{n}" for n in _names(spark, f"{path}/{kind}/{name}") if "=" in n] if name in commits else [name]
            for folder in inside:
                if folder not in folders:
                    files, where = _files(spark, f"{path}/{kind}/{folder}")
                    files.delete(where, True)
    return gone
