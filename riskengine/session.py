"""Session settings and the shared folders used by checkpoints and written tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Wide tables generate methods the JIT will not compile (over 8000 bytes); past that
    # size Spark should use its split-up code instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Settings the registered queries rely on in any session.
QUERY_CONF = ("spark.sql.session.timeZone", "spark.sql.codegen.hugeMethodLimit")


def prepare_session(spark: SparkSession) -> SparkSession:
    """Give a session from elsewhere the settings results and speed depend on."""
    for name in QUERY_CONF:
        spark.conf.set(name, DEFAULTS[name])
    if _is_local(spark):  # workers started elsewhere than in this folder must find the package
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        spark.sparkContext.environment.setdefault("PYTHONPATH", root)
    return spark


def local_session(cores: int | str = 8, app: str = "riskengine", **conf: str) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        **DEFAULTS,
        "spark.sql.shuffle.partitions": str(cores),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
        "spark.driver.host": "127.0.0.1",
        "spark.driver.bindAddress": "127.0.0.1",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster such a
    folder would vanish with the machine that wrote it.
    """
    named = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not _is_local(spark):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="riskengine-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder, one per call."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def use_checkpoints(spark: SparkSession) -> None:
    """Name the shared folder to the context, also for fits that cut their lineage every few rounds."""
    folder = shared_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)


def checkpointed(df):
    """Cut lineage through reliable storage, so later passes see the same partitions."""
    use_checkpoints(df.sparkSession)
    return df.checkpoint(eager=True)


def parallelism(spark: SparkSession) -> int:
    """Partitions of a full shuffle: the session's setting, at least one per core."""
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
