"""Training-data preparation: check, split, write, record."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from riskengine.operators.quality import EXPECTED_ROWS, quality_gate
from riskengine.operators.splits import DEFAULT_WEIGHTS, split_bernoulli, split_exact
from riskengine.schemas import TARGET
from riskengine.sources.readers import read_split
from riskengine.sources.sinks import manifest_row, observed_counts, write_labeled_csv, write_manifest, write_parquet

STAGE = "DataPrepStage"


def prepare(
    df: DataFrame,
    key: str,
    out: str,
    weights: Mapping[str, float] = DEFAULT_WEIGHTS,
    seed: int = 42,
    exact: bool = False,
    expected_rows: int = EXPECTED_ROWS,
    execution_id: str | None = None,
    checked: bool = True,
) -> DataFrame:
    """Write all splits in one pass (Parquet, partitioned by split) and the test split
    also as label-first CSV; append the manifest and return it.

    Row counts per split are observed by the write. A failure is recorded, then raised.
    """
    spark = df.sparkSession
    out = out.rstrip("/")
    execution_id = execution_id or uuid.uuid4().hex
    paths = {"data": f"{out}/splits", "test_csv": f"{out}/test.csv", "manifest": f"{out}/manifests"}
    try:
        if checked:
            quality_gate(df, expected_rows)
        parts = (split_exact if exact else split_bernoulli)(df, key, weights, seed)
        counters = {name: F.count_if(F.col("split") == name) for name in weights}
        watched, seen = observed_counts(parts, f"prepare-{execution_id}", **counters)
        write_parquet(watched, paths["data"], partition_by=["split"])
        write_labeled_csv(read_split(spark, paths["data"], list(weights)[-1]).drop(key), paths["test_csv"])
        features = [c for c in df.columns if c not in (TARGET, key)]
        row = manifest_row(spark, execution_id, STAGE, "SUCCESS", paths, seen.get, features)
    except Exception as failed:
        write_manifest(
            manifest_row(spark, execution_id, STAGE, "FAILED", error=f"{type(failed).__name__}: {failed}"),
            paths["manifest"],
        )
        raise
    write_manifest(row, paths["manifest"])
    return spark.read.parquet(paths["manifest"]).filter(F.col("execution_id") == execution_id)
