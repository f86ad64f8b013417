"""Training job over prepared splits: fit, evaluate, gate, probe, publish; and scoring
with the published model."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskengine.operators.boosting import BoostedTrees
from riskengine.operators.evaluation import PRODUCTION_ACCURACY, evaluate
from riskengine.operators.registry import latest_manifest
from riskengine.operators.training import assemble, positive_probability, probe, score_rows, train_gbt
from riskengine.plans.prepare import prepare
from riskengine.schemas import TARGET
from riskengine.session import checkpointed
from riskengine.sources.readers import read_split
from riskengine.sources.sinks import manifest_row, write_manifest

STAGE = "DeployStage"


def train_and_publish(
    spark: SparkSession,
    splits: str,
    out: str,
    features: Sequence[str],
    key: str,
    params: Mapping[str, object] | None = None,
    min_accuracy: float = PRODUCTION_ACCURACY,
) -> DataFrame:
    """Fit on train, report on test, publish when the gate and the probe pass.

    The model is saved under a new name each time and becomes current by its manifest.
    A refused model is recorded as a failure and raised.
    """
    out, run = out.rstrip("/"), uuid.uuid4().hex
    path, manifests = f"{out}/models/{run}", f"{out}/manifests"
    try:
        model = train_gbt(assemble(read_split(spark, splits, "train"), features, TARGET), params)
        test = assemble(read_split(spark, splits, "test"), features, TARGET, keep=[key])
        scored = checkpointed(
            positive_probability(model, test).select(F.col(key).alias("id"), F.col("label").cast("int").alias("label"), "score")
        )
        report = evaluate(scored, warn=True)
        row = report.first()
        if row["accuracy"] is None or row["accuracy"] < min_accuracy:
            raise ValueError(f"accuracy {row['accuracy']} is below {min_accuracy}")
        if not probe(model, test).first()["healthy"]:
            raise ValueError("the model scored outside [0, 1]")
        model.save(spark, path)
    except Exception as failed:
        write_manifest(manifest_row(spark, run, STAGE, "FAILED", error=f"{type(failed).__name__}: {failed}"), manifests)
        raise
    counts = {c: row[c] for c in ("tp", "fp", "tn", "fn")}
    write_manifest(manifest_row(spark, run, STAGE, "SUCCESS", {"model": path}, counts, features), manifests)
    return report


def current_model(spark: SparkSession, out: str) -> tuple[BoostedTrees, list[str]]:
    """Newest published model and its feature order; raises when none was published."""
    done = spark.read.parquet(f"{out.rstrip('/')}/manifests").filter("status = 'SUCCESS'")
    row = latest_manifest(done, STAGE, tie="execution_id").first()
    if row is None:
        raise ValueError(f"no published model under {out}")
    return BoostedTrees.load(spark, row["paths"]["model"]), list(row["features"])


def score_with_current(df: DataFrame, out: str, scoring_ms: Column) -> DataFrame:
    model, features = current_model(df.sparkSession, out)
    return score_rows(df, model, features, scoring_ms)


def published_model(
    df: DataFrame, key: str, out: str, features: Sequence[str], min_accuracy: float = PRODUCTION_ACCURACY
) -> tuple[BoostedTrees, list[str]]:
    """The registry's current model; an empty registry is filled first: prepare ``df`` with its checks, train, publish."""
    spark = df.sparkSession
    try:
        return current_model(spark, out)
    except (AnalysisException, ValueError):  # no manifest yet, or none of a published model
        prepare(df, key, out)
        train_and_publish(spark, f"{out.rstrip('/')}/splits", out, features, key, min_accuracy=min_accuracy)
    return current_model(spark, out)
