"""Experiment runs, parameter and config history, stage manifests."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskengine.functions import scalars as X


# Run fields kept beside the hyperparameters in the parameter map.
RESERVED_PARAMS = ("experiment_id", "algorithm", "start_timestamp", "user", "dataset_version", "code_version")
RUN_LIMIT = 100


def latest_manifest(df: DataFrame, stage: str | None = None, ts: str = "ts", tie: str = "event_id") -> DataFrame:
    """Newest manifest of each stage (or of one).

    One aggregation: each task sends its newest row per stage, nothing else is shuffled.
    """
    rest = [c for c in df.columns if c != "stage"]
    rows = df if stage is None else df.filter(F.col("stage") == stage)
    last = rows.filter(F.col(ts).isNotNull()).groupBy("stage")
    return last.agg(F.max_by(F.struct(*rest), F.struct(ts, tie)).alias("_row")).select("stage", *[f"_row.{c}" for c in rest])


def query_runs(
    df: DataFrame,
    experiment_name: str | None = None,
    start: str | None = None,
    end: str | None = None,
    min_accuracy: float | None = None,
    params: Mapping[str, object] | None = None,
    limit: int = RUN_LIMIT,
) -> DataFrame:
    """Matching runs, newest first, with the reserved names taken out of the parameters."""
    tests: list[Column] = []
    if experiment_name is not None:
        tests.append(F.col("experiment_name") == experiment_name)
    if start is not None:
        tests.append(F.col("created") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        tests.append(F.col("created") <= F.lit(end).cast("timestamp_ntz"))
    if min_accuracy is not None:
        tests.append(F.try_element_at("metrics", F.lit("accuracy")) >= min_accuracy)
    for name, value in (params or {}).items():
        tests.append(F.try_element_at("params", F.lit(name)) == str(value))
    rows = functools.reduce(lambda d, t: d.filter(t), tests, df)
    newest = rows.orderBy(F.desc("created"), F.desc("run_id")).limit(limit)
    return newest.withColumn("hyperparameters", F.map_filter("params", lambda k, _: ~k.isin(*RESERVED_PARAMS)))


def as_of(hist: DataFrame, key: str, value: str, version: int | Column) -> DataFrame:
    """Value of each key at a version: the newest entry not after it."""
    known = hist.filter(F.col("version") <= version).select(key, value, "version")
    newest = known.filter(F.col("version").isNotNull()).groupBy(key).agg(F.max(F.struct("version", value)).alias("_new"))
    return newest.select(key, "_new.version", f"_new.{value}")


def params_as_of(hist: DataFrame, version: int | Column) -> DataFrame:
    return as_of(hist, "path", "value", version)


def current_params(hist: DataFrame) -> dict[str, str]:
    """Newest value of each parameter, for an estimator: a handful of names, no row data."""
    newest = as_of(hist, "path", "value", F.lit(2**63 - 1))
    return {r["path"]: r["value"] for r in newest.filter(F.col("value").isNotNull()).collect()}


def param_rows(runs: DataFrame) -> DataFrame:
    """History rows that make each run's hyperparameters current, versioned by the run."""
    return runs.select(
        F.explode(F.map_filter("params", lambda k, _: ~k.isin(*RESERVED_PARAMS))).alias("path", "value"),
        F.col("run_id").alias("version"),
    )


def rollback(hist: DataFrame, version: int, new_version: Column | int) -> DataFrame:
    """History rows that restore the values of ``version``; keys without a value are left alone."""
    old = params_as_of(hist, version).filter(F.col("value").isNotNull())
    new = F.lit(new_version) if isinstance(new_version, int) else new_version
    return old.select("path", "value", new.cast("bigint").alias("version"), F.col("version").alias("restored_from"))


def trial_runs(trials: DataFrame, experiment: str, algorithm: str, created: Column) -> DataFrame:
    """Trials of a search as rows of the experiment log, one run per trial."""
    fixed = F.create_map(F.lit("experiment_id"), F.lit(experiment), F.lit("algorithm"), F.lit(algorithm))
    return trials.select(
        F.format_string("%s-%s-%05d", F.lit(experiment), "method", "trial_no").alias("run_id"),
        F.lit(experiment).alias("experiment_name"),
        F.lit(algorithm).alias("algorithm"),
        created.alias("created"),
        F.map_concat(fixed, "params").alias("params"),
        "metrics",
    )


# The names of a promotion record and its fields.
def promotion_events(runs: DataFrame, approver: str, backup_key: Column) -> DataFrame:
    """One promotion record per run: its hyperparameters under ``promoted_`` plus the event fields."""
    hyper = F.map_filter("params", lambda k, _: ~k.isin(*RESERVED_PARAMS))
    fields = F.create_map(
        F.lit("action"), F.lit("promote_hyperparameters"),
        F.lit("backup_key"), backup_key,
        F.lit("source_experiment_id"), F.col("run_id").cast("string"),
    )
    return runs.select(
        "run_id",
        F.lit("production-promotion").alias("experiment_name"),
        F.lit(approver).alias("approver"),
        backup_key.alias("backup_key"),
        F.map_concat(fields, F.transform_keys(hyper, lambda k, _: F.concat(F.lit("promoted_"), k))).alias("params"),
        "metrics",
    )


def config_rows(runs: DataFrame, approver: str) -> DataFrame:
    """Production config of each run as JSON, versioned by the run."""
    hyper = F.map_filter("params", lambda k, _: ~k.isin(*RESERVED_PARAMS))
    model = F.struct(
        F.col("algorithm").alias("algorithm"),
        F.col("run_id").cast("string").alias("version"),
        hyper.alias("hyperparameters"),
        F.col("metrics").alias("performance"),
        F.date_format("created", "yyyy-MM-dd").alias("tested_date"),
        F.lit(approver).alias("approved_by"),
    )
    return runs.select(
        F.col("experiment_name").alias("name"),
        F.col("run_id").alias("version"),
        F.to_json(F.struct(model.alias("model"))).alias("config"),
    )


def config_history(configs: DataFrame) -> DataFrame:
    """Per name: the current version, how many are archived, and the one a rollback restores.

    The newest version per name joins back to find the one before it; adaptive execution
    broadcasts that side or splits a name that holds most rows.
    """
    top = configs.groupBy("name").agg(
        F.max("version").alias("current_version"),
        F.max_by("config", "version").alias("current_config"),
        F.count("*").alias("n"),
    )
    older = (
        configs.join(configs.groupBy("name").agg(F.max("version").alias("current_version")), "name")
        .filter(F.col("version") < F.col("current_version"))
        .groupBy("name")
        .agg(F.max("version").alias("previous_version"), F.max_by("config", "version").alias("previous_config"))
    )
    return (
        top.join(older, "name", "left")
        .withColumn("archived", F.col("n") - 1)
        .select("name", "current_version", "current_config", "archived", "previous_version", "previous_config")
    )


def merge_results(*parts: DataFrame) -> DataFrame:
    """Records of several stages side by side; a column one of them lacks is null."""
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def compare_methods(trials: DataFrame, score: str = "accuracy") -> DataFrame:
    return trials.groupBy("method").agg(F.max(score).alias("best_score"), F.count("*").alias("trials"))


def top_trials(df: DataFrame, k: int = 10, score: str = "accuracy", order: str = "trial_no") -> DataFrame:
    return df.orderBy(X.number(score).desc_nulls_last(), F.asc(order)).limit(k)


def best_by(df: DataFrame, metric: str, order: str, by: Sequence[str] = ()) -> DataFrame:
    """Row with the highest metric; the first one in ``order`` wins a tie, NaN and null never win."""
    best = F.max_by(F.struct(*df.columns), F.struct(X.number(metric).alias("_m"), (-F.col(order)).alias("_o"))).alias("_row")
    return df.groupBy(*by).agg(best).filter(F.col("_row").isNotNull()).select("_row.*")


def winner(df: DataFrame, metric: str = "recall", order: str = "algorithm") -> DataFrame:
    """Model row with the highest metric, by name on a tie: a top-1, no full sort."""
    return df.orderBy(X.number(metric).desc_nulls_last(), F.asc(order)).limit(1)
