"""Every registered query: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskengine import schemas
from riskengine.functions import scalars as X
from riskengine.operators import (
    evaluation as E,
    features as FE,
    profiling as PR,
    projections as P,
    quality as Q,
    ranking as RK,
    registry as RG,
    risk as R,
    splits as S,
    training as ML,
)
from riskengine.plans.prepare import prepare
from riskengine.plans.promote import promote
from riskengine.plans.train import published_model
from riskengine.session import checkpointed, shared_dir, work_dir
from riskengine.sources import readers as RD, sinks as SK, tables as T, versions as VS
from riskengine.streaming import arrivals as ST

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CARD_COLS = ["V1", "V2", "V3", "Amount"]
# The documented grids.
GRID = {"max_depth": [3, 5, 7], "eta": [0.01, 0.1, 0.2], "num_round": [50, 100, 150]}
CV_GRID = {"max_depth": [5, 7, 10], "eta": [0.15, 0.2, 0.25]}
THRESHOLDS = [round(0.1 * i, 1) for i in range(1, 10)]


def query(name: str) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return add


def r6(*names: str) -> dict[str, object]:
    return {n: F.round(n, 6) for n in names}


# ---------------------------------------------------------------- sources


@query("src_csv")
def _(spark, d):
    path = work_dir(spark, "csv")
    cards = T.cards(spark, d)
    cards.write.option("header", True).csv(path)
    return RD.read_table_csv(spark, path, cards.schema)


@query("src_labeled_csv")
def _(spark, d):
    path = work_dir(spark, "labeled")
    kind = F.col("merchant_category")
    rest = F.concat_ws(",", F.col("event_id").cast("string"), F.col("amount").cast("string"))
    line = (
        F.when(kind == "click", F.concat(F.lit("1,"), rest, F.lit(","), F.col("k").cast("string")))
        .when(kind == "error", F.concat(F.lit("oops,"), rest, F.lit(","), F.col("k").cast("string")))
        .when(kind == "purchase", F.concat(F.lit(" 1.0 , "), rest, F.lit(" , none")))
        .when(kind == "view", F.lit("   "))
        .otherwise(F.col("event_id").cast("string"))
    )
    T.tx(spark, d).select(line.alias("value")).write.text(path)
    return RD.read_labeled_csv(spark, path, ["event_id", "amount", "k"])


@query("src_parquet")
def _(spark, d):
    path = work_dir(spark, "splits")
    SK.write_parquet(S.split_bernoulli(T.cards(spark, d), "event_id"), path, partition_by=["split"])
    return RD.read_split(spark, path, "validation").select("event_id", "Amount", "Class")


@query("src_json_batch")
def _(spark, d):
    path = work_dir(spark, "json")
    tx = T.tx(spark, d)
    record = F.struct(
        F.col("transaction_id").alias("id"),
        F.col("timestamp_ms").alias("timestamp"),
        "amount",
        F.col("merchant_category").alias("merchantCategory"),
        F.create_map(F.lit("k"), F.col("k"), F.lit("Amount"), F.col("amount")).alias("features"),
    )
    # One array of at most a thousand transactions per line.
    lists = tx.groupBy("batch_date", F.floor(F.col("event_id") / 1000).alias("b"))
    arrays = lists.agg(F.to_json(F.collect_list(record)).alias("value")).select("value")
    broken = tx.groupBy("user_id").agg(F.concat(F.lit('{"id": '), F.max("transaction_id")).alias("value")).select("value")
    arrays.unionByName(broken).write.text(path)
    good = RD.good_rows(RD.read_tx_batch(spark, path, multiline=False))
    return good.select(
        "id", "timestamp", "amount", "merchantCategory", F.element_at("features", "k").alias("k"),
        F.size("features").alias("n_features"),
    )


def _daily(spark, d) -> DataFrame:
    return R.risk_pct(R.risk_summary(T.scored(spark, d)))


def _daily_rows(spark, d) -> DataFrame:
    return _daily(spark, d).select([f.name for f in schemas.DAILY_METRICS])


@query("src_daily_range")
def _(spark, d):
    path = work_dir(spark, "daily")
    SK.write_daily(_daily_rows(spark, d), path)
    return RD.read_daily(spark, path, "2024-01-05", "2024-01-15").withColumns(
        r6("avg_score", "high_pct", "medium_pct", "low_pct")
    )


@query("src_latest_manifest")
def _(spark, d):
    return RG.latest_manifest(T.manifests(spark, d)).select("stage", "event_id", "ts", "output_path", "records")


# ---------------------------------------------------------------- sinks


@query("sink_parquet")
def _(spark, d):
    path = work_dir(spark, "parquet")
    SK.write_parquet(T.cards(spark, d), path)
    return spark.read.parquet(path)


@query("sink_labeled_csv")
def _(spark, d):
    path = work_dir(spark, "out.csv")
    SK.write_labeled_csv(T.cards(spark, d), path)
    return RD.read_labeled_csv(spark, path, ["event_id", "Time", *CARD_COLS])


@query("sink_manifest")
def _(spark, d):
    manifest = prepare(T.full_cards(spark, d), "event_id", work_dir(spark, "prepared"))
    return manifest.select(
        "stage", "status", F.array_join("features", ",").alias("features"),
        F.explode("record_counts").alias("split", "n"),
    )


def _rescored(spark, d) -> DataFrame:
    """A later scoring of the error transactions by another rule."""
    later = T.scored(spark, d).filter(F.col("merchant_category") == "error")
    return later.withColumns({"fraud_score": F.col("k") / 100.0, "scoring_ms": F.col("scoring_ms") + 60000})


STORE_COLS = ["transaction_id", "timestamp_ms", "batch_date", "amount", "merchant_category", "fraud_score", "scoring_ms"]


@query("sink_upsert_scored")
def _(spark, d):
    path = work_dir(spark, "store")
    VS.upsert(T.scored(spark, d).select(STORE_COLS), path)
    VS.upsert(_rescored(spark, d).select(STORE_COLS), path)
    return VS.read(spark, path).select(*STORE_COLS).withColumns(r6("fraud_score"))


@query("sink_daily_metrics")
def _(spark, d):
    path = work_dir(spark, "daily")
    SK.write_daily(_daily_rows(spark, d), path)
    return spark.read.parquet(path).withColumns(r6("avg_score", "high_pct", "medium_pct", "low_pct"))


def _chunks(spark, d) -> DataFrame:
    cols = ["batch_date", "event_id", "transaction_id", "amount", "fraud_score", "timestamp_ms", "merchant_category"]
    return R.alert_chunks(T.scored(spark, d).select(cols))


@query("sink_alert_batches")
def _(spark, d):
    path = work_dir(spark, "alerts")
    SK.publish_alerts(R.alert_messages(_chunks(spark, d)), path)
    return spark.read.parquet(path).select("batch_date", "batch_index", "size", "subject")


@query("sink_experiment_log")
def _(spark, d):
    path = work_dir(spark, "runs")
    SK.log_runs(T.runs(spark, d), path)
    return spark.read.parquet(path).select(
        "run_id", "experiment_name", "algorithm", F.element_at("params", "max_depth").alias("max_depth"),
        F.element_at("metrics", "accuracy").alias("accuracy"),
    )


# ---------------------------------------------------------------- projections, filters, validation


@query("proj_target_first")
def _(spark, d):
    return P.target_first(T.cards(spark, d))


@query("dq_missing_counts")
def _(spark, d):
    return Q.missing_counts(T.tx_dirty(spark, d))


@query("dq_required_columns")
def _(spark, d):
    return Q.missing_columns(T.cards(spark, d))


@query("dq_row_count")
def _(spark, d):
    return Q.row_count_check(T.cards(spark, d))


@query("dq_missing_total")
def _(spark, d):
    return Q.missing_total(T.tx_dirty(spark, d))


@query("proj_clamp_score")
def _(spark, d):
    scores = P.clamped(T.raw_scored(spark, d), "raw_score")
    return scores.select("event_id", F.round(F.when(~F.isnan("score"), F.col("score")), 6).alias("score"))


@query("dq_score_quarantine")
def _(spark, d):
    return Q.quarantine_scores(T.raw_scored(spark, d), "raw_score").select("event_id", "quarantined")


@query("proj_risk_band")
def _(spark, d):
    return P.banded(T.scored(spark, d)).select("event_id", "risk_band")


@query("filter_high_risk")
def _(spark, d):
    return P.high_risk(T.scored(spark, d)).select("event_id", "transaction_id", F.round("fraud_score", 6).alias("fraud_score"))


def _store(spark, d) -> DataFrame:
    path = work_dir(spark, "store")
    SK.overwrite_days(T.scored(spark, d).select("event_id", "batch_date", "fraud_score"), path, ["fraud_score"])
    return spark.read.parquet(path)


@query("lookup_batch_date")
def _(spark, d):
    return P.by_batch_date(_store(spark, d), "2024-01-15").withColumns(r6("fraud_score"))


@query("lookup_date_min_score")
def _(spark, d):
    return P.by_batch_date_min_score(_store(spark, d), "2024-01-15", 0.8).withColumns(r6("fraud_score"))


@query("filter_failed_runs")
def _(spark, d):
    return P.failed_runs(T.run_log(spark, d))


@query("proj_dynamic_threshold")
def _(spark, d):
    rows = T.tx(spark, d).select(
        "event_id",
        (F.col("amount") * 50).alias("amount"),
        (F.col("k") < 20).alias("new_customer"),
        (F.col("merchant_category") == "purchase").alias("good_history"),
    )
    return P.dynamic_threshold(rows, "amount", "new_customer", "good_history").select("event_id", "threshold")


def _param_runs(spark, d) -> DataFrame:
    """Runs with full parameter maps, some of them out of range, mistyped or incomplete."""
    status = F.col("o_orderstatus")
    params = F.create_map(
        F.lit("objective"), F.lit("binary:logistic"),
        F.lit("num_round"), F.col("o_custkey").cast("string"),
        F.lit("max_depth"), (F.col("o_custkey") % 25).cast("string"),
        F.lit("eta"), ((F.col("o_orderkey") % 120) / 100.0).cast("string"),
        F.lit("subsample"), F.when(status == "P", "abc").otherwise("0.8"),
        F.lit("colsample_bytree"), F.when(status != "F", "0.8"),
    )
    return T.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("run_id"),
        F.col("o_orderpriority").alias("experiment_name"),
        status.alias("algorithm"),
        F.col("o_orderdate").alias("created"),
        F.map_filter(params, lambda _, v: v.isNotNull()).alias("params"),
        F.create_map(F.lit("accuracy"), (F.col("o_orderkey") % 1000) / F.lit(1000.0)).alias("metrics"),
    )


@query("dq_param_rules")
def _(spark, d):
    rows = Q.validate_params(_param_runs(spark, d))
    return rows.select("run_id", F.array_join("reasons", ";").alias("reasons"), "valid")


@query("dq_config_rules")
def _(spark, d):
    good = RG.config_rows(T.runs(spark, d), "risk-team")
    status = F.get_json_object("config", "$.model.algorithm")
    broken = (
        F.when(status == "P", F.regexp_replace("config", '"approved_by"', '"approved"'))
        .when(status == "F", F.regexp_replace("config", '"hyperparameters":\\{[^}]*\\}', '"hyperparameters":"none"'))
        .otherwise(F.col("config"))
    )
    rows = good.select(F.col("version").alias("run_id"), broken.alias("config"))
    return Q.validate_config(rows).select("run_id", F.array_join("reasons", ";").alias("reasons"), "valid")


@query("proj_scored")
def _(spark, d):
    rows = P.to_scored(T.tx(spark, d), F.col("amount") / 200.0, F.col("timestamp_ms") + 1000)
    return rows.select(
        "transaction_id", "timestamp_ms", "amount", "merchant_category", F.round("fraud_score", 6).alias("fraud_score"), "scoring_ms"
    )


@query("filter_class_subset")
def _(spark, d):
    rows = P.subset(T.cards(spark, d), "Class", 1, exclude=["Time"])
    return rows.select(P.numeric_columns(rows, exclude=["Class"]))


@query("prof_schema_report")
def _(spark, d):
    return PR.schema_report(T.tx_dirty(spark, d))


@query("filter_retention")
def _(spark, d):
    scored = T.scored(spark, d)
    newest = scored.agg(F.max("batch_date")).scalar()
    return P.retain(scored, "batch_date", 7, newest).select("event_id", "batch_date")


@query("sink_retention")
def _(spark, d):
    path = work_dir(spark, "store")
    SK.overwrite_days(T.scored(spark, d).select("event_id", "batch_date"), path)
    newest = spark.read.parquet(path).agg(F.max("batch_date")).first()[0]
    SK.drop_old_days(spark, path, 7, newest)
    return spark.read.parquet(path)


# ---------------------------------------------------------------- splits


@query("split_bernoulli")
def _(spark, d):
    return S.split_bernoulli(T.cards(spark, d), "event_id").select("event_id", "split")


@query("split_exact")
def _(spark, d):
    return S.split_exact(T.cards(spark, d), "event_id").select("event_id", "split")


@query("split_report")
def _(spark, d):
    return S.split_report(S.split_bernoulli(T.cards(spark, d), "event_id"))


@query("split_integrity")
def _(spark, d):
    rows = S.split_bernoulli(T.cards(spark, d), "event_id")
    parts = [rows.filter(F.col("split") == n) for n in S.DEFAULT_WEIGHTS]
    return S.split_integrity(T.cards(spark, d), parts, "event_id")


@query("split_two_way")
def _(spark, d):
    return S.split_two_way(T.cards(spark, d), "event_id").select("event_id", "split")


@query("ab_assign")
def _(spark, d):
    return S.assign_arm(T.tx(spark, d), "event_id").select("event_id", "arm")


@query("ab_rollout_counts")
def _(spark, d):
    return S.rollout_counts(T.tx(spark, d), "event_id")


# ---------------------------------------------------------------- features


@query("feat_time")
def _(spark, d):
    return FE.time_features(T.cards(spark, d)).select("event_id", "hour", "day_of_week", "is_weekend", "is_night")


@query("feat_time_night_wrap")
def _(spark, d):
    rows = FE.time_features(T.cards(spark, d), night="wraparound")
    return rows.select("event_id", "hour", "day_of_week", "is_weekend", "is_night")


@query("feat_amount")
def _(spark, d):
    rows = FE.amount_features(T.cards(spark, d)).select("event_id", "amount_log", "amount_squared", "amount_sqrt")
    return rows.withColumns(r6("amount_log", "amount_squared", "amount_sqrt"))


@query("feat_interaction")
def _(spark, d):
    pairs = [("V1", "V2"), ("V3", "V1"), ("V1", "Amount")]
    names = [f"{a}_x_{b}" for a, b in pairs]
    return FE.interaction_features(T.cards(spark, d), pairs).select("event_id", *names).withColumns(r6(*names))


def _selection_rows(spark, d) -> DataFrame:
    return FE.amount_features(FE.time_features(T.cards(spark, d)))


SELECTION = [*CARD_COLS, "hour", "day_of_week", "amount_log", "amount_sqrt"]


@query("feat_anova_f")
def _(spark, d):
    return FE.anova_f(_selection_rows(spark, d), "Class", SELECTION).withColumns(r6("f_score"))


@query("feat_select_k_best")
def _(spark, d):
    return FE.select_k_best(_selection_rows(spark, d), "Class", SELECTION, 3).withColumns(r6("f_score"))


@query("prof_corr_matrix")
def _(spark, d):
    return PR.corr_matrix(_selection_rows(spark, d), [*SELECTION, "is_night", "Class"]).withColumns(r6("corr"))


@query("prof_target_corr")
def _(spark, d):
    return PR.target_corr(_selection_rows(spark, d), "Class", SELECTION).withColumns(r6("abs_corr"))


@query("feat_vector")
def _(spark, d):
    rows = T.tx(spark, d).select(
        "event_id", F.create_map(F.lit("k"), F.col("k"), F.lit("Amount"), F.col("amount")).alias("features")
    )
    out = FE.feature_vector(rows, ["Amount", "k", "absent"])
    return out.select("event_id", "payload", F.size("vector").alias("n"), F.element_at("vector", 1).alias("first_value"))


def _train_test(spark, d, features, keep=()):
    rows = S.split_bernoulli(T.cards(spark, d), "event_id")
    train = ML.assemble(rows.filter("split = 'train'"), features, keep=keep)
    test = ML.assemble(rows.filter("split <> 'train'"), features, keep=keep)
    return train, test


@query("feat_rfe")
def _(spark, d):
    return ML.rfe(ML.assemble(T.cards(spark, d), CARD_COLS), CARD_COLS, 2)


@query("feat_rf_importance")
def _(spark, d):
    return ML.rf_importance(ML.assemble(T.cards(spark, d), CARD_COLS), CARD_COLS)


@query("feat_impact")
def _(spark, d):
    train, test = _train_test(spark, d, CARD_COLS)
    best = [r[0] for r in FE.select_k_best(T.cards(spark, d), "Class", CARD_COLS, 2).select("feature").collect()]
    return ML.feature_impact(train, test, CARD_COLS, best)


# ---------------------------------------------------------------- aggregates and profiles


@query("prof_summary")
def _(spark, d):
    out = PR.dataset_summary(T.tx_dirty(spark, d), ["event_id", "amount"])
    return out.withColumns({c: F.round(c, 4) for c in ("mean", "std", "median")})


@query("prof_describe")
def _(spark, d):
    out = PR.describe(_selection_rows(spark, d), ["hour", "day_of_week", "is_weekend", "is_night", *CARD_COLS])
    return out.withColumns(r6("mean", "std", "min", "max", "p25", "p50", "p75"))


BALANCE = ("negative_pct", "positive_pct", "ratio")


@query("prof_class_balance")
def _(spark, d):
    return PR.class_balance(T.cards(spark, d)).withColumns(r6(*BALANCE))


@query("prof_class_balance_split")
def _(spark, d):
    return PR.class_balance(S.split_bernoulli(T.cards(spark, d), "event_id"), by=["split"]).withColumns(r6(*BALANCE))


@query("prof_histogram")
def _(spark, d):
    return PR.histogram(T.cards(spark, d), CARD_COLS, "Class").select("Class", "feature", "bin", "n")


@query("prof_density")
def _(spark, d):
    hours = PR.density(FE.time_features(T.cards(spark, d)), "hour", "Class", 24)
    return hours.withColumns(r6("density"))


@query("prof_value_share")
def _(spark, d):
    return PR.value_share(FE.time_features(T.cards(spark, d)), "day_of_week", "Class").withColumns(r6("share"))


@query("agg_rate_by")
def _(spark, d):
    return PR.rate_by(FE.time_features(T.cards(spark, d)), "is_weekend", "Class").withColumns(r6("rate"))


@query("agg_risk_summary")
def _(spark, d):
    return R.risk_summary(T.scored(spark, d)).withColumns(r6("avg_score"))


@query("agg_risk_summary_filled")
def _(spark, d):
    # A day whose batch is empty: the tenth, and the days before the first event.
    rows = T.scored(spark, d).filter(F.col("batch_date") != F.lit("2024-01-10").cast("date"))
    return R.filled_days(R.risk_summary(rows), "2023-12-30", "2024-01-20").withColumns(r6("avg_score"))


@query("agg_risk_pct")
def _(spark, d):
    return _daily(spark, d).select("batch_date", "high_pct", "medium_pct", "low_pct").withColumns(
        r6("high_pct", "medium_pct", "low_pct")
    )


@query("agg_load_totals")
def _(spark, d):
    return R.load_totals(T.tx(spark, d).withColumn("stored", F.col("k") >= 5))


@query("agg_rate_by_period")
def _(spark, d):
    periods = {"baseline": ("2024-01-01", "2024-01-20"), "recent": ("2024-01-21", "2024-01-31")}
    return PR.rate_by_period(T.pred_by_day(spark, d), "batch_date", "label", periods).withColumns(r6("rate"))


@query("agg_latency")
def _(spark, d):
    return PR.latency_stats(T.latency(spark, d), "arm").withColumns(r6("avg_ms", "p95_ms", "p99_ms"))


@query("agg_pivot_mean")
def _(spark, d):
    out = PR.pivot_mean(T.trials(spark, d), ["n_estimators", "max_depth"], "learning_rate", [0.01, 0.1, 0.2], "accuracy")
    names = {"learning_rate_0.01": "lr_001", "learning_rate_0.1": "lr_01", "learning_rate_0.2": "lr_02"}
    return out.withColumnsRenamed(names).withColumns(r6(*names.values()))


@query("reshape_melt")
def _(spark, d):
    wide = E.classification_metrics(T.model_preds(spark, d), ["algorithm"])
    out = PR.melt_metrics(wide, ["algorithm"], ["accuracy", "precision", "recall", "f1"])
    return out.withColumns(r6("score"))


# ---------------------------------------------------------------- joins


@query("join_pred_actual")
def _(spark, d):
    rows = T.pred(spark, d)
    out = E.join_pred_actual(rows.select("id", "score"), rows.select("id", "label"))
    return out.select("id", "label", F.round("score", 6).alias("score"))


@query("join_metric_baseline")
def _(spark, d):
    current = E.metric_rows(E.metrics_with_auc(T.pred(spark, d)))
    out = E.compare_to_baseline(current, E.baseline_rows(spark))
    return out.withColumns(r6("current", "baseline", "difference", "percent_change"))


@query("join_arm_compare")
def _(spark, d):
    rows = T.model_preds(spark, d)
    out = E.compare_arms(rows.filter("algorithm = 'amount_rule'"), rows.filter("algorithm = 'k_rule'"))
    return out.withColumns(r6("avg_champion", "avg_challenger", "mean_abs_diff", "agreement"))


@query("ab_verdict")
def _(spark, d):
    rows = T.model_preds(spark, d)
    slow = PR.latency_stats(T.latency(spark, d).filter("arm = 'challenger'"), "arm").select("p95_ms")
    out = E.ab_verdict(rows.filter("algorithm = 'amount_rule'"), rows.filter("algorithm = 'k_rule'"), slow.scalar())
    return out.withColumns(r6("champion_accuracy", "challenger_accuracy", "agreement", "improvement_pct", "p95_ms"))


@query("join_baseline_range")
def _(spark, d):
    out = R.baseline_range_join(_daily(spark, d))
    return out.select("batch_date", "baseline_score", "baseline_high_pct", "baseline_days").withColumns(
        r6("baseline_score", "baseline_high_pct")
    )


@query("join_current_model")
def _(spark, d):
    current = RG.latest_manifest(T.manifests(spark, d), stage="purchase").select(
        F.col("output_path").alias("model_path"), F.col("event_id").alias("model_version")
    )
    return P.attach_model(T.tx(spark, d).select("event_id"), current)


# ---------------------------------------------------------------- windows, sorts, top-k


@query("win_trailing_baseline")
def _(spark, d):
    out = R.trailing_baseline(_daily(spark, d))
    return out.select("batch_date", "baseline_score", "baseline_high_pct", "baseline_days").withColumns(
        r6("baseline_score", "baseline_high_pct")
    )


@query("win_alert_chunks")
def _(spark, d):
    return _chunks(spark, d).select("batch_date", "event_id", "rn", "chunk")


@query("agg_alert_summary")
def _(spark, d):
    return R.alert_summary(T.scored(spark, d))


@query("agg_alert_message")
def _(spark, d):
    return R.alert_messages(_chunks(spark, d))


@query("topk_trials")
def _(spark, d):
    return RG.top_trials(T.trials(spark, d)).withColumns(r6("accuracy"))


@query("topk_best_trial")
def _(spark, d):
    return RG.best_by(T.trials(spark, d), "accuracy", "trial_no", by=["method"]).withColumns(r6("accuracy"))


@query("topk_winner_recall")
def _(spark, d):
    out = RG.winner(E.classification_metrics(T.model_preds(spark, d), ["algorithm"]))
    return out.select("algorithm", "recall", "precision").withColumns(r6("recall", "precision"))


@query("topk_high_risk")
def _(spark, d):
    return P.top_risk(T.scored(spark, d)).select("event_id", "transaction_id", F.round("fraud_score", 6).alias("fraud_score"))


@query("win_latest_per_key")
def _(spark, d):
    rows = T.tx(spark, d).select("user_id", "event_id", "timestamp_ms", "amount", "merchant_category")
    return R.latest_per_key(rows, ["user_id"], ["timestamp_ms", "event_id"])


# ---------------------------------------------------------------- drift and monitoring

DRIFT_COLS = ["avg_score", "high_pct", "baseline_score", "baseline_high_pct", "avg_score_drift", "high_risk_drift"]


@query("drift_daily")
def drift_daily(spark, d):
    out = R.daily_drift(T.scored(spark, d))
    return out.select("batch_date", "total", *DRIFT_COLS, "drift_detected").withColumns(r6(*DRIFT_COLS))


@query("drift_alerts")
def _(spark, d):
    out = R.drift_alerts(R.daily_drift(T.scored(spark, d)))
    return out.withColumns(r6("avg_score_drift", "high_risk_drift"))


@query("drift_ks")
def _(spark, d):
    rows = T.tx(spark, d).select("amount", "k", "user_id", "batch_date")
    recent = F.col("batch_date") >= F.lit("2024-01-21").cast("date")
    return R.ks_two_sample(rows, ["amount", "k", "user_id"], recent).withColumns(r6("statistic", "p_value"))


@query("drift_board")
def _(spark, d):
    return R.monitor_board(_daily(spark, d)).withColumns(r6("recent", "baseline", "change"))


@query("drift_board_accuracy")
def _(spark, d):
    out = R.monitor_board(_daily(spark, d), accuracy=E.accuracy_by_day(T.pred_by_day(spark, d)))
    return out.withColumns(r6("recent", "baseline", "change"))


# ---------------------------------------------------------------- evaluation

RATES = ["accuracy", "precision", "recall", "f1"]


@query("eval_metrics")
def _(spark, d):
    return E.classification_metrics(T.pred(spark, d)).withColumns(r6(*RATES))


@query("eval_auc_step")
def _(spark, d):
    return E.auc_step(T.pred(spark, d)).withColumns(r6("auc_step"))


@query("eval_auc_roc")
def _(spark, d):
    return E.auc_roc(T.pred(spark, d)).withColumns(r6("auc"))


@query("eval_confusion")
def _(spark, d):
    return E.confusion_matrix(T.pred(spark, d))


@query("eval_roc_curve")
def _(spark, d):
    return E.roc_curve(T.pred(spark, d)).withColumns(r6("threshold", "fpr", "tpr"))


@query("eval_pr_curve")
def _(spark, d):
    return E.pr_curve(T.pred(spark, d)).withColumns(r6("threshold", "precision", "recall"))


@query("eval_gate")
def _(spark, d):
    out = E.gate(E.classification_metrics(T.model_preds(spark, d), ["algorithm"]))
    return out.select("algorithm", F.round("accuracy", 6).alias("accuracy"), "meets_production", "low_accuracy")


@query("eval_gate_full")
def _(spark, d):
    out = E.gate_full(E.metrics_by(T.model_preds(spark, d)))
    return out.select("algorithm", *[f"{m}_ok" for m in E.FULL_GATE], "all_ok")


@query("eval_threshold_sweep")
def _(spark, d):
    return E.threshold_sweep(T.pred(spark, d), THRESHOLDS).withColumns(r6("tpr", "fpr", "precision"))


@query("eval_threshold_cost")
def _(spark, d):
    return E.threshold_cost(T.pred(spark, d), THRESHOLDS)


@query("eval_f_beta")
def _(spark, d):
    out = E.f_beta(E.classification_metrics(T.model_preds(spark, d), ["algorithm"]), {"f_half": 0.5, "f_two": 2.0})
    return out.select("algorithm", "f_half", "f_two").withColumns(r6("f_half", "f_two"))


@query("eval_report")
def _(spark, d):
    out = E.evaluate(T.pred(spark, d))
    doubles = [*RATES, "auc", "auc_step", *[f"{m}_change" for m in E.PRODUCTION_BASELINE]]
    return out.withColumns(r6(*doubles))


@query("eval_metrics_by_model")
def _(spark, d):
    return E.metrics_by(T.model_preds(spark, d)).withColumns(r6(*RATES, "auc"))


# ---------------------------------------------------------------- model training and scoring


@query("ml_train_gbt")
def _(spark, d):
    train, test = _train_test(spark, d, CARD_COLS)
    scored = ML.positive_probability(ML.train_gbt(train), test).select("label", "score")
    return E.classification_metrics(scored).withColumns(r6(*RATES))


def _registered(spark, d):
    """The model that the tables' registry in the shared folder holds; the first query to ask publishes it."""
    out = f"{shared_dir(spark).rstrip('/')}/registry-{hashlib.sha256(d.rstrip('/').encode()).hexdigest()[:12]}"
    return published_model(T.full_cards(spark, d), "event_id", out, CARD_COLS, min_accuracy=0.5)


def _tells_apart(scored: DataFrame, score: str):
    """Whether rows of class 1 score higher than others on the mean, as no constant does."""
    mean = [F.avg(F.when(F.col("Class") == c, F.col(score))) for c in (1, 0)]
    return scored.agg((mean[0] > mean[1] + 0.01).alias("tells_apart"))


@query("ml_score_batch")
def _(spark, d):
    model, features = _registered(spark, d)
    scored = checkpointed(ML.score_rows(T.cards(spark, d), model, features, (F.col("Time") * 1000).cast("bigint")))
    out = scored.select("event_id", F.col("fraud_score").between(0.0, 1.0).alias("is_probability"), "scoring_ms")
    return out.withColumn("tells_apart", _tells_apart(scored, "fraud_score").scalar())


@query("ml_score_udf")
def _(spark, d):
    # A nested function travels to the tasks by value.
    def make_scorer():
        def score(amount: pd.Series, k: pd.Series) -> pd.Series:
            return (amount - 20.0) / 200.0 + k / 1000.0

        return score

    out = ML.score_with(T.tx(spark, d).select("event_id", "amount", "k"), make_scorer, ["amount", "k"])
    return out.select("event_id", F.round("score", 6).alias("score"))


@query("ml_compare")
def _(spark, d):
    train, test = _train_test(spark, d, CARD_COLS)
    return ML.compare_algorithms(train, test, ML.default_algorithms())


@query("ml_grid_search")
def _(spark, d):
    train, val = _train_test(spark, d, CARD_COLS)
    trials = ML.grid_search(train, val, GRID)
    # What a rerun of any fit must give: the trials in order, each judged by the asked metric.
    return trials.select(
        "trial_no", "method", *[F.element_at("params", p).alias(p) for p in ("max_depth", "eta", "num_round")],
        (F.col("score") == F.element_at("metrics", "accuracy")).alias("judged"),
        (F.element_at("metrics", "auc_roc") != 0.5).alias("tells_apart"),  # a constant has 0.5
    )


@query("ml_random_search")
def _(spark, d):
    train, val = _train_test(spark, d, CARD_COLS)
    space = {"max_depth": [3, 5, 7, 10], "eta": lambda rng: rng.uniform(0.01, 0.3)}
    trials = ML.random_search(train, val, space, 10, metric="f1")
    return trials.select("trial_no", "method", F.to_json("params").alias("params"), F.to_json("metrics").alias("metrics"), "score")


@query("ml_probe")
def _(spark, d):
    model, features = _registered(spark, d)
    test = S.split_bernoulli(T.cards(spark, d), "event_id").filter("split <> 'train'")
    scored = checkpointed(ML.positive_probability(model, ML.assemble(test, features)).withColumnRenamed("label", "Class"))
    probed = ML.probe(model, ML.assemble(test, features)).select("probed", "healthy")
    return probed.withColumn("tells_apart", _tells_apart(scored, "score").scalar())


@query("ml_cv_grid")
def _(spark, d):
    vectors = ML.assemble(T.cards(spark, d), CARD_COLS, keep=["event_id"])
    trials = ML.cv_grid_search(vectors, "event_id", {}, CV_GRID, metric="auc_roc")
    return trials.select(
        "trial_no", *[F.element_at("params", p).alias(p) for p in ("max_depth", "eta")],
        (F.col("mean_score") > 0.5).alias("tells_apart"), (F.col("std_score") < 0.5).alias("is_spread"),
    )


# ---------------------------------------------------------------- experiments and registry


@query("exp_query_runs")
def _(spark, d):
    out = RG.query_runs(
        T.runs(spark, d), experiment_name="1-URGENT", start="1996-01-01", end="2000-12-31", min_accuracy=0.5,
        params={"max_depth": 7},
    )
    return out.select(
        "run_id", "experiment_name", "algorithm", "created", F.round(F.element_at("metrics", "accuracy"), 6).alias("accuracy"),
        F.to_json("hyperparameters").alias("hyperparameters"),
    )


def _middle_version(hist: DataFrame):
    return hist.agg(F.floor(F.max("version") / 2).cast("bigint")).scalar()


@query("reg_params_as_of")
def _(spark, d):
    hist = T.param_history(spark, d)
    return RG.params_as_of(hist, _middle_version(hist))


@query("reg_rollback")
def _(spark, d):
    hist = T.param_history(spark, d)
    return RG.rollback(hist, _middle_version(hist), hist.agg(F.max("version") + 1).scalar())


@query("reg_promotion_events")
def _(spark, d):
    key = F.concat(F.lit("backups/"), F.date_format("created", "yyyyMMdd-HHmmss"))
    out = RG.promotion_events(T.runs(spark, d), "risk-team", key)
    return out.select(
        "run_id", "experiment_name", "approver", "backup_key",
        F.element_at("params", "promoted_max_depth").alias("promoted_max_depth"),
        F.element_at("params", "source_experiment_id").alias("source"),
        F.size("params").alias("n_params"),
    )


@query("reg_promote")
def _(spark, d):
    out = work_dir(spark, "registry")
    promote(_param_runs(spark, d), out, "risk-team")
    hist = spark.read.parquet(f"{out}/params")
    return hist.groupBy("path").agg(
        F.count("*").alias("n"), F.max("version").alias("version"), F.max_by("value", "version").alias("value")
    )


@query("reg_config_history")
def _(spark, d):
    out = RG.config_history(RG.config_rows(T.runs(spark, d), "risk-team"))
    return out.select(
        "name", "current_version", "archived", "previous_version",
        F.get_json_object("current_config", "$.model.tested_date").alias("current_tested"),
        F.get_json_object("previous_config", "$.model.hyperparameters.max_depth").alias("previous_depth"),
    )


@query("exp_merge_results")
def _(spark, d):
    tuning = RG.best_by(T.trials(spark, d), "accuracy", "trial_no").select(
        F.lit("hyperparameter_tuning").alias("section"), F.col("accuracy").alias("best_score"), "max_depth"
    )
    models = RG.winner(E.metrics_by(T.model_preds(spark, d)), "accuracy").select(
        F.lit("algorithm_comparison").alias("section"), F.col("accuracy").alias("best_score"),
        F.col("algorithm").alias("best_algorithm"), "f1",
    )
    chosen = FE.select_k_best(_selection_rows(spark, d), "Class", SELECTION, 3).agg(
        F.count("*").alias("n_features")
    ).select(F.lit("feature_engineering").alias("section"), "n_features")
    return RG.merge_results(tuning, models, chosen).withColumns(r6("best_score", "f1"))


@query("exp_compare_methods")
def _(spark, d):
    return RG.compare_methods(T.trials(spark, d)).withColumns(r6("best_score"))


# ---------------------------------------------------------------- scalar functions


@query("scalar_suite")
def _(spark, d):
    ev = T.table(spark, d, "events")
    ts, v = F.col("ts").cast("timestamp"), F.col("value")
    features = F.create_map(F.lit("k"), F.get_json_object("props", "$.k"), F.lit("user"), F.lit("u"))
    path = F.concat(F.lit("store://bucket-"), F.col("event_type"), F.lit("/executions/"), F.col("event_id").cast("string"), F.lit("/output.json"))
    return ev.select(
        "event_id",
        F.round(F.log1p(v), 6).alias("v_log1p"),
        F.round(v * v, 6).alias("v_square"),
        F.round(F.sqrt(v), 6).alias("v_sqrt"),
        F.round(F.abs(v - 50), 6).alias("v_abs"),
        F.round(v, 1).alias("v_round1"),
        F.round(F.least(F.greatest((v - 20) / 100, F.lit(0.0)), F.lit(1.0)), 6).alias("v_clamp"),
        v.between(10, 20).alias("v_between"),
        F.col("event_type").isin("view", "click").alias("t_isin"),
        F.hour(ts).alias("t_hour"),
        F.weekday(ts).alias("t_weekday"),
        F.date_sub(F.to_date("ts"), 30).alias("t_minus_30"),
        F.to_date(F.date_format(ts, "yyyy-MM-dd")).alias("t_parsed"),
        F.date_format(ts, "yyyyMMdd-HHmmss").alias("t_suffix"),
        F.unix_millis(ts).alias("t_millis"),
        F.unix_millis(F.timestamp_seconds(F.unix_millis(ts) / 1000)).alias("t_from_seconds"),
        F.format_string("%.2f", v).alias("v_fmt2"),
        F.format_string("%d%%", F.floor(v)).alias("v_pct"),
        F.trim(F.concat(F.lit("  "), F.col("event_type"), F.lit(" "))).alias("s_trim"),
        X.tolerant_double(F.concat(F.lit(" "), v.cast("string"))).alias("s_double"),
        X.tolerant_double(F.col("event_type")).alias("s_not_double"),
        F.array_join(F.split(F.concat_ws(",", "event_type", F.col("user_id").cast("string")), ","), "|").alias("s_split_join"),
        F.regexp_extract(path, "^store://([^/]+)/(.*)$", 1).alias("p_bucket"),
        F.regexp_extract(path, "^store://([^/]+)/(.*)$", 2).alias("p_key"),
        F.element_at(F.split(path, "/"), -1).alias("p_base"),
        F.rtrim(F.concat(path, F.lit("//")), F.lit("/")).alias("p_stripped"),
        path.startswith("store://").alias("p_prefix"),
        F.format_string("%s-%s-%05d", F.lit("run"), "event_type", F.col("user_id")).alias("s_template"),
        F.element_at(features, "k").alias("m_get"),
        F.array_join(F.map_values(features), ",").alias("m_values"),
        F.size(F.map_filter(features, lambda k, _: k != "user")).alias("m_filtered"),
        F.to_json(F.struct("event_id", "event_type")).alias("j_encoded"),
        F.from_json("props", "k bigint")["k"].alias("j_decoded"),
        F.coalesce(F.when(v > 50, v), F.lit(0.0)).alias("v_default"),
        X.error_text(
            F.lit("StageError"), F.col("event_type"),
            F.when(v > 50, F.lit("IOError")), F.when(v > 60, F.lit("disk")),
        ).alias("s_error"),
        X.run_id(F.col("event_type"), ts, F.col("event_id")).alias("s_run_id"),
    )


# ---------------------------------------------------------------- streaming


def _deliver(spark, d, times: int = 1) -> str:
    """Transactions as arriving Parquet files, every row ``times`` times."""
    path = work_dir(spark, "arriving")
    rows = T.tx(spark, d).withColumn("event_ts", F.timestamp_millis("timestamp_ms"))
    for _ in range(times):
        rows.repartition("event_id").write.mode("append").parquet(path)
    return path


def _arriving(spark, path: str) -> DataFrame:
    return ST.arriving(spark, path, spark.read.parquet(path).schema)


def _score_stream(rows: DataFrame) -> DataFrame:
    scored = P.to_scored(rows, T.amount_score(F.col("amount")), F.col("timestamp_ms") + 1000)
    return scored.drop("event_ts", "k", "user_id")


@query("stream_scored")
def _(spark, d):
    store = work_dir(spark, "store")
    ST.stream_score(_arriving(spark, _deliver(spark, d, 2)), _score_stream, store, work_dir(spark, "progress"), upsert=VS.upsert)
    return VS.read(spark, store).select("transaction_id", "batch_date", F.round("fraud_score", 6).alias("fraud_score"), "risk_band")


@query("stream_daily_summary")
def _(spark, d):
    out = work_dir(spark, "days")
    rows = _score_stream(_arriving(spark, _deliver(spark, d)).withColumn("_ts", F.col("event_ts")))
    ST.stream_daily(rows.withColumnRenamed("_ts", "event_ts"), out, work_dir(spark, "progress"))
    return spark.read.parquet(out).withColumns(r6("avg_score"))


@query("stream_dedup")
def _(spark, d):
    out = work_dir(spark, "unique")
    keys = ["transaction_id", "timestamp_ms"]
    ST.stream_dedup(_arriving(spark, _deliver(spark, d, 2)), keys, out, work_dir(spark, "progress"), VS.key_day())
    return spark.read.parquet(out).select("event_id", "transaction_id", "timestamp_ms", "amount")
