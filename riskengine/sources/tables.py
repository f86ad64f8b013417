"""Input views: the transaction, card, run and latency shapes over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskengine import schemas
from riskengine.functions.scalars import stable_hash

# Model scores have no column in the given tables: amount / 200, at most 1.
AMOUNT_SCALE = 200.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(F.lit("txn-"), F.col("event_id").cast("string")).alias("transaction_id"),
        F.unix_millis(ts).alias("timestamp_ms"),
        F.col("value").alias("amount"),
        F.col("event_type").alias("merchant_category"),
        "user_id",
        F.col("ts").cast("date").alias("batch_date"),
        F.get_json_object("props", "$.k").cast("double").alias("k"),
    )


def amount_score(amount) -> F.col:
    return F.least(F.lit(1.0), amount / F.lit(AMOUNT_SCALE))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tx(spark, sf_dir).withColumns(
        {
            "fraud_score": amount_score(F.col("amount")),
            "scoring_ms": F.col("timestamp_ms") + 1000,
        }
    )


def _label():
    return ((F.col("merchant_category") == "error") | (F.col("amount") >= 150)).cast("int")


def pred(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).select(
        F.col("event_id").alias("id"), _label().alias("label"), F.col("fraud_score").alias("score")
    )


def pred_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).select(
        F.col("event_id").alias("id"),
        "batch_date",
        _label().alias("label"),
        F.col("fraud_score").alias("score"),
    )


def model_preds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two scorers over the same rows, long form: (algorithm, id, label, score)."""
    both = F.array(
        F.struct(F.lit("amount_rule").alias("algorithm"), F.col("fraud_score").alias("score")),
        F.struct(F.lit("k_rule").alias("algorithm"), (F.col("k") / F.lit(100.0)).alias("score")),
    )
    return (
        scored(spark, sf_dir)
        .select(F.col("event_id").alias("id"), _label().alias("label"), F.explode(both).alias("m"))
        .select("m.algorithm", "id", "label", "m.score")
    )


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tx(spark, sf_dir).select(
        "event_id",
        (F.col("timestamp_ms") / 1000).cast("double").alias("Time"),
        F.col("k").alias("V1"),
        F.col("user_id").cast("double").alias("V2"),
        (F.col("event_id") % 97).cast("double").alias("V3"),
        F.col("amount").alias("Amount"),
        _label().alias("Class"),
    )


def full_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``cards`` with all the columns that the quality gate asks for."""
    rest = {c: (F.col("event_id") * i % 101).cast("double") for i, c in enumerate(schemas.PCA_FEATURES, 1) if i > 3}
    rows = cards(spark, sf_dir).withColumns(rest)
    return rows.select("event_id", *schemas.CARD_FEATURES, schemas.TARGET)


def tx_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``tx`` with nulls and NaNs put into ``amount``."""
    return tx(spark, sf_dir).select(
        "event_id",
        F.when(F.col("event_id") % 50 == 0, F.lit(None).cast("double"))
        .when(F.col("event_id") % 77 == 0, F.lit(float("nan")))
        .otherwise(F.col("amount"))
        .alias("amount"),
        "merchant_category",
    )


def raw_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unclamped scores, some below 0, above 1, null or NaN."""
    return tx_dirty(spark, sf_dir).select(
        "event_id", ((F.col("amount") - 20.0) / F.lit(AMOUNT_SCALE)).alias("raw_score")
    )


def trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tuning trials, one per order, with many ties on accuracy."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        key.alias("trial_no"),
        F.when(F.col("o_orderstatus") == "O", "grid").otherwise("random").alias("method"),
        (F.lit(3) + 2 * (F.col("o_custkey") % 3)).cast("int").alias("max_depth"),
        (F.lit(50) + 50 * (key % 3)).cast("int").alias("n_estimators"),
        F.element_at(F.array(F.lit(0.01), F.lit(0.1), F.lit(0.2)), (F.col("o_custkey") % 7 % 3 + 1).cast("int")).alias(
            "learning_rate"
        ),
        (F.lit(0.9) + ((key * 7) % 13) / F.lit(1000.0)).alias("accuracy"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Experiment runs with parameter and metric maps."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        key.alias("run_id"),
        F.col("o_orderpriority").alias("experiment_name"),
        F.col("o_orderstatus").alias("algorithm"),
        F.col("o_orderdate").alias("created"),
        F.create_map(
            F.lit("experiment_id"),
            key.cast("string"),
            F.lit("algorithm"),
            F.col("o_orderstatus"),
            F.lit("max_depth"),
            (F.col("o_custkey") % 10).cast("int").cast("string"),
        ).alias("params"),
        F.create_map(F.lit("accuracy"), (key % 1000) / F.lit(1000.0)).alias("metrics"),
    )


def param_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("path"),
        F.col("o_custkey").cast("string").alias("value"),
        F.col("o_orderkey").alias("version"),
        F.col("o_orderdate").alias("ts"),
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        F.when(
            F.col("event_type") == "error",
            F.concat(F.lit("stage FAILED: "), F.col("event_id").cast("string")),
        )
        .otherwise(F.lit("stage ok"))
        .alias("message"),
    )


def latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(stable_hash("ab", "event_id") % 100 < 10, "challenger").otherwise("champion").alias("arm"),
        F.col("value").alias("latency_ms"),
    )


def manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage manifests: the event type is the stage, each event one finished run."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("stage"),
        "event_id",
        "ts",
        F.concat(F.lit("executions/"), F.col("event_id").cast("string"), F.lit("/output.json")).alias("output_path"),
        F.col("user_id").alias("records"),
    )
