"""One rule for null and NaN: they are in no band, win no selection and are in no metric."""

import pytest
from pyspark.sql import functions as F

from riskengine.operators import evaluation as E, profiling as PR, registry as RG, risk as R
from riskengine.session import work_dir
from riskengine.sources import sinks as SK

NAN = float("nan")


@pytest.fixture(scope="module")
def judged(spark):
    rows = [(1, 1, 0.9), (2, 0, 0.2), (3, 0, NAN), (4, 1, None), (5, 0, 0.6)]
    return spark.createDataFrame(rows, "id int, label int, score double")


def test_every_metric_sees_the_same_three_rows(judged):
    m = E.classification_metrics(judged).first()
    assert (m.tp, m.fp, m.tn, m.fn) == (1, 1, 1, 0)
    s = E.threshold_sweep(judged, [0.5]).first()
    assert (s.tp, s.fp, s.tn, s.fn) == (1, 1, 1, 0)
    assert E.auc_step(judged).first()[0] == E.auc_roc(judged).first()[-1] == 1.0
    assert E.invalid_count(judged).first().n_invalid == 2


def test_arms_are_compared_where_both_have_a_number(judged):
    other = judged.select("id", F.lit(0.9).alias("score"))
    assert E.compare_arms(judged, other).first().n == 3


def test_nan_wins_no_selection(spark):
    trials = spark.createDataFrame([(1, NAN), (2, 0.95), (3, None)], "trial_no int, accuracy double")
    assert RG.best_by(trials, "accuracy", "trial_no").first().trial_no == 2
    assert RG.top_trials(trials, 1).first().trial_no == 2
    assert RG.winner(trials, "accuracy", "trial_no").first().trial_no == 2


def test_a_nan_score_leaves_the_day_usable(spark):
    rows = spark.createDataFrame([("a", 0.9), ("a", NAN), ("a", 0.1)], "batch_date string, fraud_score double")
    day = R.risk_summary(rows).first()
    assert (day.total, day.high, day.low, day.avg_score) == (3, 1, 1, 0.5)


def test_describe_skips_nan(spark):
    row = PR.describe(spark.createDataFrame([(1.0,), (NAN,), (3.0,)], "x double"), ["x"]).first()
    assert (row["count"], row["mean"], row["max"]) == (2, 2.0, 3.0)


def test_a_key_is_stored_once_whatever_its_day(spark):
    store = work_dir(spark, "store")
    schema = "transaction_id string, timestamp_ms bigint, batch_date date, fraud_score double, scoring_ms bigint"

    def put(*rows):
        SK.upsert_scored(spark.createDataFrame([], schema) if not rows else spark.sql(
            " UNION ALL ".join(f"SELECT '{i}' AS transaction_id, {t}L AS timestamp_ms, DATE'{d}' AS batch_date, {s}D AS fraud_score, {n}L AS scoring_ms" for i, t, d, s, n in rows)
        ), store)

    put(("a", 1, "2024-01-01", 0.1, 1), ("b", 2, "2024-01-01", 0.2, 1))
    put(("a", 1, "2024-01-02", 0.3, 2))
    put(("b", 2, "2024-01-02", 0.4, 3))
    found = {(r.transaction_id, str(r.batch_date), r.fraud_score) for r in spark.read.parquet(store).collect()}
    assert found == {("a", "2024-01-02", 0.3), ("b", "2024-01-02", 0.4)}


def test_a_day_that_loses_its_last_alert_ends_up_empty(spark):
    path = work_dir(spark, "alerts")
    one = spark.sql("SELECT DATE'2024-01-01' AS batch_date, 1 AS batch_index, 'x' AS message")
    SK.publish_alerts(one.union(spark.sql("SELECT DATE'2024-01-02', 1, 'y'")), path)
    SK.publish_alerts(one.limit(0), path, days=["2024-01-01"])
    assert [str(r.batch_date) for r in spark.read.parquet(path).collect()] == ["2024-01-02"]
