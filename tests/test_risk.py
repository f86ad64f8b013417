import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskengine.operators import evaluation as E, projections as P, risk as R
from riskengine.operators.quality import accepted, rejected

NAN = float("nan")


def scores(spark, values, day="2024-01-15"):
    rows = [(i, f"t{i}", v, dt.date.fromisoformat(day)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "event_id long, transaction_id string, fraud_score double, batch_date date").withColumns(
        {"amount": F.lit(12.5), "timestamp_ms": F.lit(1700000000000), "merchant_category": F.lit("shop")}
    )


def test_band_borders(spark):
    got = [r.risk_band for r in P.banded(scores(spark, [0.8, 0.7999, 0.5, 0.4999, 0.0, 1.0, NAN, None])).orderBy("event_id").collect()]
    assert got == ["high", "medium", "medium", "low", "low", "high", None, None]


def test_high_risk_border(spark):
    got = P.high_risk(scores(spark, [0.8, 0.7999, NAN, None, 0.95])).select("event_id").collect()
    assert sorted(r[0] for r in got) == [0, 4]


def test_clamp_then_quarantine(spark):
    rows = P.clamped(scores(spark, [-0.5, 1.5, 0.3, NAN, None]), "fraud_score")
    assert sorted(r.score for r in accepted(rows).collect()) == [0.0, 0.3, 1.0]
    assert rejected(rows).count() == 2


@pytest.mark.parametrize("n, sizes", [(0, []), (1, [1]), (99, [99]), (100, [100]), (101, [100, 1]), (520, [100] * 5 + [20])])
def test_alert_chunks(spark, n, sizes):
    rows = scores(spark, [0.9] * n + [0.1] * 30)
    chunks = R.alert_chunks(rows)
    got = [r["count"] for r in chunks.groupBy("chunk").count().orderBy("chunk").collect()]
    assert got == sizes
    summary = R.alert_summary(rows).first()
    assert (summary.high_risk_count, summary.alerts_sent, summary.alert_batches) == (n, n, len(sizes))


def test_chunks_do_not_depend_on_partitioning(spark):
    rows = scores(spark, [0.8 + (i % 5) / 100 for i in range(350)])
    one = R.alert_chunks(rows.repartition(1)).select("event_id", "rn", "chunk")
    seven = R.alert_chunks(rows.repartition(7)).select("event_id", "rn", "chunk")
    assert one.exceptAll(seven).isEmpty()


def test_alert_message(spark):
    message = R.alert_messages(R.alert_chunks(scores(spark, [0.81, 0.95]))).first()
    assert message["size"] == 2
    assert message.subject == "Fraud Alert: 2 High-Risk Transactions Detected"
    lines = message.message.split("\n")
    assert lines[:5] == ["High-Risk Fraud Transactions Detected", "Batch Date: 2024-01-15", "Count: 2", "", "Transactions:"]
    assert lines[5:11] == ["  - ID: t1", "    Amount: $12.50", "    Fraud Score: 0.9500", "    Timestamp: 1700000000000", "    Merchant: shop", ""]


def test_summary_of_no_rows(spark):
    row = R.risk_pct(R.risk_summary(scores(spark, []), by=[])).first()
    assert (row.total, row.high, row.medium, row.low, row.avg_score) == (0, 0, 0, 0, 0.0)
    assert (row.high_pct, row.medium_pct, row.low_pct) == (0.0, 0.0, 0.0)


def daily(spark, rows):
    data = [(dt.date.fromisoformat(d), s, h) for d, s, h in rows]
    return spark.createDataFrame(data, "batch_date date, avg_score double, high_pct double")


def test_first_day_compares_with_zero(spark):
    row = R.drift(daily(spark, [("2024-01-01", 0.4, 0.01)])).first()
    assert (row.baseline_score, row.baseline_days, row.drift_detected) == (0.0, 0, True)


def test_documented_day_has_no_drift(spark):
    row = R.drift(daily(spark, [("2024-01-14", 0.4339, 0.041), ("2024-01-15", 0.4573, 0.052)])).orderBy(F.desc("batch_date")).first()
    assert row.avg_score_drift == pytest.approx(0.0234) and row.high_risk_drift == pytest.approx(0.011)
    assert not row.drift_detected


@pytest.mark.parametrize(
    "score, high, drifted",
    [(0.375, 0.0, False), (0.376, 0.0, True), (0.25, 0.0626, True), (0.25, 0.0625, False), (0.125, 0.0, False), (0.124, 0.0, True)],
)
def test_limits_are_strict_in_exact_binary_steps(spark, score, high, drifted):
    rows = R.drift(daily(spark, [("2024-01-01", 0.25, 0.0), ("2024-01-02", score, high)]), score_limit=0.125, high_limit=0.0625)
    assert rows.filter("batch_date = '2024-01-02'").first().drift_detected is drifted


def test_exactly_at_the_limit_is_no_drift(spark):
    rows = daily(spark, [("2024-01-01", 0.0, 0.0), ("2024-01-02", 0.1, 0.05)])
    assert R.drift(rows).filter("batch_date = '2024-01-02'").first().drift_detected is False


def test_baseline_counts_calendar_days(spark):
    rows = daily(spark, [("2024-01-01", 1.0, 0.0), ("2024-01-31", 0.2, 0.0), ("2024-02-01", 0.4, 0.0)])
    got = {str(r.batch_date): (r.baseline_score, r.baseline_days) for r in R.trailing_baseline(rows).collect()}
    assert got == {"2024-01-01": (0.0, 0), "2024-01-31": (1.0, 1), "2024-02-01": (0.2, 1)}
    joined = R.baseline_range_join(rows).select("batch_date", "baseline_score", "baseline_days")
    assert joined.exceptAll(R.trailing_baseline(rows).select("batch_date", "baseline_score", "baseline_days")).isEmpty()


def test_drift_alert_text(spark):
    text = R.drift_alerts(R.drift(daily(spark, [("2024-01-01", 0.4567, 0.05231)]))).first()
    assert text.subject == "Model Drift Detected: 2024-01-01"
    assert "  Current: 0.4567\n  Baseline: 0.0000\n  Drift: 0.4567 (threshold: 0.1)" in text.message
    assert "  Current: 5.23%\n  Baseline: 0.00%\n  Drift: 0.0523 (threshold: 0.05)" in text.message


def test_latest_per_key_with_a_hot_key(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), "id")
    got = {r.k: r.id for r in R.latest_per_key(rows, ["k"], ["id"]).collect()}
    assert got[-1] == 2997 and len(got) == 2001


def test_ks_equal_and_shifted(spark):
    same = spark.range(2000).select((F.col("id") % 100).cast("double").alias("a"), (F.col("id") % 200 >= 100).alias("recent"))
    row = R.ks_two_sample(same, ["a"], F.col("recent")).first()
    assert row.statistic == 0.0 and row.p_value == 1.0 and not row.drifted
    moved = same.withColumn("a", F.col("a") + F.when(F.col("recent"), 30.0).otherwise(0.0))
    row = R.ks_two_sample(moved, ["a"], F.col("recent")).first()
    assert row.statistic == pytest.approx(0.3) and row.drifted


def test_load_totals(spark):
    rows = spark.createDataFrame([("d", True), ("d", False), ("d", True), ("d", None)], "batch_date string, stored boolean")
    row = R.load_totals(rows).first()
    assert (row.total, row.success_count, row.error_count) == (4, 2, 2)


def test_days_without_rows_are_zeros(spark):
    got = R.filled_days(R.risk_summary(scores(spark, [0.9, 0.1])), "2024-01-14", "2024-01-16").orderBy("batch_date").collect()
    assert [(r.total, r.high, r.avg_score) for r in got] == [(0, 0, 0.0), (2, 1, 0.5), (0, 0, 0.0)]
    nothing = R.filled_days(R.risk_summary(scores(spark, [])), "2024-01-14", "2024-01-14").first()
    assert (nothing.total, nothing.low, nothing.avg_score) == (0, 0, 0.0)


def test_board_with_accuracy(spark):
    rows = scores(spark, [0.9, 0.1, NAN, 0.2]).unionByName(scores(spark, [0.9, 0.9], day="2024-01-05"))
    daily = R.risk_pct(R.risk_summary(rows))
    judged = E.accuracy_by_day(rows.select("batch_date", F.lit(1).alias("label"), F.col("fraud_score").alias("score")))
    got = {r.metric: r for r in R.monitor_board(daily, accuracy=judged).collect()}
    line = got["accuracy"]
    assert (line.recent, line.baseline, line.alert) == (pytest.approx(1 / 3), 1.0, True)
    assert not got["avg_fraud_score"].alert
    none = {r.metric: r for r in R.monitor_board(daily, accuracy=judged.limit(0)).collect()}["accuracy"]
    assert (none.recent, none.change, none.alert) == (None, None, False)
