import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from riskengine.operators import registry as RG
from riskengine.operators.projections import to_scored
from riskengine.plans.daily import run_day
from riskengine.plans.prepare import prepare
from riskengine.session import checkpointed, shared_dir, work_dir
from riskengine.sources import readers as RD, sinks as SK, tables as T


def test_labeled_csv_is_tolerant(spark, tmp_path):
    (tmp_path / "part-0.csv").write_text("1,2.5,x\n\n   \nbad, 3 ,4\n7\n0.9,1\n")
    got = sorted(tuple(r) for r in RD.read_labeled_csv(spark, str(tmp_path), ["a", "b"]).fillna(-1.0).collect())
    assert got == [(0, 1.0, -1.0), (0, 3.0, 4.0), (1, 2.5, 0.0)]


def test_labeled_csv_missing_path_raises(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        RD.read_labeled_csv(spark, str(tmp_path / "none"), ["a"]).count()


def test_json_array_batch(spark, tmp_path):
    one = {"id": "t1", "timestamp": 5, "amount": 1.5, "merchantCategory": "m", "features": {"V1": -1.0, "Amount": 1.5}}
    (tmp_path / "a.json").write_text(json.dumps([one, {**one, "id": "t2"}], indent=2))
    (tmp_path / "b.json").write_text('[{"id": "t3", ')
    batch = RD.read_tx_batch(spark, str(tmp_path))
    assert sorted(r.id for r in RD.good_rows(batch).collect()) == ["t1", "t2"]
    assert RD.bad_rows(batch).count() == 1


def test_json_lines_of_arrays(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id":"x"},{"id":"y"}]\n{"id":"z"}\n{"id": oops\n')
    batch = RD.read_tx_batch(spark, str(tmp_path), multiline=False)
    assert sorted(r.id for r in RD.good_rows(batch).collect()) == ["x", "y", "z"]
    assert RD.bad_rows(batch).count() == 1


def test_typed_csv_fails_on_a_bad_value(spark, tmp_path):
    (tmp_path / "c.csv").write_text("a,b\n1.0,2\nx,3\n")
    with pytest.raises(Exception):
        RD.read_table_csv(spark, str(tmp_path), "a double, b int").collect()


def rows(spark, data):
    return spark.createDataFrame(
        [(k, t, dt.date.fromisoformat(d), s, m) for k, t, d, s, m in data],
        "transaction_id string, timestamp_ms long, batch_date date, fraud_score double, scoring_ms long",
    )


def test_upsert_replaces_only_touched_days_and_keys(spark):
    path = work_dir(spark, "store")
    SK.upsert_scored(rows(spark, [("a", 1, "2024-01-01", 0.1, 9), ("b", 1, "2024-01-01", 0.2, 9), ("c", 1, "2024-01-02", 0.3, 9)]), path)
    new = rows(spark, [("a", 1, "2024-01-01", 0.9, 5), ("d", 1, "2024-01-01", 0.4, 5), ("d", 1, "2024-01-01", 0.5, 6)])
    for _ in range(2):  # a repeated run changes nothing
        SK.upsert_scored(new, path)
        got = {r.transaction_id: (r.fraud_score, str(r.batch_date)) for r in spark.read.parquet(path).collect()}
        assert got == {
            "a": (0.9, "2024-01-01"), "b": (0.2, "2024-01-01"), "c": (0.3, "2024-01-02"), "d": (0.5, "2024-01-01")
        }
        assert spark.read.parquet(path).count() == 4


def test_daily_overwrite_keeps_other_days(spark):
    path = work_dir(spark, "daily")
    a = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2))], "n int, batch_date date")
    SK.overwrite_days(a, path)
    SK.overwrite_days(a.filter("n = 2").withColumn("n", F.lit(7)), path)
    assert sorted(r.n for r in spark.read.parquet(path).collect()) == [1, 7]


def test_manifest_rules(spark):
    with pytest.raises(ValueError):
        SK.manifest_row(spark, "e", "s", "DONE")
    with pytest.raises(ValueError):
        SK.manifest_row(spark, "e", "s", "FAILED", error="  ")
    assert SK.manifest_row(spark, "e", "s", "FAILED", error="x").first().error == "x"


@pytest.mark.parametrize("exact", [False, True])
def test_prepare_writes_splits_and_manifest(spark, tiny_dir, exact):
    cards, out = T.cards(spark, tiny_dir), work_dir(spark, "prep")
    row = prepare(cards, "event_id", out, exact=exact, checked=False, execution_id="run-1").first()
    parts = {n: RD.read_split(spark, f"{out}/splits", n) for n in ("train", "validation", "test")}
    assert {n: p.count() for n, p in parts.items()} == row.record_counts
    assert sum(row.record_counts.values()) == cards.count()
    assert parts["train"].columns[0] == "Class"
    csv = RD.read_labeled_csv(spark, f"{out}/test.csv", ["Time", "V1", "V2", "V3", "Amount"])
    assert csv.count() == row.record_counts["test"]
    if exact:
        n = cards.count()
        assert row.record_counts["train"] == int(n * 0.7) and row.record_counts["validation"] == int(n * 0.15)


def test_prepare_records_a_failure(spark, tiny_dir):
    out = work_dir(spark, "prep")
    with pytest.raises(ValueError, match="V4"):
        prepare(T.cards(spark, tiny_dir), "event_id", out)
    row = spark.read.parquet(f"{out}/manifests").first()
    assert row.status == "FAILED" and row.error.startswith("ValueError: required columns not found")


def test_daily_job(spark, tiny_dir):
    out = work_dir(spark, "job")
    tx = T.tx(spark, tiny_dir)

    def score(batch):
        return to_scored(batch, T.amount_score(F.col("amount")), F.col("timestamp_ms") + 1000)

    days = [str(r[0]) for r in tx.select("batch_date").distinct().orderBy("batch_date").limit(3).collect()]
    for day in days:
        last = run_day(tx.filter(F.col("batch_date") == F.lit(day).cast("date")), score, out, "2023-12-01", day).first()
    assert str(last.batch_date) == days[-1] and last.baseline_days == 2
    stored = spark.read.parquet(f"{out}/scored")
    assert stored.count() == tx.filter(F.col("batch_date").cast("string").isin(days)).count()
    sent = spark.read.parquet(f"{out}/alerts").agg(F.sum("size")).first()[0]
    assert sent == stored.filter("fraud_score >= 0.8").count()

    # A day with a score that is no number, then a day without rows, then the first day again.
    def gaps(batch):
        return score(batch).withColumn("fraud_score", F.when(F.col("transaction_id") != broken, F.col("fraud_score")))

    first = tx.filter(F.col("batch_date") == F.lit(days[0]).cast("date"))
    n, broken = first.count(), first.first().transaction_id
    redo = work_dir(spark, "job")
    run_day(first, gaps, redo, "2023-12-01", days[0])
    empty = run_day(first.limit(0), score, redo, "2023-12-01", "2030-05-05").first()
    assert (empty.total, empty.avg_score, empty.baseline_days) == (0, 0.0, 0)

    def record(day):
        row = spark.read.parquet(f"{redo}/daily").filter(F.col("batch_date") == F.lit(day).cast("date")).first()
        return row.total, row.success_count, row.error_count

    assert (record(days[0]), record("2030-05-05")) == ((n - 1, n - 1, 1), (0, 0, 0))
    run_day(first, score, redo, "2023-12-01", days[0])
    assert record(days[0]) == (n, n, 0)


def test_daily_job_on_an_empty_first_batch(spark, tiny_dir):
    out = work_dir(spark, "job")

    def score(batch):
        return to_scored(batch, T.amount_score(F.col("amount")), F.col("timestamp_ms") + 1000)

    row = run_day(T.tx(spark, tiny_dir).limit(0), score, out, "2023-12-01", "2024-01-01").first()
    assert (row.total, row.high_pct, row.avg_score) == (0, 0.0, 0.0)
    tx = T.tx(spark, tiny_dir).filter("batch_date = date '2024-01-02'")
    assert run_day(tx, score, out, "2023-12-01", "2024-01-02").first().total == tx.count() > 0


def _stored(spark, rows, schema):
    return spark.createDataFrame(rows, schema).withColumn("batch_date", F.to_date("batch_date"))


def test_a_narrower_batch_keeps_the_columns_of_the_store(spark):
    path = work_dir(spark, "store")
    wide = "transaction_id string, timestamp_ms long, fraud_score double, scoring_ms long, batch_date string, merchant string"
    SK.upsert_scored(_stored(spark, [("a", 1, 0.5, 1, "2024-01-01", "shop"), ("b", 1, 0.6, 1, "2024-01-01", "bar")], wide), path)
    narrow = wide.removesuffix(", merchant string")
    SK.upsert_scored(_stored(spark, [("b", 1, 0.9, 2, "2024-01-01"), ("c", 1, 0.1, 2, "2024-01-02")], narrow), path)
    SK.upsert_scored(_stored(spark, [("d", 1, 0.2, 3, "2024-01-02", "inn")], wide), path)
    got = {r.transaction_id: (r.fraud_score, r.merchant) for r in spark.read.option("mergeSchema", True).parquet(path).collect()}
    assert got == {"a": (0.5, "shop"), "b": (0.9, None), "c": (0.1, None), "d": (0.2, "inn")}


def test_old_days_are_deleted(spark):
    path = work_dir(spark, "days")
    days = ["2024-01-01", "2024-01-02", "2024-01-05", "2024-02-01", None]
    SK.overwrite_days(_stored(spark, list(enumerate(days)), "id long, batch_date string"), path)
    assert SK.drop_old_days(spark, path, 3, "2024-01-05") == ["2024-01-01", "2024-01-02"]
    left = [str(r.batch_date) for r in spark.read.parquet(path).orderBy("id").collect()]
    assert left == ["2024-01-05", "2024-02-01", "None"]
    assert SK.drop_old_days(spark, path, 3, "2024-01-05") == []


def test_trials_enter_the_experiment_log(spark):
    path = work_dir(spark, "runs")
    trials = spark.createDataFrame(
        [(0, "grid", {"max_depth": "3"}, {"accuracy": 0.9}, 0.9), (1, "grid", {"max_depth": "5"}, {"accuracy": 0.8}, 0.8)],
        "trial_no int, method string, params map<string,string>, metrics map<string,double>, score double",
    )
    SK.log_runs(RG.trial_runs(trials, "exp-7", "boosted", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")), path)
    found = RG.query_runs(spark.read.parquet(path), experiment_name="exp-7", params={"max_depth": 3}).collect()
    assert [(r.run_id, r.hyperparameters) for r in found] == [("exp-7-grid-00000", {"max_depth": "3"})]


def test_checkpoints_use_the_named_folder(spark):
    checkpointed(spark.range(3))
    assert spark.sparkContext.getCheckpointDir() is not None
    assert work_dir(spark, "x").startswith(shared_dir(spark).rstrip("/"))
