import pytest
from pyspark.sql import functions as F

from riskengine.operators.projections import to_scored
from riskengine.session import work_dir
from riskengine.sources import tables as T, versions as VS
from riskengine.streaming import arrivals as ST


def score(rows):
    scored = to_scored(rows, T.amount_score(F.col("amount")), F.col("timestamp_ms") + 1000)
    return scored.select("transaction_id", "timestamp_ms", "batch_date", "amount", "fraud_score", "scoring_ms")


@pytest.fixture()
def delivery(spark, tiny_dir):
    path = work_dir(spark, "in")
    rows = T.tx(spark, tiny_dir).withColumn("event_ts", F.timestamp_millis("timestamp_ms"))
    rows.repartition(4, "event_id").write.parquet(path)
    return rows, path


def test_restart_and_redelivery_keep_one_row_per_key(spark, delivery):
    rows, path = delivery
    store, progress = work_dir(spark, "store"), work_dir(spark, "progress")
    for _ in range(2):
        ST.stream_score(ST.arriving(spark, path, rows.schema, 2), score, store, progress)
        assert spark.read.parquet(store).count() == rows.count()
        rows.write.mode("append").parquet(path)  # everything is delivered again


def test_daily_totals_grow_with_new_files(spark, delivery):
    rows, path = delivery
    out, progress = work_dir(spark, "days"), work_dir(spark, "progress")

    def stream():
        return score(ST.arriving(spark, path, rows.schema).withColumn("batch", F.lit(1))).withColumn(
            "event_ts", F.timestamp_millis("timestamp_ms")
        )

    ST.stream_daily(stream(), out, progress)
    first = {r.batch_date: r.total for r in spark.read.parquet(out).collect()}
    assert sum(first.values()) == rows.count()
    day = min(first)
    rows.filter(F.col("batch_date") == F.lit(day)).write.mode("append").parquet(path)
    ST.stream_daily(stream(), out, progress)
    second = {r.batch_date: r.total for r in spark.read.parquet(out).collect()}
    assert second[day] == 2 * first[day]
    assert {d: n for d, n in second.items() if d != day} == {d: n for d, n in first.items() if d != day}


def test_redelivered_rows_are_dropped(spark, delivery):
    rows, path = delivery
    out, progress = work_dir(spark, "unique"), work_dir(spark, "progress")
    for _ in range(2):
        ST.stream_dedup(ST.arriving(spark, path, rows.schema, 3), ["transaction_id", "timestamp_ms"], out, progress)
        assert spark.read.parquet(out).count() == rows.count()
        rows.write.mode("append").parquet(path)


def three_files(spark, path):
    """One row per file, the last one from long before the others."""
    for i, when in enumerate(["2024-06-01 10:00:00", "2024-06-02 10:00:00", "2021-01-01 10:00:00"]):
        row = spark.createDataFrame([(f"t{i}", i, 100.0 + i, when)], "transaction_id string, timestamp_ms bigint, amount double, w string")
        row.select("transaction_id", "timestamp_ms", "amount", F.col("w").cast("timestamp").alias("event_ts")).coalesce(1).write.mode("append").parquet(path)


def test_rows_of_any_age_count(spark):
    path, out, days = work_dir(spark, "in"), work_dir(spark, "unique"), work_dir(spark, "days")
    three_files(spark, path)
    schema = spark.read.parquet(path).schema
    ST.stream_dedup(ST.arriving(spark, path, schema, 1), ["transaction_id", "timestamp_ms"], out, work_dir(spark, "p"))
    assert {r.transaction_id for r in spark.read.parquet(out).collect()} == {"t0", "t1", "t2"}
    scored = ST.arriving(spark, path, schema, 1).withColumn("fraud_score", F.lit(0.9))
    ST.stream_daily(scored, days, work_dir(spark, "p"))
    found = {str(r.batch_date): (r.total, r.high) for r in spark.read.parquet(days).collect()}
    assert found == {"2024-06-01": (1, 1), "2024-06-02": (1, 1), "2021-01-01": (1, 1)}


def test_rows_without_a_valid_score_are_set_aside(spark):
    path, store = work_dir(spark, "in"), work_dir(spark, "store")
    three_files(spark, path)

    def score(rows):
        value = F.when(F.col("transaction_id") == "t0", F.lit(float("nan"))).when(F.col("transaction_id") == "t1", 0.4)
        return rows.select("transaction_id", "timestamp_ms", F.to_date("event_ts").alias("batch_date"), "amount",
                           value.alias("fraud_score"), F.lit(1).cast("bigint").alias("scoring_ms"))

    ST.stream_score(ST.arriving(spark, path, spark.read.parquet(path).schema), score, store, work_dir(spark, "p"))
    assert [r.transaction_id for r in spark.read.parquet(store).collect()] == ["t1"]
    assert {r.transaction_id for r in spark.read.parquet(f"{store}-quarantine").collect()} == {"t0", "t2"}


def test_spans_cover_each_batch_once():
    for batches in [*range(0, 200), 511, 512, 513, 4097]:
        covered = [b for level, i in ST.spans(batches) for b in range(i * 8**level, (i + 1) * 8**level)]
        assert sorted(covered) == list(range(batches))
        assert len(ST.spans(batches)) <= 7 * 5


def test_merged_partial_totals_equal_the_whole(spark):
    """Ten batches of one file each; the eighth merges the first eight, the ninth removes them."""
    path, out, progress = work_dir(spark, "in"), work_dir(spark, "days"), work_dir(spark, "p")
    rows = [(f"t{i}", i, f"2024-01-0{1 + i % 3} 10:00:00", (i % 10) / 10) for i in range(30)]
    frame = spark.createDataFrame(rows, "transaction_id string, timestamp_ms bigint, w string, fraud_score double")
    frame = frame.select("transaction_id", "timestamp_ms", F.col("w").cast("timestamp").alias("event_ts"), "fraud_score")
    for i in range(10):
        frame.filter(F.col("timestamp_ms") % 10 == i).coalesce(1).write.mode("append").parquet(path)
    ST.stream_daily(ST.arriving(spark, path, frame.schema, 1), out, progress)
    found = {str(r.batch_date): (r.total, r.high, round(r.avg_score, 9)) for r in spark.read.parquet(out).collect()}
    want = {}
    for _, i, when, score in rows:
        want.setdefault(when[:10], []).append(score)
    assert found == {d: (len(s), sum(x >= 0.8 for x in s), round(sum(s) / len(s), 9)) for d, s in want.items()}
    parts = f"{out}-parts"
    assert ST.spans(10) == [(0, 8), (0, 9), (1, 0)]
    assert not ST.path_exists(spark, f"{parts}/level=0/number=7") and ST.path_exists(spark, f"{parts}/level=1/number=0")
    assert ST.daily_parts(spark, parts, 10).agg(F.sum("total")).first()[0] == 30


def test_a_merging_batch_can_run_again(spark):
    parts = work_dir(spark, "parts")
    for n in range(9):
        part = spark.createDataFrame([("2024-01-01", 1, 0, 0, 1, 1, 0.5)], "batch_date string, total bigint, high bigint, medium bigint, low bigint, valid bigint, score_sum double")
        for _ in range(2):
            part.write.mode("overwrite").parquet(f"{parts}/level=0/number={n}")
            ST._merge_parts(spark, parts, n + 1)
            assert ST.daily_parts(spark, parts, n + 1).agg(F.sum("total")).first()[0] == n + 1


def test_dedup_by_part_reads_the_parts_of_its_batch(spark, delivery):
    rows, path = delivery
    out, progress = work_dir(spark, "unique"), work_dir(spark, "progress")
    keys, part = ["transaction_id", "timestamp_ms"], VS.key_day()
    odd = rows.limit(1).withColumn("timestamp_ms", F.lit(None).cast("bigint"))
    odd.write.mode("append").parquet(path)
    for _ in range(2):
        ST.stream_dedup(ST.arriving(spark, path, rows.schema, 3), keys, out, progress, part)
        assert spark.read.parquet(out).count() == rows.count() + 1
        rows.union(odd).write.mode("append").parquet(path)
    written = spark.read.parquet(out)
    day = rows.select(VS.named(part).alias("part")).first().part
    one = spark.createDataFrame([(day,)], "part string")
    of_day = rows.filter(VS.named(part) == day).count()
    assert ST.held_keys(written, keys, one).count() == of_day < rows.count()
    assert ST.held_keys(written, keys, spark.createDataFrame([(VS.NO_VALUE,)], "part string")).count() == 1
