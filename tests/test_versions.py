import pytest
from pyspark.sql import functions as F

from riskengine.operators.projections import to_scored
from riskengine.session import work_dir
from riskengine.sources import tables as T, versions as VS
from riskengine.streaming import arrivals as ST

SCHEMA = "transaction_id string, timestamp_ms bigint, batch_date date, fraud_score double, scoring_ms bigint"
DAY_MS = 86_400_000


def batch(spark, *rows):
    frame = spark.createDataFrame(list(rows), SCHEMA.replace("batch_date date", "batch_date string"))
    return frame.withColumn("batch_date", F.to_date("batch_date"))


def stored(frame):
    return {(r.transaction_id, r.timestamp_ms, str(r.batch_date), r.fraud_score) for r in frame.collect()}


def brute(*batches):
    """The rows a store must hold: a dictionary by key, later batches over earlier ones."""
    held = {}
    for rows in batches:
        winners = {}
        for row in rows:
            key, rank = row[:2], (row[4], row[3])
            if key not in winners or rank > winners[key][0]:
                winners[key] = (rank, row)
        held.update({k: row for k, (_, row) in winners.items()})
    return {(r[0], r[1], str(r[2]), r[3]) for r in held.values()}


FIRST = [("a", 1, "2024-01-01", 0.1, 9), ("b", 2, "2024-01-01", 0.2, 9), ("c", DAY_MS, "2024-01-02", 0.3, 9)]
SECOND = [("a", 1, "2024-01-03", 0.9, 5), ("d", 3, "2024-01-01", 0.4, 5), ("d", 3, "2024-01-01", 0.5, 6)]


def test_last_write_wins_and_versions_stay_readable(spark):
    path = work_dir(spark, "versions")
    assert VS.read(spark, path) is None
    assert VS.upsert(batch(spark, *FIRST), path) == 1
    for version in (2, 3):  # a repeated write changes no row
        assert VS.upsert(batch(spark, *SECOND), path) == version
        assert stored(VS.read(spark, path)) == brute(FIRST, SECOND)
    assert stored(VS.read(spark, path, 1)) == brute(FIRST)
    with pytest.raises(ValueError, match="no version 9"):
        VS.read(spark, path, 9)


def test_days_without_a_key_of_the_batch_keep_their_files(spark):
    path = work_dir(spark, "versions")
    VS.upsert(batch(spark, *FIRST), path)
    before = VS.snapshot(spark, path)
    VS.upsert(batch(spark, *SECOND), path)
    after = VS.snapshot(spark, path)
    assert after.days["2024-01-02"] == before.days["2024-01-02"]
    assert after.days["2024-01-01"] != before.days["2024-01-01"]  # holds the row that moved away


def test_a_reader_keeps_its_rows_during_a_write(spark):
    path = work_dir(spark, "versions")
    VS.upsert(batch(spark, *FIRST), path)
    reader = VS.read(spark, path)
    VS.upsert(batch(spark, *SECOND), path)
    assert stored(reader) == brute(FIRST)


@pytest.mark.parametrize("step", ["_write", "_publish"])
def test_a_write_that_dies_shows_nothing(spark, monkeypatch, step):
    path = work_dir(spark, "versions")
    VS.upsert(batch(spark, *FIRST), path)
    whole = getattr(VS, step)

    def dies(*args):
        if step == "_write":
            whole(*args)
        raise OSError("killed")

    with monkeypatch.context() as broken:
        broken.setattr(VS, step, dies)
        with pytest.raises(OSError):
            VS.upsert(batch(spark, *SECOND), path)
    assert stored(VS.read(spark, path)) == brute(FIRST)
    VS.upsert(batch(spark, *SECOND), path)
    assert stored(VS.read(spark, path)) == brute(FIRST, SECOND)
    leftover = len(VS._names(spark, f"{path}/data"))
    VS.clean(spark, path, keep=2)
    assert len(VS._names(spark, f"{path}/data")) == leftover - 1 == 2
    assert stored(VS.read(spark, path)) == brute(FIRST, SECOND)
    assert stored(VS.read(spark, path, 1)) == brute(FIRST)


def test_of_two_writers_of_a_version_one_is_refused(spark, monkeypatch):
    path = work_dir(spark, "versions")
    VS.upsert(batch(spark, *FIRST), path)
    publish = VS._publish

    def overtaken(session, after):
        monkeypatch.setattr(VS, "_publish", publish)
        VS.upsert(batch(spark, ("z", 7, "2024-01-05", 0.7, 1)), path)
        publish(session, after)

    monkeypatch.setattr(VS, "_publish", overtaken)
    with pytest.raises(VS.ConcurrentWrite):
        VS.upsert(batch(spark, *SECOND), path)
    assert stored(VS.read(spark, path)) == brute(FIRST, [("z", 7, "2024-01-05", 0.7, 1)])


def test_clean_leaves_what_kept_versions_name(spark):
    path = work_dir(spark, "versions")
    for rows in (FIRST, SECOND, SECOND):
        VS.upsert(batch(spark, *rows), path)
    assert VS.clean(spark, path, keep=1) == [1, 2]
    assert stored(VS.read(spark, path)) == brute(FIRST, SECOND)
    VS.upsert(batch(spark, ("c", DAY_MS, "2024-01-02", 0.8, 1)), path)
    assert stored(VS.read(spark, path)) == brute(FIRST, SECOND, [("c", DAY_MS, "2024-01-02", 0.8, 1)])
    with pytest.raises(ValueError):
        VS.clean(spark, path, keep=0)


def test_dropped_days_are_gone_from_the_next_version(spark):
    path = work_dir(spark, "versions")
    VS.upsert(batch(spark, *FIRST), path)
    VS.drop_days(spark, path, ["2024-01-01"])
    assert stored(VS.read(spark, path)) == brute(FIRST[2:])
    VS.upsert(batch(spark, FIRST[0]), path)
    assert stored(VS.read(spark, path)) == brute(FIRST[2:], FIRST[:1])


def test_nulls_empty_batches_and_other_columns(spark):
    path = work_dir(spark, "versions")
    VS.upsert(batch(spark), path)
    assert VS.read(spark, path).count() == 0
    odd = [(None, None, None, 0.5, 1), ("a", 1, None, None, None), ("n", None, "2024-01-01", 0.1, 1)]
    VS.upsert(batch(spark, *odd).withColumn("shop", F.lit("x")), path)
    VS.upsert(batch(spark, (None, None, "2024-01-02", 0.6, 2)), path)
    VS.upsert(batch(spark), path)
    assert stored(VS.read(spark, path)) == {(None, None, "2024-01-02", 0.6), ("a", 1, "None", None), ("n", None, "2024-01-01", 0.1)}
    assert {r.transaction_id: r["shop"] for r in VS.read(spark, path).collect()} == {None: None, "a": "x", "n": "x"}


def test_keys_read_by_a_batch_do_not_grow_with_history(spark):
    path = work_dir(spark, "versions")
    read = []
    for day in range(6):
        rows = [(f"{day}-{i}", day * DAY_MS + i, f"2024-01-0{day + 1}", 0.5, 1) for i in range(20)]
        before = VS.snapshot(spark, path)
        if before.version:
            again = rows + [(f"{day - 1}-0", (day - 1) * DAY_MS, f"2024-01-0{day}", 0.7, 2)]
            parts = {str(r[1] // DAY_MS) for r in again}
            read.append(before.keys(spark, parts, VS.STORE_KEYS).count())
            rows = again
        VS.upsert(batch(spark, *rows), path)
    assert read == [20] * 5
    assert VS.read(spark, path).count() == 120


def test_keys_without_a_time_are_found_by_bucket(spark):
    path, part = work_dir(spark, "versions"), VS.key_bucket(["transaction_id"], 8)
    VS.upsert(batch(spark, *FIRST), path, ["transaction_id"], part)
    VS.upsert(batch(spark, ("b", 99, "2024-01-04", 0.6, 1)), path, ["transaction_id"], part)
    assert stored(VS.read(spark, path)) == {("a", 1, "2024-01-01", 0.1), ("b", 99, "2024-01-04", 0.6), ("c", DAY_MS, "2024-01-02", 0.3)}


def test_stream_writes_versions(spark, tiny_dir):
    path, store, progress = work_dir(spark, "in"), work_dir(spark, "versions"), work_dir(spark, "progress")
    rows = T.tx(spark, tiny_dir)
    rows.repartition(4, "event_id").write.parquet(path)

    def score(frame):
        scored = to_scored(frame, T.amount_score(F.col("amount")), F.col("timestamp_ms") + 1000)
        return scored.select("transaction_id", "timestamp_ms", "batch_date", "amount", "fraud_score", "scoring_ms")

    for _ in range(2):
        ST.stream_score(ST.arriving(spark, path, rows.schema, 2), score, store, progress, upsert=VS.upsert)
        assert VS.read(spark, store).count() == rows.count()
        rows.write.mode("append").parquet(path)
