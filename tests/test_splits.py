import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from riskengine.operators import splits as S


@given(st.floats(0.5, 0.8), st.floats(0.05, 0.15))
@settings(max_examples=100, deadline=None)
def test_borders_cover_the_unit(train, val):
    weights = {"train": train, "validation": val, "test": 1.0 - train - val}
    ends = [e for _, e in S.split_borders(weights)]
    assert ends == sorted(ends) and ends[-1] == 1.0


@pytest.mark.parametrize("weights", [{"a": 0.7, "b": 0.2}, {"a": 0.9, "b": 0.102}])
def test_weights_must_sum_to_one(weights):
    with pytest.raises(ValueError):
        S.check_weights(weights)


def test_weights_tolerance():
    S.check_weights({"a": 0.7, "b": 0.3005})


@pytest.mark.parametrize("fn", [S.split_bernoulli, S.split_exact])
def test_partitioning_does_not_move_rows(spark, fn):
    rows = spark.range(5000)
    one, seven = fn(rows.repartition(1), "id"), fn(rows.repartition(7), "id")
    assert one.exceptAll(seven).isEmpty() and one.count() == 5000


def test_bernoulli_is_near_its_weights(spark):
    sizes = {r.split: r.pct for r in S.split_report(S.split_bernoulli(spark.range(100_000), "id")).collect()}
    assert sizes["train"] == pytest.approx(70, abs=1)
    assert sizes["validation"] == pytest.approx(15, abs=1)
    assert sizes["test"] == pytest.approx(15, abs=1)


@pytest.mark.parametrize("n", [0, 1, 3, 10, 99, 284])
def test_exact_sizes(spark, n):
    sizes = {r.split: r.n for r in S.split_report(S.split_exact(spark.range(n), "id")).collect()}
    train, val = int(n * 0.70), int(n * 0.15)
    want = {"train": train, "validation": val, "test": n - train - val}
    assert sizes == {k: v for k, v in want.items() if v}


def test_exact_split_follows_the_hash_order(spark):
    rows = S.split_exact(spark.range(2000), "id").withColumn("h", S.stable_hash(42, "id"))
    ends = {r.split: (r.lo, r.hi) for r in rows.groupBy("split").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).collect()}
    assert ends["train"][1] <= ends["validation"][0] and ends["validation"][1] <= ends["test"][0]


def test_string_keys(spark):
    rows = spark.range(1000).select(F.concat(F.lit("txn-"), "id").alias("k"))
    assert S.split_exact(rows, "k").filter("split = 'train'").count() == 700


def test_integrity_finds_loss_overlap_and_additions(spark):
    whole = spark.range(10)
    good = S.split_integrity(whole, [spark.range(0, 6), spark.range(6, 10)], "id").first()
    assert good.ok and good.total == good.parts_total == 10
    bad = S.split_integrity(whole, [spark.range(0, 6), spark.range(5, 9), spark.range(20, 22)], "id").first()
    assert (bad.lost, bad.added, bad.overlap, bad.ok) == (1, 3, 1, False)


def test_rollout_is_monotone(spark):
    rows = spark.range(5000)
    arms = [set(r.id for r in S.assign_arm(rows, "id", p).filter("arm = 'challenger'").collect()) for p, _ in S.ROLLOUT_STAGES.values()]
    assert all(a <= b for a, b in zip(arms, arms[1:])) and len(arms[-1]) == 5000
    counts = [r.challenger for r in S.rollout_counts(rows, "id").orderBy("stage").collect()]
    assert counts == [len(a) for a in arms]
