import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from riskengine.operators import ranking as RK


def hot_rows(spark, n=4000):
    """A third of the rows in one group, a third with one value, some without a group."""
    i = F.col("id")
    return spark.range(n).select(
        i,
        F.when(i % 3 == 0, "hot").when(i % 50 == 1, F.lit(None)).otherwise(F.concat(F.lit("g"), (i % 7).cast("string"))).alias("g"),
        F.when(i % 3 == 1, F.lit(0.5)).otherwise((F.xxhash64("id") % 1000) / 1000.0).alias("v"),
    )


@pytest.mark.parametrize("parts", [1, 7])
def test_rank_in_group_equals_window(spark, parts):
    rows = hot_rows(spark).repartition(parts)
    order = [F.col("v").desc(), F.col("id").asc()]
    got = RK.rank_in_group(rows, ["g"], order)
    want = rows.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
    assert got.count() == 4000
    assert got.select("id", "g", "rn").exceptAll(want.select("id", "g", F.col("rn").cast("long"))).isEmpty()


def test_running_totals_any_cuts(spark):
    rows = hot_rows(spark).groupBy("g", "v").agg(F.count("*").alias("n"))
    want = {
        (r.g, r.v): (r.run, r.total)
        for r in rows.select(
            "g", "v",
            F.sum("n").over(Window.partitionBy("g").orderBy("v")).alias("run"),
            F.sum("n").over(Window.partitionBy("g")).alias("total"),
        ).collect()
    }
    for cuts in ([], [0.5], [-9.0, -0.5, 0.0, 0.25, 0.5, 9.0], RK.cut_points(rows, ["v"], fraction=1.0)["v"]):
        binned = RK.with_buckets(rows, ["v"], {"v": cuts}).withColumnRenamed("v" + RK.BUCKET, RK.BUCKET)
        got = RK.running_totals(binned, "v", {"run": "n"}, by=["g"])
        assert {(r.g, r.v): (r.run, r.run_total) for r in got.collect()} == want


def test_running_totals_descending(spark):
    rows = spark.createDataFrame([(float(i), i) for i in range(1, 6)], "v double, n int")
    binned = RK.with_buckets(rows, ["v"], {"v": [2.5, 4.0]}).withColumnRenamed("v" + RK.BUCKET, RK.BUCKET)
    got = {r.v: r.run for r in RK.running_totals(binned, "v", {"run": "n"}, descending=True).collect()}
    assert got == {5.0: 5, 4.0: 9, 3.0: 12, 2.0: 14, 1.0: 15}


@pytest.mark.parametrize("probs", [[0.0, 0.25, 0.5, 0.75, 1.0], [0.95, 0.99], [1 / 3]])
def test_exact_quantiles_equal_numpy(spark, probs):
    rows = hot_rows(spark, 3001)
    values = np.array([r.v for r in rows.collect()])
    got = RK.exact_quantiles(rows, ["v"], probs).first()
    assert [got[f"q{i}"] for i in range(len(probs))] == pytest.approx(np.quantile(values, probs).tolist(), abs=1e-12)


def test_exact_quantiles_single_row_nulls_and_nan(spark):
    rows = spark.createDataFrame([(4.0, None), (None, None), (float("nan"), None)], "a double, b double")
    got = {r.feature: r.q0 for r in RK.exact_quantiles(rows, ["a", "b"], [0.5]).collect()}
    assert got == {"a": 4.0}


def test_cut_points_are_sorted_and_bounded(spark):
    cuts = RK.cut_points(hot_rows(spark), ["v"], fraction=1.0)["v"]
    assert cuts == sorted(set(cuts)) and 1 < len(cuts) < RK.MAX_BUCKETS



def test_rows_without_a_group_are_kept(spark):
    from riskengine.operators import evaluation as E, profiling as PR

    rows = hot_rows(spark).select("g", "v", (F.xxhash64("id", "v") % 2 == 0).cast("int").alias("label"), F.col("v").alias("score"))
    groups = rows.select("g").distinct().count()
    assert rows.filter("g is null").count() > 0
    assert PR.latency_stats(rows, "g", "v").count() == groups
    assert PR.latency_stats(rows, "g", "v").filter("g is null and p95_ms is null").isEmpty()
    assert E.metrics_by(rows, "g").count() == groups
    assert E.metrics_by(rows, "g").filter("auc is null").isEmpty()
    assert PR.histogram(rows, ["v"], "g", 4).agg(F.sum("n")).first()[0] == 4000
    assert PR.value_share(rows, "label", "g").agg(F.sum("n")).first()[0] == 4000
