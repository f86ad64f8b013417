import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskengine.operators import features as FE, profiling as PR


@pytest.mark.parametrize(
    "seconds, hour, day, weekend",
    [(0, 0, 3, 0), (3600, 1, 3, 0), (7200, 2, 3, 0), (43200, 12, 3, 0), (86400, 0, 4, 0), (172800, 0, 5, 1), (432000, 0, 1, 0)],
)
def test_time_features(spark, seconds, hour, day, weekend):
    row = FE.time_features(spark.createDataFrame([(float(seconds),)], "Time double")).first()
    assert (row.hour, row.day_of_week, row.is_weekend) == (hour, day, weekend)


def test_night_modes(spark):
    rows = spark.range(24).select((F.col("id") * 3600).cast("double").alias("Time"))
    assert FE.time_features(rows).filter("is_night = 1").isEmpty()
    wrapped = FE.time_features(rows, night="wraparound").filter("is_night = 1").select("hour").collect()
    assert sorted(r[0] for r in wrapped) == [0, 1, 2, 3, 4, 5, 6, 22, 23]
    with pytest.raises(ValueError):
        FE.time_features(rows, night="other")


def test_amount_features(spark):
    row = FE.amount_features(spark.createDataFrame([(100.0,)], "Amount double")).first()
    assert (row.amount_log, row.amount_squared, row.amount_sqrt) == pytest.approx((np.log1p(100), 10000.0, 10.0))


def sample(spark, n=300, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4))
    y = (x[:, 0] + rng.normal(size=n) > 0).astype(int)
    pdf = pd.DataFrame(x, columns=list("abcd")).assign(Class=y, same=1.0)
    return pdf, spark.createDataFrame(pdf)


def test_anova_against_numpy(spark):
    pdf, rows = sample(spark)
    got = {r.feature: r.f_score for r in FE.anova_f(rows, "Class", list("abcd")).collect()}
    for c in "abcd":
        groups = [g[c].to_numpy() for _, g in pdf.groupby("Class")]
        between = sum(len(g) * (g.mean() - pdf[c].mean()) ** 2 for g in groups)
        within = sum(((g - g.mean()) ** 2).sum() for g in groups)
        assert got[c] == pytest.approx(between / (within / (len(pdf) - 2)), rel=1e-9)
    assert FE.select_k_best(rows, "Class", list("abcd"), 1).first().feature == "a"


def test_anova_of_a_constant_is_null(spark):
    _, rows = sample(spark)
    assert FE.anova_f(rows, "Class", ["same"]).first().f_score is None


def test_correlation_against_pandas_with_gaps(spark):
    pdf, _ = sample(spark)
    pdf.loc[::7, "a"] = np.nan
    pdf.loc[::5, "b"] = np.nan
    pdf["big"] = pdf["c"] + 1e6
    rows = spark.createDataFrame(pdf).repartition(5)
    cols = ["a", "b", "c", "d", "Class", "big", "same"]
    want = pdf[cols].corr()
    got = PR.corr_matrix(rows, cols).collect()
    assert len(got) == 21
    for r in got:
        if "same" in (r.feature_a, r.feature_b):
            assert r["corr"] is None
        else:
            assert r["corr"] == pytest.approx(want.loc[r.feature_a, r.feature_b], abs=1e-9)
    best = PR.target_corr(rows, "Class", ["a", "b", "c", "d"], 2).collect()
    order = want["Class"].loc[["a", "b", "c", "d"]].abs().sort_values(ascending=False)
    assert [r.feature for r in best] == list(order.index[:2])


def test_histogram_against_numpy(spark):
    pdf, rows = sample(spark)
    got = PR.histogram(rows, ["a", "b", "same"], "Class", 10).collect()
    for (cls, c) in [(0, "a"), (1, "b"), (0, "same")]:
        want, _ = np.histogram(pdf.loc[pdf.Class == cls, c], bins=10)
        mine = np.zeros(10, int)
        for r in got:
            if r.Class == cls and r.feature == c:
                mine[r.bin] = r.n
        assert mine.tolist() == want.tolist()


def test_density_has_area_one(spark):
    _, rows = sample(spark)
    got = PR.density(rows, "a", "Class", 20).collect()
    wide = {r.Class: r.w for r in rows.groupBy("Class").agg(((F.max("a") - F.min("a")) / 20).alias("w")).collect()}
    for cls in (0, 1):
        assert sum(r.density * wide[cls] for r in got if r.Class == cls) == pytest.approx(1.0)


def test_summary_against_pandas(spark):
    pdf, _ = sample(spark)
    pdf.loc[::9, "b"] = np.nan
    rows = spark.createDataFrame(pdf)
    got = {r.feature: r for r in PR.dataset_summary(rows, ["a", "b"]).collect()}
    for c in "ab":
        s = pdf[c]
        assert (got[c]["count"], got[c].missing) == (s.count(), s.isna().sum())
        assert (got[c]["mean"], got[c]["std"], got[c]["median"]) == pytest.approx((s.mean(), s.std(), s.median()))
    d = {r.feature: r for r in PR.describe(rows, ["a"]).collect()}["a"]
    assert (d.p25, d.p50, d.p75) == pytest.approx(tuple(pdf.a.quantile([0.25, 0.5, 0.75])))


def test_class_balance_without_positives(spark):
    rows = spark.createDataFrame([(0,), (0,)], "Class int")
    row = PR.class_balance(rows).first()
    assert (row.negatives, row.positives, row.ratio) == (2, 0, float("inf"))


def test_feature_vector_order(spark):
    rows = spark.createDataFrame([({"b": 2.0, "a": 1.0},)], "features map<string,double>")
    row = FE.feature_vector(rows, ["a", "b", "c"]).first()
    assert row.vector == [1.0, 2.0, None] and row.payload == "1.0,2.0,"
