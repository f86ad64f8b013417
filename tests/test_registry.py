import datetime as dt

from pyspark.sql import functions as F

from riskengine.operators import registry as RG


def runs(spark):
    rows = [
        (i, "exp-a" if i % 2 else "exp-b", dt.datetime(2024, 1, 1 + i), {"experiment_id": str(i), "user": "u", "max_depth": str(i % 3)}, {"accuracy": i / 10})
        for i in range(10)
    ]
    return spark.createDataFrame(
        rows, "run_id long, experiment_name string, created timestamp_ntz, params map<string,string>, metrics map<string,double>"
    )


def test_query_filters_and_order(spark):
    got = [r.run_id for r in RG.query_runs(runs(spark), "exp-a").collect()]
    assert got == [9, 7, 5, 3, 1]
    got = [r.run_id for r in RG.query_runs(runs(spark), min_accuracy=0.4, start="2024-01-03", end="2024-01-08").collect()]
    assert got == [7, 6, 5, 4]
    got = [r.run_id for r in RG.query_runs(runs(spark), params={"max_depth": 1}, limit=2).collect()]
    assert got == [7, 4]
    assert RG.query_runs(runs(spark), params={"absent": 1}).isEmpty()
    assert RG.query_runs(runs(spark)).first().hyperparameters == {"max_depth": "0"}


def test_rollback_skips_values_that_did_not_exist(spark):
    hist = spark.createDataFrame(
        [("eta", "0.1", 1), ("eta", "0.2", 5), ("depth", None, 2), ("depth", "7", 6)], "path string, value string, version long"
    )
    assert {r.path: r.value for r in RG.params_as_of(hist, 3).collect()} == {"eta": "0.1", "depth": None}
    got = [tuple(r) for r in RG.rollback(hist, 3, 9).select("path", "value", "version", "restored_from").collect()]
    assert got == [("eta", "0.1", 9, 1)]


def test_config_history(spark):
    rows = spark.createDataFrame([("a", 1, "c1"), ("a", 3, "c3"), ("a", 2, "c2"), ("b", 1, "x")], "name string, version long, config string")
    got = {r.name: r for r in RG.config_history(rows).collect()}
    assert (got["a"].current_config, got["a"].archived, got["a"].previous_config) == ("c3", 2, "c2")
    assert (got["b"].archived, got["b"].previous_version) == (0, None)


def test_promotion_event_fields(spark):
    row = RG.promotion_events(runs(spark).filter("run_id = 4"), "lead", F.lit("backups/x")).first()
    assert row.params == {
        "action": "promote_hyperparameters", "backup_key": "backups/x", "source_experiment_id": "4", "promoted_max_depth": "1"
    }


def test_best_row_first_on_ties(spark):
    rows = spark.createDataFrame([(0, 0.5), (1, 0.9), (2, 0.9)], "trial_no int, accuracy double")
    assert RG.best_by(rows, "accuracy", "trial_no").first().trial_no == 1
    assert [r.trial_no for r in RG.top_trials(rows, 2).collect()] == [1, 2]
    assert RG.best_by(rows.limit(0), "accuracy", "trial_no").isEmpty()


def test_merge_keeps_every_column(spark):
    a = spark.createDataFrame([("t", 0.9)], "section string, best double")
    b = spark.createDataFrame([("m", "gbt")], "section string, algorithm string")
    assert sorted(map(tuple, RG.merge_results(a, b).fillna({"best": -1.0, "algorithm": ""}).collect())) == [("m", -1.0, "gbt"), ("t", 0.9, "")]


def test_latest_manifest_breaks_time_ties(spark):
    rows = spark.createDataFrame([("s", 1, 10, "a"), ("s", 2, 10, "b"), ("t", 3, 5, "c")], "stage string, event_id long, ts long, p string")
    assert {r.stage: r.p for r in RG.latest_manifest(rows).collect()} == {"s": "b", "t": "c"}
    assert RG.latest_manifest(rows, "t").first().p == "c"


def test_current_params_feed_an_estimator(spark):
    from riskengine.operators.training import gbt

    hist = spark.createDataFrame([("eta", "0.3", 1), ("eta", "0.4", 2), ("max_depth", "3", 1)], "path string, value string, version long")
    est = gbt(RG.current_params(hist))
    assert (est.eta, est.depth, est.rounds) == (0.4, 3, 150)


def test_promote_writes_valid_runs_and_returns_the_rest(spark):
    from riskengine.plans.promote import promote
    from riskengine.session import work_dir

    good = {"objective": "binary:logistic", "num_round": "9", "max_depth": "3", "eta": "0.1", "subsample": "0.8", "colsample_bytree": "0.8"}
    when = dt.datetime(2024, 1, 1)
    rows = spark.createDataFrame(
        [(1, "e", "gbt", when, good, {"accuracy": 0.9}), (2, "e", "gbt", when, {**good, "eta": "7"}, {"accuracy": 0.9})],
        "run_id long, experiment_name string, algorithm string, created timestamp_ntz, params map<string,string>, metrics map<string,double>",
    )
    out = work_dir(spark, "registry")
    refused = promote(rows, out, "lead").collect()
    assert [(r.run_id, r.reasons) for r in refused] == [(2, ["range:eta"])]
    assert {r.path: r.value for r in spark.read.parquet(f"{out}/params").collect()} == good
    assert spark.read.parquet(f"{out}/configs").count() == spark.read.parquet(f"{out}/events").count() == 1
