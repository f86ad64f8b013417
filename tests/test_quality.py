import json

import pytest
from pyspark.sql import functions as F

from riskengine.operators import quality as Q, projections as P
from riskengine.schemas import CARD_FEATURES

NAN = float("nan")


def cards(spark, n=20):
    cols = [(F.col("id") * (i + 1)).cast("double").alias(c) for i, c in enumerate(CARD_FEATURES)]
    return spark.range(n).select(*cols, (F.col("id") % 2).cast("int").alias("Class"))


def test_missing_counts_nulls_nan_and_other_types(spark):
    rows = spark.createDataFrame([(1.0, "a", None), (NAN, None, 2), (None, "c", 3)], "x double, s string, n int")
    got = {r.column_name: (r.missing, r.total_missing, r.failed) for r in Q.missing_counts(rows).collect()}
    assert got == {"x": (2, 4, True), "s": (1, 4, True), "n": (1, 4, True)}
    assert Q.missing_total(rows).first()[0] == 4


def test_gate_passes_warns_and_raises(spark):
    assert Q.quality_gate(cards(spark), expected=20) == {"rows": 20, "missing": 0}
    with pytest.warns(UserWarning, match="expected 21"):
        Q.quality_gate(cards(spark), expected=21)
    with pytest.raises(ValueError, match="expected 21"):
        Q.quality_gate(cards(spark), expected=21, strict=True)
    with pytest.raises(ValueError, match="missing values"):
        Q.quality_gate(cards(spark).withColumn("V3", F.when(F.col("Time") > 5, F.col("V3"))), expected=20)
    with pytest.raises(ValueError, match="V28"):
        Q.quality_gate(cards(spark).drop("V28"), expected=20)


def test_missing_columns(spark):
    rows = Q.missing_columns(cards(spark).drop("V7", "Amount")).filter("not present").collect()
    assert {r.column_name for r in rows} == {"V7", "Amount"}


GOOD = {"objective": "binary:logistic", "num_round": "150", "max_depth": "7", "eta": "0.15", "subsample": "0.8", "colsample_bytree": "0.8"}


@pytest.mark.parametrize(
    "change, reasons",
    [
        ({}, []),
        ({"eta": "1.0", "max_depth": "20", "num_round": "1000"}, []),
        ({"max_depth": "1", "num_round": "1"}, []),
        ({"eta": "0.0"}, ["range:eta"]),
        ({"eta": "1.01"}, ["range:eta"]),
        ({"max_depth": "0"}, ["range:max_depth"]),
        ({"max_depth": "21"}, ["range:max_depth"]),
        ({"max_depth": "7.5"}, ["type:max_depth"]),
        ({"num_round": "1001"}, ["range:num_round"]),
        ({"subsample": "x"}, ["type:subsample"]),
        ({"subsample": "NaN"}, ["range:subsample"]),
        ({"objective": None}, ["missing:objective"]),
    ],
)
def test_param_rules(spark, change, reasons):
    params = {k: v for k, v in {**GOOD, **change}.items() if v is not None}
    row = Q.validate_params(spark.createDataFrame([(params,)], "params map<string,string>")).first()
    assert row.reasons == reasons and row.valid is (not reasons)


MODEL = {"algorithm": "gbt", "hyperparameters": {"eta": 1}, "performance": {}, "tested_date": "2024-01-01", "approved_by": "x"}


@pytest.mark.parametrize(
    "config, reasons",
    [
        ({"model": MODEL}, []),
        ({}, ["missing:model"]),
        ("not json", ["missing:model"]),
        ({"model": {k: v for k, v in MODEL.items() if k != "tested_date"}}, ["missing:tested_date"]),
        ({"model": {**MODEL, "algorithm": 5}}, ["type:algorithm"]),
        ({"model": {**MODEL, "performance": [1]}}, ["type:performance"]),
        ({"model": {**MODEL, "approved_by": None}}, ["type:approved_by"]),
    ],
)
def test_config_rules(spark, config, reasons):
    text = config if isinstance(config, str) else json.dumps(config)
    row = Q.validate_config(spark.createDataFrame([(text,)], "config string")).first()
    assert row.reasons == reasons and row.valid is (not reasons)


def test_dynamic_threshold_first_rule_wins(spark):
    rows = spark.createDataFrame(
        [(10001.0, True, True), (10000.0, True, True), (5.0, False, True), (5.0, False, False)], "a double, n boolean, g boolean"
    )
    assert [r.threshold for r in P.dynamic_threshold(rows, "a", "n", "g").collect()] == [0.60, 0.70, 0.85, 0.75]


@pytest.mark.parametrize("target", ["Class", "V1", "Amount"])
def test_target_first(spark, target):
    rows = P.target_first(cards(spark), target)
    assert rows.columns[0] == target and sorted(rows.columns) == sorted(cards(spark).columns)
    assert [c for c in rows.columns[1:]] == [c for c in cards(spark).columns if c != target]


def test_retention(spark):
    rows = spark.sql("select explode(sequence(date'2024-01-01', date'2024-04-30')) as d")
    kept = P.retain(rows, "d", 90, "2024-04-30")
    assert kept.count() == 90 and kept.agg(F.min("d")).first()[0].isoformat() == "2024-02-01"


def test_failed_runs_newest_first(spark):
    rows = spark.range(50).select(
        F.col("id").alias("event_id"), F.timestamp_seconds("id").alias("ts"),
        F.when(F.col("id") % 2 == 0, "stage FAILED").otherwise("ok").alias("message"),
    )
    assert [r.event_id for r in P.failed_runs(rows, 3).collect()] == [48, 46, 44]
