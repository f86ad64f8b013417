import random

import pytest
from pyspark.sql import functions as F

from riskengine.operators import evaluation as E

# At 0.5: 0.99, 0.95, 0.7, 0.55 are rightly flagged, 0.62 and 0.5 wrongly, 0.35 is missed.
HAND_Y = [1, 0, 1, 1, 0, 0, 1, 0, 0, 1]
HAND_P = [0.95, 0.62, 0.55, 0.35, 0.05, 0.45, 0.7, 0.25, 0.5, 0.99]


def frame(spark, labels, scores):
    return spark.createDataFrame(
        [(i, int(y), float(p)) for i, (y, p) in enumerate(zip(labels, scores))], "id long, label int, score double"
    )


def pairs_auc(labels, scores):
    pos = [s for y, s in zip(labels, scores) if y == 1]
    neg = [s for y, s in zip(labels, scores) if y == 0]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


def loop_auc(labels, scores):
    rows = sorted(zip(scores, range(len(labels)), labels), key=lambda r: (-r[0], r[1]))
    tp = area = 0
    for _, _, y in rows:
        if y:
            tp += 1
        else:
            area += tp
    return area / (sum(labels) * (len(labels) - sum(labels)))


def test_rows_worked_out_by_hand(spark):
    row = E.metrics_with_auc(frame(spark, HAND_Y, HAND_P)).first()
    assert (row.tp, row.fp, row.tn, row.fn) == (4, 2, 3, 1)
    assert (row.accuracy, row.precision, row.recall, row.f1) == pytest.approx((0.7, 2 / 3, 0.8, 8 / 11))
    assert row.auc == pytest.approx(pairs_auc(HAND_Y, HAND_P))


@pytest.mark.parametrize("seed", range(4))
def test_aucs_against_brute_force(spark, seed):
    rng = random.Random(seed)
    labels = [int(rng.random() < 0.3) for _ in range(400)] + [0, 1]
    scores = [1.0 if rng.random() < 0.33 else round(rng.random(), 2) for _ in labels]
    rows = frame(spark, labels, scores)
    assert E.auc_roc(rows).first()[0] == pytest.approx(pairs_auc(labels, scores), abs=1e-12)
    want = loop_auc(labels, scores)
    for parts in (1, 7):
        assert E.auc_step(rows.repartition(parts)).first()[0] == pytest.approx(want, abs=1e-12)


def test_one_class(spark):
    rows = frame(spark, [0, 0, 0], [0.1, 0.9, 0.5])
    assert E.auc_step(rows).first()[0] == 0.5
    assert E.auc_roc(rows).first()[0] is None
    row = E.classification_metrics(rows).first()
    assert (row.precision, row.recall, row.f1) == (0.0, 0.0, 0.0)


def test_no_rows(spark):
    row = E.classification_metrics(frame(spark, [], [])).first()
    assert row.accuracy is None and row.f1 == 0.0
    assert [r.n for r in E.confusion_matrix(frame(spark, [], [])).collect()] == [0, 0, 0, 0]


def test_confusion_keeps_empty_cells(spark):
    got = {(r.label, r.predicted): r.n for r in E.confusion_matrix(frame(spark, [1, 1], [0.9, 0.8])).collect()}
    assert got == {(0, 0): 0, (0, 1): 0, (1, 0): 0, (1, 1): 2}


def test_threshold_is_inclusive(spark):
    row = E.classification_metrics(frame(spark, [1, 0], [0.5, 0.4999])).first()
    assert (row.tp, row.tn) == (1, 1)


def test_curves(spark):
    rows = frame(spark, HAND_Y, HAND_P)
    roc = sorted((r.fpr, r.tpr) for r in E.roc_curve(rows).collect())
    assert roc[0] == (0.0, 0.0) and roc[-1] == (1.0, 1.0) and len(roc) == 11
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(roc, roc[1:]))
    assert area == pytest.approx(pairs_auc(HAND_Y, HAND_P))
    pr = E.pr_curve(rows).collect()
    last = [r for r in pr if r.threshold is None]
    assert [(r.precision, r.recall) for r in last] == [(1.0, 0.0)]
    assert max(r.recall for r in pr) == 1.0


def test_sweep_against_brute_force(spark):
    ts = [0.0, 0.15, 0.5, 0.9, 0.95]
    got = {r.threshold: (r.tp, r.fp, r.fn, r.tn) for r in E.threshold_sweep(frame(spark, HAND_Y, HAND_P), ts).collect()}
    for t in ts:
        hit = [p >= t for p in HAND_P]
        want = tuple(
            sum(1 for y, h in zip(HAND_Y, hit) if (y, h) == cell) for cell in ((1, True), (0, True), (1, False), (0, False))
        )
        assert got[t] == want


def test_cheapest_threshold(spark):
    rows = E.threshold_cost(frame(spark, HAND_Y, HAND_P), [0.1, 0.3, 0.7]).collect()
    assert {r.threshold: r.cost for r in rows} == {0.1: 40.0, 0.3: 30.0, 0.7: 1000.0}
    assert [r.threshold for r in rows if r.is_best] == [0.3]


def test_baseline_comparison(spark):
    current = spark.createDataFrame([("accuracy", 0.96), ("only_here", 1.0), ("zero", 0.5)], "metric string, value double")
    base = E.baseline_rows(spark, {"accuracy": 0.95, "zero": 0.0, "only_there": 1.0})
    got = {r.metric: r for r in E.compare_to_baseline(current, base).collect()}
    assert set(got) == {"accuracy", "zero"}
    assert got["accuracy"].improved and got["accuracy"].percent_change == pytest.approx(1.0526, abs=1e-3)
    assert got["zero"].percent_change == 0.0


def test_gates(spark):
    rows = spark.createDataFrame(
        [(0.90, 0.80, 0.85, 0.82, 0.90), (0.899, 0.9, 0.9, 0.9, 0.9), (0.79, 0.0, 0.0, 0.0, None)],
        "accuracy double, precision double, recall double, f1 double, auc double",
    )
    got = [(r.meets_production, r.low_accuracy, r.all_ok) for r in E.gate_full(E.gate(rows)).collect()]
    assert got == [(True, False, True), (False, False, False), (False, True, False)]


def test_low_accuracy_warns(spark):
    with pytest.warns(UserWarning):
        E.evaluate(frame(spark, [1, 1, 0], [0.1, 0.2, 0.3]), warn=True)


def test_documented_f1(spark):
    row = spark.createDataFrame([(0.95, 0.60)], "precision double, recall double")
    got = E.f_beta(row, {"f1": 1.0, "f2": 2.0}).first()
    assert got.f1 == pytest.approx(0.7355, abs=1e-3) and got.f2 < got.f1


def test_arm_comparison(spark):
    a, b = frame(spark, [0, 1], [0.2, 0.9]), frame(spark, [0, 1], [0.4, 0.3])
    row = E.compare_arms(a, b).first()
    assert (row.n, row.agreement) == (2, 0.5) and row.mean_abs_diff == pytest.approx(0.4)


def test_ab_verdict(spark):
    old = spark.createDataFrame([(i, i % 2, 0.9 if i != 1 else 0.1) for i in range(20)], "id long, label int, score double")
    new = spark.createDataFrame([(i, 0.9 if i % 2 else 0.1) for i in range(19)] + [(19, float("nan"))], "id long, score double")
    row = E.ab_verdict(old, new, F.lit(80.0)).first()
    assert (row.n, row.challenger_accuracy, row.champion_accuracy) == (19, 1.0, pytest.approx(8 / 19))
    assert row.improvement_pct == pytest.approx(137.5) and row.passed
    slow = E.ab_verdict(old, new, F.lit(100.5)).first()
    assert (slow.accuracy_ok, slow.latency_ok, slow.passed) == (True, False, False)
    nothing = E.ab_verdict(old.limit(0), new, F.lit(None).cast("double")).first()
    assert (nothing.n, nothing.accuracy_ok, nothing.latency_ok, nothing.improvement_ok, nothing.passed) == (0, False, False, False, False)
