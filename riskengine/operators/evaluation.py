"""Classifier evaluation over (id, label, score) rows."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskengine.functions.scalars import number, ratio_or_zero
from riskengine.operators.joins import group_join
from riskengine.operators.ranking import BUCKET, LOCAL_POSITION_BITS, cut_points, running_totals, with_buckets
from riskengine.session import parallelism

# Decision border, production and warning accuracy.
DECISION = 0.5
PRODUCTION_ACCURACY = 0.90
WARNING_ACCURACY = 0.80

# Lowest accepted value of each metric.
FULL_GATE = {"accuracy": 0.90, "precision": 0.80, "recall": 0.85, "f1": 0.82, "auc": 0.90}
# Metrics of the model in production.
PRODUCTION_BASELINE = {"accuracy": 0.952, "precision": 0.89, "recall": 0.85, "f1": 0.87, "auc": 0.94}
# Cost of a wrong flag and of a missed fraud.
FALSE_POSITIVE_COST = 10.0
FALSE_NEGATIVE_COST = 500.0
# What a challenger must reach.
SUCCESS_CRITERIA = {"min_accuracy": 0.90, "max_latency_ms": 100.0, "min_improvement_pct": 1.0}


def _usable() -> Column:
    return F.col("label").isNotNull() & number("score").isNotNull()


def valid_rows(df: DataFrame) -> DataFrame:
    """Rows that can be judged: a label, and a score that is a number. The one rule of every metric here."""
    return df.filter(_usable())


def invalid_count(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """How many rows the metrics leave out."""
    return df.groupBy(*by).agg(F.count_if(~_usable()).alias("n_invalid"))


def _positive() -> Column:
    return F.col("label") == 1


def _flagged(threshold: float = DECISION) -> Column:
    return F.col("score") >= threshold


def _with_rates(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 from tp, fp, tn, fn; accuracy null on no rows."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    rates = counts.withColumns(
        {
            "accuracy": F.try_divide((tp + tn).cast("double"), (tp + fp + tn + fn).cast("double")),
            "precision": ratio_or_zero(tp, tp + fp),
            "recall": ratio_or_zero(tp, tp + fn),
        }
    )
    p, r = F.col("precision"), F.col("recall")
    return rates.withColumn("f1", ratio_or_zero(2 * p * r, p + r))


def classification_metrics(df: DataFrame, by: Sequence[str] = (), threshold: float = DECISION) -> DataFrame:
    pos, hit = _positive(), _flagged(threshold)
    return _with_rates(
        valid_rows(df).groupBy(*by).agg(
            F.count_if(pos & hit).alias("tp"),
            F.count_if(~pos & hit).alias("fp"),
            F.count_if(~pos & ~hit).alias("tn"),
            F.count_if(pos & ~hit).alias("fn"),
        )
    )


def confusion_matrix(df: DataFrame) -> DataFrame:
    """All four cells, also the empty ones."""
    one = classification_metrics(df)
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    rows = F.array(
        *[F.struct(F.lit(a).alias("label"), F.lit(p).alias("predicted"), F.col(c).alias("n")) for a, p, c in cells]
    )
    return one.select(F.explode(rows).alias("x")).select("x.*")


def auc_step(df: DataFrame, tie_key: str = "id") -> DataFrame:
    """Step AUC over (score desc, tie key): the share of (positive, negative) pairs
    with the positive first; 0.5 with one class.

    From row places alone: positives' places summed give the pairs. One range
    partitioning; each partition returns three numbers and the offsets do the rest.
    """
    order = [F.col("score").desc(), F.col(tie_key).asc()]
    placed = (
        valid_rows(df).select("score", tie_key, F.col("label").cast("int").alias("label"))
        .repartitionByRange(parallelism(df.sparkSession), *order)
        .sortWithinPartitions(*order)
        .withColumns(
            {
                "part": F.spark_partition_id(),
                "pos": F.monotonically_increasing_id().bitwiseAND(F.lit(LOCAL_POSITION_BITS)) + 1,
            }
        )
    )
    parts = placed.groupBy("part").agg(
        F.count("*").alias("n"),
        F.sum("label").alias("p"),
        F.sum(F.when(F.col("label") == 1, F.col("pos")).otherwise(0)).alias("places"),
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # Decimals from here: over 1e12 rows the sum of all places passes a long.
    total = parts.withColumn("off", F.coalesce(F.sum("n").over(before), F.lit(0))).agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("decimal(20,0)").alias("n"),
        F.coalesce(F.sum("p"), F.lit(0)).cast("decimal(20,0)").alias("p"),
        F.sum(F.col("places").cast("decimal(20,0)")).alias("places"),
        F.sum(F.col("off").cast("decimal(18,0)") * F.col("p").cast("decimal(18,0)")).alias("moved"),
    )
    n, p = F.col("n").cast("double"), F.col("p").cast("double")
    # Negatives after a positive at place r that is the j-th positive: (n - r) - (p - j).
    pairs = p * n - (F.col("places") + F.col("moved")).cast("double") - p * (p - 1) / 2
    return total.select(F.coalesce(F.try_divide(pairs, p * (n - p)), F.lit(0.5)).alias("auc_step"))


def _per_score(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per distinct score with its positives, negatives and value bucket."""
    scores = valid_rows(df).select(*by, F.col("score").cast("double").alias("score"), "label")
    binned = with_buckets(scores, ["score"], cut_points(scores, ["score"]))
    return (
        binned.withColumnRenamed("score" + BUCKET, BUCKET)
        .groupBy(*by, BUCKET, "score")
        .agg(F.count_if(_positive()).alias("p"), F.count_if(~_positive()).alias("q"))
    )


def auc_roc(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """ROC AUC with ties counted half; null with one class.

    Pairs are counted inside each value bucket, then between buckets on one row per bucket.
    """
    by = list(by)
    below = Window.partitionBy(*by, BUCKET).orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    inside = _per_score(df, by).withColumn(
        "u", F.col("p") * (F.coalesce(F.sum("q").over(below), F.lit(0)) + F.col("q") / 2)
    )
    buckets = inside.groupBy(*by, BUCKET).agg(F.sum("u").alias("u"), F.sum("p").alias("p"), F.sum("q").alias("q"))
    lower = Window.partitionBy(*by).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    pairs = buckets.withColumn(
        "u", F.col("u") + F.col("p").cast("double") * F.coalesce(F.sum("q").over(lower), F.lit(0))
    )
    return pairs.groupBy(*by).agg(
        F.try_divide(F.sum("u"), F.sum("p").cast("double") * F.sum("q").cast("double")).alias("auc")
    )


def _curve(df: DataFrame) -> DataFrame:
    """True and false positives when flagging every score at or above each distinct score."""
    return running_totals(_per_score(df), "score", {"tp": "p", "fp": "q"}, descending=True)


def roc_curve(df: DataFrame) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score, starting from (inf, 0, 0)."""
    points = _curve(df).select(
        F.col("score").alias("threshold"),
        ratio_or_zero(F.col("fp"), F.col("fp_total")).alias("fpr"),
        ratio_or_zero(F.col("tp"), F.col("tp_total")).alias("tpr"),
    )
    start = df.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(start)


def pr_curve(df: DataFrame) -> DataFrame:
    """(threshold, precision, recall) per distinct score, ending in (null, 1, 0)."""
    points = _curve(df).select(
        F.col("score").alias("threshold"),
        ratio_or_zero(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        ratio_or_zero(F.col("tp"), F.col("tp_total")).alias("recall"),
    )
    end = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return points.unionByName(end)


def gate(metrics: DataFrame) -> DataFrame:
    return metrics.withColumns(
        {
            "meets_production": F.col("accuracy") >= PRODUCTION_ACCURACY,
            "low_accuracy": F.col("accuracy") < WARNING_ACCURACY,
        }
    )


def gate_full(metrics: DataFrame, limits: Mapping[str, float] = FULL_GATE) -> DataFrame:
    passed = {f"{m}_ok": F.coalesce(F.col(m) >= v, F.lit(False)) for m, v in limits.items()}
    every = F.lit(True)
    for name in passed:
        every = every & F.col(name)
    return metrics.withColumns(passed).withColumn("all_ok", every)


def threshold_sweep(df: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """TPR, FPR and precision at each threshold.

    Rows are counted by how many thresholds they reach (at most T + 1 groups); a
    threshold's counts are the sum of the groups from it upward.
    """
    ts = sorted(thresholds)
    reached = sum((F.when(F.col("score") >= t, 1).otherwise(0) for t in ts), F.lit(0))
    groups = valid_rows(df).groupBy(reached.alias("k")).agg(
        F.count_if(_positive()).alias("p"), F.count_if(~_positive()).alias("q")
    )
    one = groups.agg(
        F.coalesce(F.sum("p"), F.lit(0)).alias("p"),
        F.coalesce(F.sum("q"), F.lit(0)).alias("q"),
        *[F.coalesce(F.sum(F.when(F.col("k") > i, F.col("p"))), F.lit(0)).alias(f"tp{i}") for i in range(len(ts))],
        *[F.coalesce(F.sum(F.when(F.col("k") > i, F.col("q"))), F.lit(0)).alias(f"fp{i}") for i in range(len(ts))],
    )
    cells = F.array(
        *[
            F.struct(F.lit(float(t)).alias("threshold"), F.col(f"tp{i}").alias("tp"), F.col(f"fp{i}").alias("fp"))
            for i, t in enumerate(ts)
        ]
    )
    rows = one.select("p", "q", F.explode(cells).alias("x")).select("x.*", "p", "q")
    return rows.select(
        "threshold",
        "tp",
        "fp",
        (F.col("p") - F.col("tp")).alias("fn"),
        (F.col("q") - F.col("fp")).alias("tn"),
        ratio_or_zero(F.col("tp"), F.col("p")).alias("tpr"),
        ratio_or_zero(F.col("fp"), F.col("q")).alias("fpr"),
        ratio_or_zero(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
    )


def threshold_cost(
    df: DataFrame, thresholds: Sequence[float], fp_cost: float = FALSE_POSITIVE_COST, fn_cost: float = FALSE_NEGATIVE_COST
) -> DataFrame:
    """Cost at each threshold and the cheapest one; the lowest threshold wins a tie."""
    costs = threshold_sweep(df, thresholds).select(
        "threshold", "fp", "fn", (F.col("fp") * fp_cost + F.col("fn") * fn_cost).alias("cost")
    )
    best = F.min(F.struct("cost", "threshold")).over(Window.partitionBy())  # one row per threshold
    return costs.withColumn("is_best", F.col("threshold") == best["threshold"])


def f_beta(metrics: DataFrame, betas: Mapping[str, float]) -> DataFrame:
    p, r = F.col("precision"), F.col("recall")
    return metrics.withColumns(
        {name: ratio_or_zero((1 + b * b) * p * r, b * b * p + r) for name, b in betas.items()}
    )


def metrics_by(df: DataFrame, group: str = "algorithm") -> DataFrame:
    return group_join(classification_metrics(df, [group]), auc_roc(df, [group]), [group], "left")


def metrics_with_auc(df: DataFrame) -> DataFrame:
    """One row: counts, rates and both AUCs."""
    return classification_metrics(df).select(
        "*", auc_roc(df).scalar().alias("auc"), auc_step(df).scalar().alias("auc_step")
    )


def metric_rows(metrics: DataFrame, names: Sequence[str] = tuple(PRODUCTION_BASELINE)) -> DataFrame:
    """One wide metric row to (metric, value) rows."""
    return metrics.unpivot([], list(names), "metric", "value")


def baseline_rows(spark, baseline: Mapping[str, float] = PRODUCTION_BASELINE) -> DataFrame:
    pairs = F.map_from_arrays(
        F.array(*[F.lit(m) for m in baseline]), F.array(*[F.lit(float(v)) for v in baseline.values()])
    )
    return spark.range(1).select(F.explode(pairs).alias("metric", "value"))


def compare_to_baseline(current: DataFrame, baseline: DataFrame) -> DataFrame:
    """Metrics both sides have, with the change; percent 0 on a zero baseline."""
    joined = current.withColumnRenamed("value", "current").join(
        baseline.withColumnRenamed("value", "baseline"), "metric"
    )
    change = F.col("current") - F.col("baseline")
    return joined.select(
        "metric",
        "current",
        "baseline",
        change.alias("difference"),
        ratio_or_zero(change * 100, F.col("baseline")).alias("percent_change"),
        (change > 0).alias("improved"),
    )


def evaluate(df: DataFrame, baseline: Mapping[str, float] = PRODUCTION_BASELINE, warn: bool = False) -> DataFrame:
    """Full report in one row: counts, metrics, gates and change against the baseline."""
    row = gate_full(gate(metrics_with_auc(df)))
    row = row.withColumns({f"{m}_change": F.col(m) - F.lit(float(v)) for m, v in baseline.items()})
    if warn and row.select("low_accuracy").first()[0]:
        warnings.warn(f"accuracy below {WARNING_ACCURACY}", stacklevel=2)
    return row


def join_pred_actual(pred: DataFrame, actual: DataFrame, key: str = "id") -> DataFrame:
    """Predictions and labels of the same record, by key."""
    return actual.join(pred, key)


def accuracy_by_day(df: DataFrame, day: str = "batch_date") -> DataFrame:
    """(day, judged, correct): rows that can be judged per day, and how many of them the score puts right."""
    right = _flagged() == _positive()
    return valid_rows(df).groupBy(day).agg(F.count("*").alias("judged"), F.count_if(right).alias("correct"))


def ab_verdict(
    champion: DataFrame, challenger: DataFrame, p95_ms: Column, key: str = "id",
    limits: Mapping[str, float] = SUCCESS_CRITERIA,
) -> DataFrame:
    """Whether the challenger may replace the champion, in one row.

    Both accuracies are over the records that both arms scored with a number and that have a
    label. ``p95_ms`` is the challenger's latency; the improvement is in percent of the
    champion's accuracy. A criterion that cannot be judged is not met.
    """
    a, b = F.col("a"), F.col("b")
    both = champion.select(key, "label", F.col("score").alias("a")).join(
        challenger.select(key, F.col("score").alias("b")), key
    )
    both = both.filter(F.col("label").isNotNull() & number("a").isNotNull() & number("b").isNotNull())

    def share(cond: Column) -> Column:
        return F.avg(F.when(cond, 1.0).otherwise(0.0))

    one = both.agg(
        F.count("*").alias("n"),
        share((a >= DECISION) == _positive()).alias("champion_accuracy"),
        share((b >= DECISION) == _positive()).alias("challenger_accuracy"),
        share((a >= DECISION) == (b >= DECISION)).alias("agreement"),
    )
    old, new = F.col("champion_accuracy"), F.col("challenger_accuracy")
    one = one.withColumns({"improvement_pct": F.try_divide((new - old) * 100, old), "p95_ms": p95_ms})
    met = {
        "accuracy_ok": new >= limits["min_accuracy"],
        "latency_ok": F.col("p95_ms") <= limits["max_latency_ms"],
        "improvement_ok": F.col("improvement_pct") >= limits["min_improvement_pct"],
    }
    judged = one.withColumns({name: F.coalesce(ok, F.lit(False)) for name, ok in met.items()})
    return judged.withColumn("passed", F.col("accuracy_ok") & F.col("latency_ok") & F.col("improvement_ok"))


def compare_arms(champion: DataFrame, challenger: DataFrame, key: str = "id") -> DataFrame:
    """Two scorers on the same records: mean absolute difference and agreement at 0.5.

    Records that either arm left without a number are not compared.
    """
    a, b = F.col("a"), F.col("b")
    both = champion.select(key, F.col("score").alias("a")).join(challenger.select(key, F.col("score").alias("b")), key)
    both = both.filter(number("a").isNotNull() & number("b").isNotNull())
    return both.agg(
        F.count("*").alias("n"),
        F.avg("a").alias("avg_champion"),
        F.avg("b").alias("avg_challenger"),
        F.avg(F.abs(a - b)).alias("mean_abs_diff"),
        F.avg(F.when((a >= DECISION) == (b >= DECISION), 1.0).otherwise(0.0)).alias("agreement"),
    )
