"""Daily risk summaries, alert batches, the trailing baseline and drift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskengine.functions import scalars as X
from riskengine.operators.ranking import (
    cell_counts,
    cut_points,
    fine_buckets,
    rank_in_group,
    values_in_cells,
    with_buckets,
)
from riskengine.session import checkpointed

ALERT_CHUNK = 100
BASELINE_DAYS = 30
AVG_SCORE_DRIFT = 0.1
HIGH_RISK_DRIFT = 0.05
BOARD_ACCURACY = 0.95


def risk_summary(df: DataFrame, by: Sequence[str] = ("batch_date",), score: str = "fraud_score") -> DataFrame:
    """Band counts, total and mean score per batch; with no ``by``, zeros on no rows.

    Rows with a null or NaN score are in the total, in no band and not in the mean.
    """
    s = X.number(score)
    return df.groupBy(*by).agg(
        F.count("*").alias("total"),
        F.count_if(X.is_high(s)).alias("high"),
        F.count_if(X.is_medium(s)).alias("medium"),
        F.count_if(X.is_low(s)).alias("low"),
        F.coalesce(F.avg(s), F.lit(0.0)).alias("avg_score"),
    )


def risk_pct(summary: DataFrame) -> DataFrame:
    return summary.withColumns({f"{b}_pct": X.ratio_or_zero(F.col(b), F.col("total")) for b in ("high", "medium", "low")})


def filled_days(summary: DataFrame, first: str, last: str, day: str = "batch_date") -> DataFrame:
    """One row per calendar day from ``first`` to ``last``; a day without rows has zeros."""
    ends = [F.lit(d).cast("date") for d in (first, last)]
    days = summary.sparkSession.range(1).select(F.explode(F.sequence(*ends)).alias(day))
    return days.join(summary, day, "left").na.fill(0)


def load_totals(df: DataFrame, by: Sequence[str] = ("batch_date",), stored: str = "stored") -> DataFrame:
    """Rows stored and not stored per batch; whatever is not a success is an error."""
    return df.groupBy(*by).agg(
        F.count("*").alias("total"), F.count_if(F.col(stored)).alias("success_count")
    ).withColumn("error_count", F.col("total") - F.col("success_count"))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row per key. The rank filter is applied per task before the shuffle too,
    so copies of a hot key do not meet in one task."""
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") == 1).drop("_rn")


def alert_chunks(df: DataFrame, size: int = ALERT_CHUNK, by: str = "batch_date", key: str = "event_id") -> DataFrame:
    """High-risk rows numbered per batch by (score desc, key) and cut in chunks of ``size``."""
    ranked = rank_in_group(
        df.filter(X.is_high(F.col("fraud_score"))), [by], [F.col("fraud_score").desc(), F.col(key).asc()]
    )
    return ranked.withColumn("chunk", F.floor((F.col("rn") - 1) / size))


def alert_summary(df: DataFrame, size: int = ALERT_CHUNK, by: str = "batch_date") -> DataFrame:
    """High-risk rows and alert batches per day, zeros for a day without any.

    Alerts sent equal the high-risk rows here: a written table has no partial delivery.
    """
    high = df.groupBy(by).agg(F.count_if(X.is_high(F.col("fraud_score"))).alias("high_risk_count"))
    return high.select(
        by,
        "high_risk_count",
        F.col("high_risk_count").alias("alerts_sent"),
        F.ceil(F.col("high_risk_count") / size).alias("alert_batches"),
    )


def alert_messages(chunks: DataFrame, by: str = "batch_date", key: str = "transaction_id") -> DataFrame:
    """One message per chunk. A chunk has at most ``ALERT_CHUNK`` rows, so lists stay small."""
    # Fixed text: the published alert layout.
    line = F.format_string(
        "  - ID: %s\n    Amount: $%.2f\n    Fraud Score: %.4f\n    Timestamp: %d\n    Merchant: %s\n\n",
        key, "amount", "fraud_score", "timestamp_ms", "merchant_category",
    )
    lines = F.sort_array(F.collect_list(F.struct("rn", line.alias("line"))))
    head = F.format_string(
        "High-Risk Fraud Transactions Detected\nBatch Date: %s\nCount: %d\n\nTransactions:\n",
        F.col(by).cast("string"), F.col("n"),
    )
    grouped = chunks.groupBy(by, "chunk").agg(F.count("*").alias("n"), lines.alias("lines"))
    return grouped.select(
        by,
        F.col("chunk").alias("batch_index"),
        F.col("n").alias("size"),
        F.format_string("Fraud Alert: %d High-Risk Transactions Detected", F.col("n")).alias("subject"),
        F.concat(head, F.array_join(F.transform("lines", lambda x: x["line"]), "")).alias("message"),
    )


def _day_number(col: Column) -> Column:
    return F.unix_date(col)


def trailing_baseline(daily: DataFrame, days: int = BASELINE_DAYS) -> DataFrame:
    """Unweighted means over the ``days`` calendar days before each day, 0.0 without history.

    One row per day reaches the window, so its single partition is the calendar.
    """
    before = Window.orderBy(_day_number(F.col("batch_date"))).rangeBetween(-days, -1)
    return daily.withColumns(
        {
            "baseline_score": F.coalesce(F.avg("avg_score").over(before), F.lit(0.0)),
            "baseline_high_pct": F.coalesce(F.avg("high_pct").over(before), F.lit(0.0)),
            "baseline_days": F.count("*").over(before),
        }
    )


def baseline_range_join(daily: DataFrame, days: int = BASELINE_DAYS) -> DataFrame:
    """The same baseline as an equi-join: each day offers itself to the days after it."""
    offered = daily.select(
        F.explode(F.sequence(F.date_add("batch_date", 1), F.date_add("batch_date", days))).alias("batch_date"),
        F.col("avg_score").alias("_s"),
        F.col("high_pct").alias("_h"),
    )
    means = offered.groupBy("batch_date").agg(
        F.avg("_s").alias("_bs"), F.avg("_h").alias("_bh"), F.count("*").alias("_n")
    )
    return daily.join(means, "batch_date", "left").select(
        *daily.columns,
        F.coalesce("_bs", F.lit(0.0)).alias("baseline_score"),
        F.coalesce("_bh", F.lit(0.0)).alias("baseline_high_pct"),
        F.coalesce("_n", F.lit(0)).alias("baseline_days"),
    )


def drift(daily: DataFrame, score_limit: float = AVG_SCORE_DRIFT, high_limit: float = HIGH_RISK_DRIFT) -> DataFrame:
    """Distance of each day from its baseline; strictly above a limit is drift."""
    moved = trailing_baseline(daily).withColumns(
        {
            "avg_score_drift": F.abs(F.col("avg_score") - F.col("baseline_score")),
            "high_risk_drift": F.abs(F.col("high_pct") - F.col("baseline_high_pct")),
        }
    )
    return moved.withColumn(
        "drift_detected", (F.col("avg_score_drift") > score_limit) | (F.col("high_risk_drift") > high_limit)
    )


def daily_drift(scored: DataFrame) -> DataFrame:
    """Scored rows to one drift row per day."""
    return drift(risk_pct(risk_summary(scored)))


def drift_alerts(drifted: DataFrame) -> DataFrame:
    """Subject and message of every day that drifted."""
    # Fixed text: the published drift alert layout.
    body = F.format_string(
        "Model Distribution Drift Detected\nBatch Date: %s\n\n"
        "Average Fraud Score:\n  Current: %.4f\n  Baseline: %.4f\n  Drift: %.4f (threshold: 0.1)\n\n"
        "High Risk Percentage:\n  Current: %.2f%%\n  Baseline: %.2f%%\n  Drift: %.4f (threshold: 0.05)\n\n"
        "Action Required:\n  - Review model performance\n  - Consider retraining if drift persists\n"
        "  - Investigate data quality issues\n",
        F.col("batch_date").cast("string"),
        F.col("avg_score"), F.col("baseline_score"), F.col("avg_score_drift"),
        F.col("high_pct") * 100, F.col("baseline_high_pct") * 100, F.col("high_risk_drift"),
    )
    return drifted.filter("drift_detected").select(
        "batch_date",
        F.concat(F.lit("Model Drift Detected: "), F.col("batch_date").cast("string")).alias("subject"),
        body.alias("message"),
        "avg_score_drift",
        "high_risk_drift",
    )


def ks_two_sample(df: DataFrame, cols: Sequence[str], is_recent: Column, alpha: float = 0.05) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov distance per feature with its asymptotic p-value.

    Bucket counts give the exact gap at every bucket border, and with it the largest gap
    a bucket can hide. Only buckets that could beat the best border are ordered by value,
    so the result is exact while most rows are only counted.
    """
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in cols], is_recent.cast("int").alias("_recent"))
    cuts = cut_points(wide, cols, fine_buckets(df.sparkSession))
    binned = with_buckets(wide.filter(F.col("_recent").isNotNull()), cols, cuts)
    per_bucket = cell_counts(binned, cols, ["_recent"]).groupBy("feature", "cell").agg(
        F.sum(F.when(F.col("_recent") == 0, F.col("n")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("_recent") == 1, F.col("n")).otherwise(0)).alias("b"),
    )
    feature = Window.partitionBy("feature")  # one row per bucket
    before = feature.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    borders = per_bucket.withColumns(
        {
            "a0": F.coalesce(F.sum("a").over(before), F.lit(0)),
            "b0": F.coalesce(F.sum("b").over(before), F.lit(0)),
            "na": F.sum("a").over(feature),
            "nb": F.sum("b").over(feature),
        }
    )

    def share(part: str, whole: str) -> Column:
        return F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double"))

    gap = share("a0", "na") - share("b0", "nb")
    borders = borders.withColumn("at_border", F.abs(gap)).withColumns(
        {
            "best": F.max("at_border").over(feature),
            "reach": F.greatest(gap + share("a", "na"), share("b", "nb") - gap),
        }
    )
    borders = checkpointed(borders)
    # A little slack keeps rounding from dropping the bucket that holds the maximum.
    open_buckets = borders.filter(F.col("reach") >= F.col("best") * (1 - 1e-9) - 1e-15)
    per_value = values_in_cells(
        binned, cols, open_buckets, keep=["_recent"],
        a=F.count_if(F.col("_recent") == 0), b=F.count_if(F.col("_recent") == 1),
    )
    inside = Window.partitionBy("cell").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    run = per_value.select("cell", F.sum("a").over(inside).alias("ra"), F.sum("b").over(inside).alias("rb"))
    placed = run.join(open_buckets.select("feature", "cell", "a0", "b0", "na", "nb"), "cell")
    moved = placed.withColumns({"ra": F.col("ra") + F.col("a0"), "rb": F.col("rb") + F.col("b0")})
    found = moved.groupBy("feature").agg(F.max(F.abs(share("ra", "na") - share("rb", "nb"))).alias("inner_gap"))
    at_borders = borders.groupBy("feature").agg(
        F.first("na").alias("n_baseline"), F.first("nb").alias("n_recent"), F.max("at_border").alias("border_gap")
    )
    stat = at_borders.join(found, "feature", "left").select(
        "feature", "n_baseline", "n_recent", F.greatest("border_gap", "inner_gap").alias("statistic")
    )
    size = F.col("n_baseline") * F.col("n_recent") / (F.col("n_baseline") + F.col("n_recent"))
    lam = F.sqrt(size) * F.col("statistic")
    terms = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(F.lit(-2.0) * k * k * lam * lam),
    )
    # Below 0.2 the alternating series has not settled after 100 terms; its limit is 1.
    p = F.when(lam < 0.2, F.lit(1.0)).otherwise(F.least(F.greatest(terms, F.lit(0.0)), F.lit(1.0)))
    return stat.withColumn("p_value", p).withColumn("drifted", F.col("p_value") < alpha)


def monitor_board(
    daily: DataFrame, days: int = 7, baseline: int = BASELINE_DAYS, accuracy: DataFrame | None = None
) -> DataFrame:
    """Row-weighted score and high-risk share of the last ``days`` days against the
    ``baseline`` days before them, with the change.

    With ``accuracy`` (batch_date, judged, correct) there is a line for it, null without
    judged rows, and a column ``alert``: recent accuracy below 95 %.
    """
    if accuracy is not None:
        daily = daily.join(accuracy, "batch_date", "left")  # one row per day on both sides
    last = daily.agg(F.max("batch_date").alias("d")).scalar()
    age = F.datediff(last, F.col("batch_date"))
    recent, past = age < days, (age >= days) & (age < days + baseline)

    def total(cond: Column, value: Column) -> Column:
        return F.sum(F.when(cond, value))

    sums = daily.agg(
        total(recent, F.col("total")).alias("rn"),
        total(recent, F.col("avg_score") * F.col("total")).alias("rs"),
        total(recent, F.col("high")).alias("rh"),
        total(past, F.col("total")).alias("bn"),
        total(past, F.col("avg_score") * F.col("total")).alias("bs"),
        total(past, F.col("high")).alias("bh"),
        *[
            total(when, F.col(c)).alias(f"{c}_{name}")
            for c in (("judged", "correct") if accuracy is not None else ())
            for name, when in (("recent", recent), ("past", past))
        ],
    )
    lines = []
    if accuracy is not None:
        lines.append(
            F.struct(
                F.lit("accuracy").alias("metric"),
                F.try_divide("correct_recent", "judged_recent").alias("recent"),
                F.try_divide("correct_past", "judged_past").alias("baseline"),
            )
        )
    one = sums.select(
        F.array(
            F.struct(
                F.lit("avg_fraud_score").alias("metric"),
                X.ratio_or_zero(F.col("rs"), F.col("rn")).alias("recent"),
                X.ratio_or_zero(F.col("bs"), F.col("bn")).alias("baseline"),
            ),
            F.struct(
                F.lit("high_risk_pct").alias("metric"),
                X.ratio_or_zero(F.col("rh"), F.col("rn")).alias("recent"),
                X.ratio_or_zero(F.col("bh"), F.col("bn")).alias("baseline"),
            ),
            *lines,
        ).alias("m")
    )
    board = one.select(F.explode("m").alias("m")).select(
        "m.*", (F.col("m.recent") - F.col("m.baseline")).alias("change")
    )
    if accuracy is None:
        return board
    low = (F.col("metric") == "accuracy") & (F.col("recent") < BOARD_ACCURACY)
    return board.withColumn("alert", F.coalesce(low, F.lit(False)))
