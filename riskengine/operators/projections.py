"""Row-wise projections, filters and store lookups. None of them shuffles."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from riskengine.functions import scalars as X
from riskengine.schemas import TARGET


def target_first(df: DataFrame, target: str = TARGET) -> DataFrame:
    return df.select(target, *[c for c in df.columns if c != target])


def clamped(df: DataFrame, score: str, out: str = "score") -> DataFrame:
    return df.withColumn(out, X.clamp_score(F.col(score)))


def banded(df: DataFrame, score: str = "fraud_score") -> DataFrame:
    return df.withColumn("risk_band", X.risk_band(F.col(score)))


def high_risk(df: DataFrame, threshold: float = X.HIGH_RISK, score: str = "fraud_score") -> DataFrame:
    return df.filter(X.is_high(F.col(score), threshold))


def by_batch_date(df: DataFrame, day: str | dt.date) -> DataFrame:
    """One day of the store: a partition-pruned read."""
    return df.filter(F.col("batch_date") == F.lit(str(day)).cast("date"))


def by_batch_date_min_score(df: DataFrame, day: str | dt.date, score: float) -> DataFrame:
    """Partition pruning on the day; files sorted by score let row groups be skipped."""
    return by_batch_date(df, day).filter((F.col("fraud_score") >= score) & ~F.isnan("fraud_score"))


def failed_runs(df: DataFrame, n: int = 20, pattern: str = "FAILED") -> DataFrame:
    """Newest ``n`` matching log lines: a top-k per task, merged, never a full sort."""
    return df.filter(F.col("message").rlike(pattern)).orderBy(F.desc("ts"), F.desc("event_id")).limit(n)


def top_risk(df: DataFrame, n: int = 50, threshold: float = X.HIGH_RISK) -> DataFrame:
    return high_risk(df, threshold).orderBy(F.desc("fraud_score"), "event_id").limit(n)


def dynamic_threshold(df: DataFrame, amount: str, new_customer: str, good_history: str) -> DataFrame:
    return df.withColumn(
        "threshold", X.dynamic_threshold(F.col(amount), F.col(new_customer), F.col(good_history))
    )


def to_scored(df: DataFrame, score: Column, scoring_ms: Column) -> DataFrame:
    """Transaction fields plus a clamped score and the time it was scored."""
    return df.withColumns({"fraud_score": X.clamp_score(score), "scoring_ms": scoring_ms})


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def subset(df: DataFrame, col: str, value, exclude: Sequence[str] = ()) -> DataFrame:
    return df.filter(F.col(col) == value).drop(*exclude)


def retain(df: DataFrame, date_col: str, days: int, as_of: Column | str) -> DataFrame:
    """Rows of the last ``days`` days up to ``as_of``."""
    end = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    day = F.col(date_col).cast("date")
    return df.filter((day > F.date_sub(end, days)) & (day <= end))


def attach_model(df: DataFrame, current: DataFrame) -> DataFrame:
    """Every row with the one current model record, inlined as scalar subqueries."""
    return df.select("*", *[current.select(c).scalar().alias(c) for c in current.columns])
