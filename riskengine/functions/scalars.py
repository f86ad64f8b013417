"""Column expressions shared by the operators. All stay inside codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

HIGH_RISK = 0.8
MEDIUM_RISK = 0.5


def number(col: str | Column) -> Column:
    """A numeric column as double with NaN as null: NaN would sort above and compare greater than every number."""
    return F.nanvl((F.col(col) if isinstance(col, str) else col).cast("double"), F.lit(None).cast("double"))


def stable_hash(seed: int | str, *key: Column | str) -> Column:
    """32-bit hash of a row key as BIGINT; equal on every run and partitioning."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(k) if isinstance(k, str) else k for k in key])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def stable_unit(seed: int | str, *key: Column | str) -> Column:
    """The same hash scaled to [0, 1)."""
    return stable_hash(seed, *key) / F.lit(4294967296.0)


def clamp_score(score: Column) -> Column:
    """Scores outside [0, 1] move to the nearer end; null and NaN stay for quarantine."""
    return F.when(score < 0.0, F.lit(0.0)).when((score > 1.0) & ~F.isnan(score), F.lit(1.0)).otherwise(score)


def valid_score(score: Column) -> Column:
    return score.isNotNull() & ~F.isnan(score) & score.between(0.0, 1.0)


def is_high(score: Column, threshold: float = HIGH_RISK) -> Column:
    # NaN compares above every number in Spark, hence the guard.
    return ~F.isnan(score) & (score >= F.lit(threshold))


def is_medium(score: Column) -> Column:
    return (score >= F.lit(MEDIUM_RISK)) & (score < F.lit(HIGH_RISK))


def is_low(score: Column) -> Column:
    return score < F.lit(MEDIUM_RISK)


def risk_band(score: Column) -> Column:
    return (
        F.when(is_high(score), F.lit("high"))
        .when(is_medium(score), F.lit("medium"))
        .when(is_low(score), F.lit("low"))
    )


def dynamic_threshold(amount: Column, new_customer: Column, good_history: Column) -> Column:
    """Decision threshold of one row; the first matching rule wins."""
    return (
        F.when(amount > 10000, F.lit(0.60))
        .when(new_customer, F.lit(0.70))
        .when(good_history, F.lit(0.85))
        .otherwise(F.lit(0.75))
    )


def ratio_or_zero(num: Column, den: Column) -> Column:
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def tolerant_double(text: Column, default: float = 0.0) -> Column:
    return F.coalesce(F.trim(text).try_cast("double"), F.lit(default))


def tolerant_label(text: Column) -> Column:
    return F.coalesce(F.trim(text).try_cast("double").try_cast("int"), F.lit(0))


def is_missing(name: str, dtype: str) -> Column:
    """Null, or NaN for the types that have it."""
    col = F.col(f"`{name}`")
    return col.isNull() | F.isnan(col) if dtype in ("double", "float") else col.isNull()


def feature_array(features: Column, names: Sequence[str]) -> Column:
    """Map values in the order of ``names``; a missing name gives null."""
    return F.array(*[F.try_element_at(features, F.lit(n)) for n in names])


def feature_payload(features: Column, names: Sequence[str]) -> Column:
    return F.array_join(F.transform(feature_array(features, names), lambda v: v.cast("string")), ",", "")


def error_text(kind: Column, message: Column, cause_kind: Column, cause: Column) -> Column:
    """``Type: message (caused by Type: message)``; the cause only when there is one."""
    none = F.lit("No error message")
    tail = F.when(
        cause_kind.isNotNull(),
        F.concat(F.lit("(caused by "), cause_kind, F.lit(": "), F.coalesce(cause, none), F.lit(")")),
    )
    return F.concat_ws(" ", F.concat(kind, F.lit(": "), F.coalesce(message, none)), tail)


def run_id(algorithm: Column, created: Column, key: Column) -> Column:
    """Experiment id ``algorithm-yyyyMMdd-HHmmss-xxxxxxxx``; the tail is a hash of the key,
    so a repeated job names a run the same way."""
    tail = F.substring(F.md5(key.cast("string")), 1, 8)
    return F.concat_ws("-", algorithm, F.date_format(created, "yyyyMMdd-HHmmss"), tail)
