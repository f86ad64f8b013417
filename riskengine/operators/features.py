"""Derived features and univariate selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from riskengine.functions.scalars import feature_array, feature_payload


def time_features(df: DataFrame, col: str = "Time", night: str = "reference") -> DataFrame:
    """hour, day_of_week (Monday 0), is_weekend, is_night from seconds since the epoch.

    ``night="reference"`` tests 22 <= hour <= 6, which no hour meets; ``"wraparound"``
    tests the documented 22:00 to 06:00.
    """
    if night not in ("reference", "wraparound"):
        raise ValueError(f"night must be 'reference' or 'wraparound', got {night!r}")
    ts = F.timestamp_seconds(F.col(col))
    hour = F.col("hour")
    is_night = hour.between(22, 6) if night == "reference" else (hour >= 22) | (hour <= 6)
    return df.withColumns({"hour": F.hour(ts), "day_of_week": F.weekday(ts)}).withColumns(
        {"is_weekend": F.col("day_of_week").isin(5, 6).cast("int"), "is_night": is_night.cast("int")}
    )


def amount_features(df: DataFrame, col: str = "Amount") -> DataFrame:
    x = F.col(col)
    return df.withColumns({"amount_log": F.log1p(x), "amount_squared": x * x, "amount_sqrt": F.sqrt(x)})


def interaction_features(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    return df.withColumns({f"{a}_x_{b}": F.col(a) * F.col(b) for a, b in pairs})


def anova_f(df: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    """One-way ANOVA F of each feature against the label.

    One pass keeps (n, mean, variance) per class and feature side by side; only the
    per-class row (not the data) is then turned long.
    """
    aggs = []
    for f in features:
        x = F.col(f).cast("double")
        aggs += [F.count(x).alias(f"{f}__n"), F.avg(x).alias(f"{f}__m"), F.var_pop(x).alias(f"{f}__v")]
    cells = F.array(
        *[
            F.struct(
                F.lit(f).alias("feature"), F.col(f"{f}__n").alias("n"), F.col(f"{f}__m").alias("m"),
                F.col(f"{f}__v").alias("v"),
            )
            for f in features
        ]
    )
    per_class = df.groupBy(label).agg(*aggs).select(F.explode(cells).alias("x")).select("x.*").filter("n > 0")
    # The grand mean is joined back before squaring: subtracting two large sums loses digits.
    grand = Window.partitionBy("feature")
    centred = per_class.withColumn("gm", F.sum(F.col("n") * F.col("m")).over(grand) / F.sum("n").over(grand))
    sums = centred.groupBy("feature").agg(
        F.count("*").alias("k"),
        F.sum("n").alias("n"),
        F.sum(F.col("n") * (F.col("m") - F.col("gm")) * (F.col("m") - F.col("gm"))).alias("between"),
        F.sum(F.col("n") * F.col("v")).alias("within"),
    )
    f_value = F.try_divide(
        F.try_divide("between", (F.col("k") - 1).cast("double")),
        F.try_divide("within", (F.col("n") - F.col("k")).cast("double")),
    )
    return sums.select("feature", f_value.alias("f_score"))


def select_k_best(df: DataFrame, label: str, features: Sequence[str], k: int = 20) -> DataFrame:
    return anova_f(df, label, features).orderBy(F.nanvl("f_score", F.lit(None).cast("double")).desc_nulls_last(), "feature").limit(k)


def feature_vector(df: DataFrame, names: Sequence[str], col: str = "features") -> DataFrame:
    """Feature map to an ordered array and to the comma-separated payload."""
    m = F.col(col)
    return df.withColumns({"vector": feature_array(m, names), "payload": feature_payload(m, names)})
