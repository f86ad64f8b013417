"""Profiles: summaries, balances, histograms, correlations, reshapes."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskengine.functions.scalars import is_missing, number
from riskengine.operators.joins import group_join
from riskengine.operators.ranking import exact_quantiles


def _feature_rows(one: DataFrame, cols: Sequence[str], stats: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Wide aggregates named ``<col>__<stat>`` to one row per feature."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("feature"), *[F.col(f"{c}__{s}").alias(s) for s in stats]) for c in cols]
    )
    return one.select(*keep, F.explode(cells).alias("x")).select(*keep, "x.*")


def schema_report(df: DataFrame) -> DataFrame:
    one = df.agg(F.count("*").alias("_n"), *[F.count(f"`{c}`").alias(c) for c in df.columns])
    cells = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(c).alias("column_name"),
                F.lit(t).alias("dtype"),
                F.col(f"`{c}`").alias("non_null"),
                F.col("_n").alias("n_rows"),
            )
            for i, (c, t) in enumerate(df.dtypes)
        ]
    )
    return one.select(F.explode(cells).alias("x")).select("x.*")


def dataset_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, missing, missing %, min, max, mean, sample std and exact median per column."""
    types = dict(df.dtypes)
    # Missing values become null once, before the aggregates that all skip nulls.
    clean = df.select(*[F.when(~is_missing(c, types[c]), F.col(c)).cast("double").alias(c) for c in cols])
    found = {"count": F.count, "min": F.min, "max": F.max, "mean": F.avg, "std": F.stddev_samp}
    one = clean.agg(
        F.count("*").alias("_rows"), *[fn(F.col(c)).alias(f"{c}__{s}") for c in cols for s, fn in found.items()]
    )
    missing = F.col("_rows") - F.col("count")
    rows = _feature_rows(one, cols, list(found), keep=["_rows"]).select(
        "feature",
        "count",
        missing.alias("missing"),
        F.round(F.coalesce(F.try_divide(missing * F.lit(100.0), F.col("_rows")), F.lit(0.0)), 2).alias("missing_pct"),
        "min",
        "max",
        "mean",
        "std",
    )
    median = exact_quantiles(clean, cols, [0.5]).withColumnRenamed("q0", "median")
    return rows.join(median, "feature", "left")


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, std, min, quartiles and max per column, typed; NaN counts as missing."""
    aggs: list[Column] = []
    for c in cols:
        x = number(c)
        aggs += [
            F.count(x).alias(f"{c}__count"),
            F.avg(x).alias(f"{c}__mean"),
            F.stddev_samp(x).alias(f"{c}__std"),
            F.min(x).alias(f"{c}__min"),
            F.max(x).alias(f"{c}__max"),
        ]
    rows = _feature_rows(df.agg(*aggs), cols, ["count", "mean", "std", "min", "max"])
    quartiles = exact_quantiles(df, cols, [0.25, 0.5, 0.75]).toDF("feature", "p25", "p50", "p75")
    return rows.join(quartiles, "feature", "left")


def class_balance(df: DataFrame, label: str = "Class", by: Sequence[str] = ()) -> DataFrame:
    """Rows per class, percents, and negatives per positive (infinite without positives)."""
    counts = df.groupBy(*by).agg(
        F.count_if(F.col(label) == 0).alias("negatives"),
        F.count_if(F.col(label) == 1).alias("positives"),
        F.count("*").alias("total"),
    )
    return counts.withColumns(
        {
            "negative_pct": F.try_divide(F.col("negatives") * F.lit(100.0), F.col("total")),
            "positive_pct": F.try_divide(F.col("positives") * F.lit(100.0), F.col("total")),
            "ratio": F.coalesce(
                F.try_divide(F.col("negatives").cast("double"), F.col("positives").cast("double")),
                F.lit(float("inf")),
            ),
        }
    )


def histogram(df: DataFrame, cols: Sequence[str], by: str, bins: int = 50) -> DataFrame:
    """Equal-width histogram of each column within each class, borders per (column, class).

    The top edge falls into the last bin; a column with one value gets a bin range one
    unit wide around it. The borders (one row per class) come from one narrow pass and
    join back: adaptive execution broadcasts them, or splits a class that is too large.
    """
    types = dict(df.dtypes)
    # NaN counts as missing: it would become the upper border.
    value = {c: F.when(~is_missing(c, types[c]), F.col(c)).cast("double").alias(c) for c in cols}
    wide = df.select(by, *value.values())
    ends = wide.groupBy(by).agg(
        *[F.min(c).alias(f"{c}__low") for c in cols], *[F.max(c).alias(f"{c}__high") for c in cols]
    )
    flat = {c: F.when(F.col(f"{c}__low") == F.col(f"{c}__high"), 0.5).otherwise(0.0) for c in cols}
    ends = ends.select(
        by,
        *[(F.col(f"{c}__low") - flat[c]).alias(f"{c}__low") for c in cols],
        *[(F.col(f"{c}__high") + flat[c]).alias(f"{c}__high") for c in cols],
    )
    binned = group_join(wide, ends, [by]).select(
        by,
        *[
            (F.least(F.width_bucket(c, f"{c}__low", f"{c}__high", F.lit(bins)), F.lit(bins)) - 1).cast("int").alias(c)
            for c in cols
        ],
    )
    counts = (
        binned.unpivot([by], list(cols), "feature", "bin")
        .filter(F.col("bin").isNotNull())
        .groupBy(by, "feature", "bin")
        .agg(F.count("*").alias("n"))
    )
    borders = _feature_rows(ends, cols, ["low", "high"], keep=[by])
    return group_join(counts, borders, [by, "feature"])


def density(df: DataFrame, col: str, by: str, bins: int) -> DataFrame:
    """Histogram scaled so that each class has area 1."""
    h = histogram(df, [col], by, bins)
    width = (F.col("high") - F.col("low")) / bins
    total = F.sum("n").over(Window.partitionBy(by))  # at most ``bins`` rows per class
    return h.select(by, "bin", "n", (F.col("n") / (total * width)).alias("density"))


def value_share(df: DataFrame, col: str, by: str) -> DataFrame:
    """Share of each value within its class."""
    counts = df.groupBy(by, col).agg(F.count("*").alias("n"))
    totals = counts.groupBy(by).agg(F.sum("n").alias("total"))
    return group_join(counts, totals, [by]).select(by, col, "n", (F.col("n") / F.col("total")).alias("share"))


def rate_by(df: DataFrame, flag: str, label: str) -> DataFrame:
    return df.groupBy(flag).agg(F.count("*").alias("n"), F.avg(label).alias("rate"))


def rate_by_period(df: DataFrame, date_col: str, label: str, periods: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Rows and positive rate of each named date range, all ranges in one pass."""
    day = F.col(date_col)
    aggs = []
    for name, (start, end) in periods.items():
        inside = day.between(F.lit(start).cast("date"), F.lit(end).cast("date"))
        aggs += [F.count_if(inside).alias(f"{name}__n"), F.avg(F.when(inside, F.col(label))).alias(f"{name}__rate")]
    return _feature_rows(df.agg(*aggs), list(periods), ["n", "rate"]).withColumnRenamed("feature", "period")


def latency_stats(df: DataFrame, by: str, value: str = "latency_ms") -> DataFrame:
    """Mean and exact p95, p99 (linear interpolation) per arm."""
    mean = df.groupBy(by).agg(F.count(value).alias("n"), F.avg(value).alias("avg_ms"))
    tails = exact_quantiles(df, [value], [0.95, 0.99], by=[by]).select(
        by, F.col("q0").alias("p95_ms"), F.col("q1").alias("p99_ms")
    )
    return group_join(mean, tails, [by], "left")


def pivot_mean(df: DataFrame, index: Sequence[str], col: str, values: Sequence, value: str) -> DataFrame:
    """Mean of ``value`` per index row and pivot column; listed values save a scan."""
    return df.groupBy(*index).agg(*[F.avg(F.when(F.col(col) == v, F.col(value))).alias(f"{col}_{v}") for v in values])


def melt_metrics(df: DataFrame, ids: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    return df.unpivot(list(ids), list(metrics), "metric", "score")


def _pair_moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per pair of columns: rows with both values, and their centred sums and products.

    Each task folds its Arrow batches into matrix products and returns one row per
    pair; d * d aggregate expressions would outgrow generated code. Values are centred
    on the column means first, so the sums do not lose digits.
    """
    means = df.agg(*[F.avg(F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))).alias(c) for c in cols]).first()
    centre = np.array([means[c] if means[c] is not None else 0.0 for c in cols])
    size = len(cols)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((6, size, size))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns]) - centre
            there = ~np.isnan(x)
            x = np.where(there, x, 0.0)
            m = there.astype(float)
            sums += [m.T @ m, x.T @ m, m.T @ x, (x * x).T @ m, m.T @ (x * x), x.T @ x]
        a, b = np.tril_indices(size, -1)
        yield pa.RecordBatch.from_pydict(
            {"a": a.astype("int32"), "b": b.astype("int32"), **{k: v[a, b] for k, v in zip(names, sums)}}
        )

    names = ["n", "sx", "sy", "sxx", "syy", "sxy"]
    schema = "a int, b int, " + ", ".join(f"{k} double" for k in names)
    parts = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).mapInArrow(fold, schema)
    return parts.groupBy("a", "b").agg(*[F.sum(k).alias(k) for k in names])


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Lower triangle of the Pearson matrix over rows with both values; null where a
    column does not vary."""
    name = F.array(*[F.lit(c) for c in cols])
    n, sx, sy = F.col("n"), F.col("sx"), F.col("sy")
    vx, vy = F.col("sxx") - F.try_divide(sx * sx, n), F.col("syy") - F.try_divide(sy * sy, n)
    cov = F.col("sxy") - F.try_divide(sx * sy, n)
    return _pair_moments(df, cols).select(
        F.element_at(name, F.col("a") + 1).alias("feature_a"),
        F.element_at(name, F.col("b") + 1).alias("feature_b"),
        F.when((vx > 0) & (vy > 0), cov / F.sqrt(vx * vy)).alias("corr"),
    )


def target_corr(df: DataFrame, target: str, cols: Sequence[str], n: int = 15) -> DataFrame:
    """Features by absolute correlation with the target, the ``n`` largest."""
    # The target goes last, so it is the first of each pair it is in.
    pairs = corr_matrix(df, [*cols, target]).filter(F.col("feature_a") == target)
    scored = pairs.select(F.col("feature_b").alias("feature"), F.abs("corr").alias("abs_corr"))
    return scored.orderBy(F.desc_nulls_last("abs_corr"), "feature").limit(n)
