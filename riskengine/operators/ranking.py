"""Global order without a one-task window.

A window with no PARTITION BY, or one whose partition holds a third of the rows,
pulls those rows into a single task. The helpers here cut the ordered column into
many value buckets, run the window inside each bucket, and add up the buckets
(a frame of at most ``buckets`` rows per group) for the offsets. The cut points
only balance the work: any cut points give the same result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from riskengine.operators.joins import group_join
from riskengine.session import checkpointed, parallelism

BUCKET = "_bucket"
LOCAL_POSITION_BITS = (1 << 33) - 1
MAX_BUCKETS = 8192


def literal_array(items: Sequence[str], dtype: str) -> Column:
    """A constant array from one text literal: thousands of literals would slow planning."""
    return F.split(F.lit(",".join(items)), ",").cast(f"array<{dtype}>")


def cut_points(
    df: DataFrame, cols: Sequence[str], buckets: int | None = None, fraction: float = 0.01
) -> dict[str, list[float]]:
    """Bucket borders per column, at most ``MAX_BUCKETS`` numbers each, on the driver.

    Borders come from a row sample because they only decide how even the buckets are:
    every row is still counted in the bucket the borders give it. Each task sends one
    sketch per column; no sampled row is shuffled.
    """
    spark = df.sparkSession
    n = min(MAX_BUCKETS, buckets or 4 * parallelism(spark))
    probs = literal_array([str(i / n) for i in range(1, n)], "double")
    values = [F.col(c).cast("double").alias(c) for c in cols]
    sample = df.select(*values).sample(fraction, seed=17)
    sketch = sample.agg(
        *[F.approx_percentile(F.when(~F.isnan(c), F.col(c)), probs, 2 * n).alias(c) for c in cols]
    ).first()
    return {c: sorted(set(sketch[c] or [])) for c in cols}


def with_buckets(df: DataFrame, cols: Sequence[str], cuts: Mapping[str, list[float]], suffix: str = BUCKET) -> DataFrame:
    """Add ``<col><suffix>``: the number of the value bucket, by binary search in the JVM."""
    binned = [c for c in cols if cuts[c]]
    if binned:
        # The outer borders are infinite, so every number has a bucket.
        df = Bucketizer(
            splitsArray=[[float("-inf"), *cuts[c], float("inf")] for c in binned],
            inputCols=binned,
            outputCols=[c + suffix for c in binned],
            handleInvalid="keep",
        ).transform(df)
    number = {c: F.col(c + suffix) if c in binned else F.lit(0.0) for c in cols}
    # Null and NaN have none.
    return df.withColumns(
        {c + suffix: F.when(F.col(c).isNotNull() & ~F.isnan(c), n) for c, n in number.items()}
    )


def fine_buckets(spark: SparkSession) -> int:
    """Buckets where only a few are looked into: more of them leave fewer rows to order."""
    return min(MAX_BUCKETS, max(256, 16 * parallelism(spark)))


def _cell(i: int, bucket: Column) -> Column:
    """Number of a bucket of the i-th column: one integer key in place of name and bucket."""
    return (F.lit(i * MAX_BUCKETS) + bucket).cast("int")


def cell_counts(binned: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows per (by, feature, cell): narrow, combined map-side."""
    cells = binned.select(*by, *[_cell(i, F.col(c + BUCKET)).alias(c) for i, c in enumerate(cols)])
    counts = cells.unpivot(list(by), list(cols), "feature", "cell").filter(F.col("cell").isNotNull())
    names = F.array(*[F.lit(c) for c in cols])
    return (
        counts.groupBy(*by, "cell")
        .agg(F.count("*").alias("n"))
        .withColumn("feature", F.element_at(names, F.floor(F.col("cell") / MAX_BUCKETS).cast("int") + 1))
    )


def values_in_cells(
    binned: DataFrame,
    cols: Sequence[str],
    wanted: DataFrame,
    by: Sequence[str] = (),
    keep: Sequence[str] = (),
    **counters: Column,
) -> DataFrame:
    """(by, cell, value, counters...) for each distinct value in the wanted cells.

    There are at most ``MAX_BUCKETS`` cells per column; they become one yes/no array per
    column, so other values are dropped before rows are made of them.
    """
    cells = [r["cell"] for r in wanted.select("cell").distinct().collect()]
    found = []
    for i, c in enumerate(cols):
        numbers = {n - i * MAX_BUCKETS for n in cells if n // MAX_BUCKETS == i}
        if numbers:
            asked = literal_array(["true" if n in numbers else "false" for n in range(max(numbers) + 1)], "boolean")
            bucket = F.col(c + BUCKET)
            pair = F.struct(_cell(i, bucket).alias("cell"), F.col(c).alias("value"))
            found.append(F.when(F.get(asked, bucket.cast("int")), pair))
    if not found:
        found = [F.lit(None).cast("struct<cell:int,value:double>")]
    long = binned.select(*by, *keep, F.explode(F.array_compact(F.array(*found))).alias("x")).select(*by, *keep, "x.*")
    return long.groupBy(*by, "cell", "value").agg(*[c.alias(name) for name, c in counters.items()])


def running_totals(
    df: DataFrame,
    order: str,
    sums: Mapping[str, str],
    by: Sequence[str] = (),
    bucket: str = BUCKET,
    descending: bool = False,
) -> DataFrame:
    """Running and grand totals over ``order`` within ``by``.

    ``df`` holds one row per (by, order) and its bucket column. For each entry
    ``out -> col`` the result gains ``out`` (running, inclusive) and ``out_total``.
    """
    by = list(by)
    step = F.col(order).desc() if descending else F.col(order).asc()
    inside = Window.partitionBy(*by, bucket).orderBy(step).rowsBetween(Window.unboundedPreceding, 0)
    local = df.withColumns({out: F.sum(c).over(inside) for out, c in sums.items()})

    parts = df.groupBy(*by, bucket).agg(*[F.sum(c).alias(f"_{out}") for out, c in sums.items()])
    across = Window.partitionBy(*by).orderBy(F.col(bucket).desc() if descending else F.col(bucket).asc())
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        *by,
        bucket,
        *[F.coalesce(F.sum(f"_{o}").over(before), F.lit(0)).alias(f"_{o}_before") for o in sums],
        *[F.sum(f"_{o}").over(Window.partitionBy(*by)).alias(f"{o}_total") for o in sums],
    )
    joined = group_join(local, offsets, [*by, bucket]) if by else local.join(offsets, bucket)
    return joined.withColumns({o: F.col(o) + F.col(f"_{o}_before") for o in sums}).drop(
        *[f"_{o}_before" for o in sums]
    )


def rank_in_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], out: str = "rn") -> DataFrame:
    """1-based row number within ``by``, with any group spread over many tasks.

    ``order`` must be total. Rows are range-partitioned on (by, order), so a group
    holding most of the rows still spans many partitions; each row's place is its
    place in the partition plus the rows of its group in earlier partitions.
    """
    by = list(by)
    keys = [F.col(c).asc() for c in by] + list(order)
    placed = (
        df.repartitionByRange(parallelism(df.sparkSession), *keys)
        .sortWithinPartitions(*keys)
        .withColumns(
            {
                "_part": F.spark_partition_id(),
                "_pos": F.monotonically_increasing_id().bitwiseAND(F.lit(LOCAL_POSITION_BITS)),
            }
        )
    )
    # Both reads below must see the same range borders: a re-run would sample new ones.
    placed = checkpointed(placed)
    pieces = placed.groupBy("_part", *by).agg(F.count("*").alias("_n"), F.min("_pos").alias("_first"))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select(
        *by, "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift")
    )
    # One piece per group and partition border: at most partitions + groups rows.
    ranked = group_join(placed, offsets, [*by, "_part"]).withColumn(out, F.col("_pos") + F.col("_shift"))
    return ranked.select(*df.columns, out)


def exact_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact linear-interpolated quantiles: one row per (by, feature), columns q0, q1, ...

    Bucket counts (a narrow, map-side combined pass) say which bucket holds each
    wanted rank; only the rows of those buckets are then shuffled and ordered.
    """
    by = list(by)
    group = [*by, "feature"]
    cuts = cut_points(df, cols, fine_buckets(df.sparkSession))
    binned = with_buckets(df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols]), cols, cuts)
    w = Window.partitionBy(*group)  # one row per bucket
    counts = cell_counts(binned, cols, by).withColumns(
        {
            "upto": F.sum("n").over(w.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)),
            "total": F.sum("n").over(w),
        }
    )
    wanted = F.explode(
        F.array(*[F.struct(F.lit(i).alias("q"), F.lit(float(p)).alias("p")) for i, p in enumerate(probs)])
    )
    place = (F.col("total") - 1) * F.col("w.p")
    sides = F.explode(
        F.array(
            F.struct(F.floor(place).alias("at"), (F.lit(1.0) - (place - F.floor(place))).alias("share")),
            F.struct(F.ceil(place).alias("at"), (place - F.floor(place)).alias("share")),
        )
    )
    targets = (
        counts.withColumn("w", wanted)
        .select(*group, "cell", "n", "upto", F.col("w.q").alias("q"), sides.alias("s"))
        .select(*group, "cell", "q", "s.share", (F.col("s.at") - (F.col("upto") - F.col("n"))).alias("at"), "n")
        .filter((F.col("at") >= 0) & (F.col("at") < F.col("n")))
        .drop("n")
    )
    # Two rows per group, feature and quantile, read twice below.
    targets = checkpointed(targets)
    hit = values_in_cells(binned, cols, targets, by, n=F.count("*"))
    inside = Window.partitionBy(*by, "cell").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    placed = hit.withColumn("upto", F.sum("n").over(inside))
    picked = group_join(placed, targets, [*by, "cell"]).filter(
        (F.col("at") < F.col("upto")) & (F.col("at") >= F.col("upto") - F.col("n"))
    )
    return picked.groupBy(*group).agg(
        *[F.sum(F.when(F.col("q") == i, F.col("value") * F.col("share"))).alias(f"q{i}") for i in range(len(probs))]
    )
