"""Reproducible splits and traffic assignment, all keyed by a hash of the row id."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskengine.functions.scalars import stable_hash, stable_unit

DEFAULT_WEIGHTS = {"train": 0.70, "validation": 0.15, "test": 0.15}
WEIGHT_TOLERANCE = 0.001
# Stage -> (challenger percent, hours at that stage).
ROLLOUT_STAGES = {1: (1, 24), 2: (10, 48), 3: (50, 72), 4: (100, 0)}


def check_weights(weights: Mapping[str, float]) -> None:
    total = sum(weights.values())
    if abs(total - 1.0) > WEIGHT_TOLERANCE:
        raise ValueError(f"split weights must sum to 1.0, got {total}: {dict(weights)}")


def split_borders(weights: Mapping[str, float]) -> list[tuple[str, float]]:
    """Upper end of each split's share of [0, 1), the last split taking the rest."""
    check_weights(weights)
    names, ends, total = list(weights), [], 0.0
    for name in names[:-1]:
        total += weights[name]
        ends.append((name, round(total, 9)))
    return [*ends, (names[-1], 1.0)]


def split_bernoulli(
    df: DataFrame, key: str, weights: Mapping[str, float] = DEFAULT_WEIGHTS, seed: int = 42
) -> DataFrame:
    """Independent assignment of each row; no shuffle, same rows under any partitioning."""
    *cuts, (last, _) = split_borders(weights)
    unit, label = F.col("_unit"), None
    for name, end in cuts:
        label = F.when(unit < end, name) if label is None else label.when(unit < end, name)
    hashed = df.withColumn("_unit", stable_unit(seed, key))
    return hashed.withColumn("split", F.lit(last) if label is None else label.otherwise(last)).drop("_unit")


def split_two_way(df: DataFrame, key: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    return split_bernoulli(df, key, {"train": 1.0 - test_size, "test": test_size}, seed)


def _at_border(need: str, borders: Sequence[tuple[int, int, int]], group: str) -> Column:
    """One row per border (i, group, need) whose counted range [need - n, need) it ends in."""
    rows = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(g).alias("g"), F.lit(k).alias("need")) for i, g, k in borders])
    upto, n = F.col(need), F.col("n")
    return F.explode(F.filter(rows, lambda e: (e.g == F.col(group)) & (e.need <= upto) & (e.need > upto - n)))


def _exact_cuts(df: DataFrame, key: str, weights: Mapping[str, float], seed: int) -> list[tuple[int, object] | None]:
    """The (hash, key) of the last row of every split but the final one.

    Radix selection in three narrow passes for all borders together: count by the high
    12 bits of the hash, by the whole hash inside the buckets that hold a border, then
    order the few rows sharing a border's hash. The driver sees one row per border.
    """
    cuts: list[tuple[int, object] | None] = [None] * (len(weights) - 1)
    keys = df.select(F.col(key).alias("k"), stable_hash(seed, key).alias("h")).withColumn("b", F.shiftright("h", 20))

    # At most 4,096 rows, whatever the input size.
    order = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("n").over(Window.partitionBy())
    buckets = keys.groupBy("b").agg(F.count("*").alias("n"))
    buckets = buckets.withColumns({"upto": F.sum("n").over(order), "total": total})
    # Sizes add up border by border: floor(n * w1), floor(n * w1) + floor(n * w2), ...
    sizes = [F.floor(F.col("total") * F.lit(w)) for w in list(weights.values())[:-1]]
    ends = [sum(sizes[: i + 1], F.lit(0).cast("bigint")) for i in range(len(sizes))]
    rows = F.array(*[F.struct(F.lit(i).alias("i"), end.alias("end")) for i, end in enumerate(ends)])
    inside = F.filter(rows, lambda e: (e.end > F.col("upto") - F.col("n")) & (e.end <= F.col("upto")))
    hits = buckets.withColumn("e", F.explode(inside)).select(
        "e.i", "b", (F.col("e.end") - F.col("upto") + F.col("n")).alias("need")
    )
    borders = [tuple(r) for r in hits.collect()]
    if not borders:
        return cuts

    # At most 2**20 hashes per bucket.
    near = keys.filter(F.col("b").isin([b for _, b, _ in borders])).groupBy("b", "h").agg(F.count("*").alias("n"))
    run = Window.partitionBy("b").orderBy("h").rowsBetween(Window.unboundedPreceding, 0)
    found = near.withColumn("upto", F.sum("n").over(run)).withColumn("e", _at_border("upto", borders, "b"))
    found = found.select("e.i", "h", (F.col("e.need") - F.col("upto") + F.col("n")).alias("need"))
    borders = [tuple(r) for r in found.collect()]

    # Rows with the same 32-bit hash: about one in four billion.
    same = keys.filter(F.col("h").isin([h for _, h, _ in borders])).withColumn("n", F.lit(1))
    placed = same.withColumn("upto", F.row_number().over(Window.partitionBy("h").orderBy("k")))
    for row in placed.withColumn("e", _at_border("upto", borders, "h")).select("e.i", "h", "k").collect():
        cuts[row["i"]] = (row["h"], row["k"])
    return cuts


def split_exact(
    df: DataFrame, key: str, weights: Mapping[str, float] = DEFAULT_WEIGHTS, seed: int = 42
) -> DataFrame:
    """Shuffled split with sizes floor(n * w), the remainder to the last split.

    ``key`` must identify a row. Finding the borders takes narrow counting passes;
    the rows themselves are never shuffled or sorted.
    """
    check_weights(weights)
    names = list(weights)
    h = F.col("_h")

    def upto(cut: tuple[int, object]) -> Column:
        return (h < F.lit(cut[0])) | ((h == F.lit(cut[0])) & (F.col(key) <= F.lit(cut[1])))

    label = None
    for name, cut in zip(names, _exact_cuts(df, key, weights, seed)):
        if cut is not None:
            label = F.when(upto(cut), name) if label is None else label.when(upto(cut), name)
    hashed = df.withColumn("_h", stable_hash(seed, key))
    return hashed.withColumn("split", F.lit(names[-1]) if label is None else label.otherwise(names[-1])).drop("_h")


def split_report(df: DataFrame) -> DataFrame:
    """Rows and percent per split, in one pass."""
    sizes = df.groupBy("split").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # one row per split
    return sizes.withColumn("pct", F.round(F.col("n") / total * 100, 6))


def split_integrity(whole: DataFrame, parts: Sequence[DataFrame], key: str) -> DataFrame:
    """One row: sizes, rows lost, rows added and keys found in several parts.

    One shuffle on the key, combined map-side, instead of one set operation per pair.
    """
    tagged = whole.select(key, F.lit(1).alias("w"), F.lit(0).alias("p"))
    for i, part in enumerate(parts):
        tagged = tagged.unionByName(part.select(key, F.lit(0).alias("w"), F.lit(1 << i).alias("p")))
    per_key = tagged.groupBy(key).agg(
        F.sum("w").alias("in_whole"),
        F.sum(F.when(F.col("p") > 0, 1).otherwise(0)).alias("in_parts"),
        F.bit_or("p").alias("which"),
    )
    return per_key.agg(
        F.coalesce(F.sum("in_whole"), F.lit(0)).alias("total"),
        F.coalesce(F.sum("in_parts"), F.lit(0)).alias("parts_total"),
        F.coalesce(F.sum(F.greatest(F.col("in_whole") - F.col("in_parts"), F.lit(0))), F.lit(0)).alias("lost"),
        F.coalesce(F.sum(F.greatest(F.col("in_parts") - F.col("in_whole"), F.lit(0))), F.lit(0)).alias("added"),
        F.count_if(F.bit_count("which") > 1).alias("overlap"),
    ).withColumn("ok", (F.col("lost") == 0) & (F.col("added") == 0) & (F.col("overlap") == 0))


def assign_arm(df: DataFrame, key: str, challenger_pct: int = 10, seed: str = "ab") -> DataFrame:
    """Champion or challenger; a unit in the challenger at 1 % stays there at 10 %."""
    return df.withColumn(
        "arm", F.when(stable_hash(seed, key) % 100 < challenger_pct, "challenger").otherwise("champion")
    )


def rollout_counts(
    df: DataFrame, key: str, stages: Mapping[int, tuple[int, int]] = ROLLOUT_STAGES, seed: str = "ab"
) -> DataFrame:
    """Units per arm at each rollout stage: one pass, one counter per stage."""
    slot = stable_hash(seed, key) % 100
    one = df.agg(
        F.count("*").alias("total"), *[F.count_if(slot < pct).alias(f"c{i}") for i, (pct, _) in stages.items()]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("stage"),
                F.lit(pct).alias("challenger_pct"),
                F.lit(hours).alias("hours"),
                F.col(f"c{i}").alias("challenger"),
            )
            for i, (pct, hours) in stages.items()
        ]
    )
    return one.select("total", F.explode(rows).alias("s")).select(
        "s.*", (F.col("total") - F.col("s.challenger")).alias("champion")
    )
