"""Quality classifier by importance resampling over hashed n-gram models.

Two generative models, one of the target (labelled as good) and one of the raw text, give
each hashed n-gram the log of its likelihood ratio. The n-grams are words, word pairs and
the first four bytes of words. A text has two log weights: the mean over its words (all
three kinds), and the sum over its worst run of 16 words (word beginnings), so that a long
good text cannot outweigh one bad passage. Each is counted from the level that nearly all
held-out target texts reach; the smaller is the text's weight.

The sample is drawn without replacement by Gumbel top-k: k is the number of texts whose
weight is not negative, and the k texts with the largest weight plus scaled Gumbel noise of
their id stay. Raw counts cover all texts; the target model is fitted on a bounded number of
labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskengine.llm.frames import as_fraction, held_out, keyed, map_batches, stored
from riskengine.llm.tokens import BYTE_VALUES, U64, Words, mix, words

BUCKETS = 1 << 18  # per kind of n-gram
KINDS = 3
PREFIX = 4
RUN = 16
PSEUDO = 4.0
LABELLED = 50_000  # most labelled rows used, about; chosen by a hash of the id
LEVEL = 0.005  # share of held-out target texts that may lie below a level
NOISE = 0.02
SEED = 20240607


def _prefixes(w: Words) -> np.ndarray:
    h = np.zeros(len(w.start), dtype=np.uint64)
    size = w.end - w.start
    for i in range(PREFIX):
        ok = size > i
        h[ok] = h[ok] * U64(0x100000001B3) + BYTE_VALUES[1][w.low[w.start[ok] + i]]
    return mix(h + np.minimum(size, PREFIX).astype(np.uint64))


def _features(w: Words) -> list[np.ndarray]:
    """Bucket numbers of each word, its beginning, and the pair with the word before it (0 at the start of a text)."""
    h = w.hashes(0)
    before = np.zeros_like(h)
    before[1:] = h[:-1]
    first = w.first[:-1]
    before[first[first < len(h)]] = 0
    kinds = (h, _prefixes(w), mix(h * U64(3) + before))
    return [(k % U64(BUCKETS)).astype(np.int64) + i * BUCKETS for i, k in enumerate(kinds)]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    raw, target = np.zeros(KINDS * BUCKETS, np.int64), np.zeros(KINDS * BUCKETS, np.int64)
    for batch in batches:
        good = batch.column("target").to_numpy(zero_copy_only=False).astype(bool)
        for w in words(batch.column("text")):
            mine = good[w.doc]
            for f in _features(w):
                raw += np.bincount(f, minlength=len(raw))
                if mine.any():
                    target += np.bincount(f[mine], minlength=len(target))
    at = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays(
        [pa.array(at.astype(np.int32)), pa.array(raw[at]), pa.array(target[at])], ["bucket", "raw", "target"]
    )


def log_ratios(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log of target to raw likelihood per bucket, both models smoothed alike at the size of the target."""
    out = np.zeros(len(raw))
    for i in range(KINDS):
        part = slice(i * BUCKETS, (i + 1) * BUCKETS)
        scale = target[part].sum() / max(1, raw[part].sum())
        out[part] = np.log((target[part] + PSEUDO) / (raw[part] * scale + PSEUDO))
    return out.astype(np.float32)


def _weigh(ratios):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lr = ratios.value
        for batch in batches:
            whole, passage = [], []
            for w in words(batch.column("text")):
                f = _features(w)
                n = np.diff(w.first)
                has = n > 0
                at = w.first[:-1][has]
                mean, worst = np.full(len(n), np.nan), np.full(len(n), np.nan)
                if has.any():
                    every = (lr[f[0]] + lr[f[1]] + lr[f[2]]).astype(np.float64)
                    mean[has] = np.add.reduceat(every, at) / n[has]
                    sums = np.concatenate(([0.0], np.cumsum(lr[f[1]], dtype=np.float64)))
                    i = np.arange(len(every))
                    low = np.maximum(i - RUN + 1, np.repeat(w.first[:-1], n))
                    worst[has] = np.minimum.reduceat(sums[i + 1] - sums[low], at)
                whole.append(mean)
                passage.append(worst)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("key"),
                    batch.column("level_row"),
                    pa.array(np.concatenate(whole) if whole else [], pa.float64(), from_pandas=True),
                    pa.array(np.concatenate(passage) if passage else [], pa.float64(), from_pandas=True),
                ],
                ["doc_id", "key", "level_row", "whole", "passage"],
            )

    return run


def kth_largest(df: DataFrame, col: str, k: int, few: int = 10_000) -> float | None:
    """The k-th largest value of ``col``, by counting in ever narrower ranges; at most ``few`` values are collected."""
    if k < 1:
        return None
    low, high = df.agg(F.min(col), F.max(col)).first()
    bins = 4096
    while True:
        part = df.filter(F.col(col).between(low, high))
        if low == high:
            return low
        width = (high - low) / bins
        cell = F.least(F.lit(bins - 1), F.floor((F.col(col) - low) / width)).cast("int")
        sizes = part.groupBy(cell.alias("cell")).agg(
            F.count("*").alias("n"), F.min(col).alias("low"), F.max(col).alias("high")
        )
        for row in sorted(sizes.collect(), key=lambda r: -r["cell"]):  # at most ``bins`` rows
            if k <= row["n"]:
                break
            k -= row["n"]
        low, high = row["low"], row["high"]
        if row["n"] <= few:
            values = [r[0] for r in df.filter(F.col(col).between(low, high)).select(col).collect()]
            return sorted(values, reverse=True)[k - 1]


def resampled(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    labelled: int = LABELLED,
    level: float = LEVEL,
    noise: float = NOISE,
) -> DataFrame:
    """(doc_id, key, whole, passage, weight, kept) per input row; ``key`` is a hash of id and text.

    ``labels``: (doc_id, quality, toxic); target rows have quality 1 and toxic 0. Of several
    labels of an id the worst counts; a null label is not a target. A text without words
    (null and empty ones too) has null weights and is not kept. Without target rows every
    text with words has weight 0 and is kept. Rows with equal noise and weight (repeated
    rows) are kept or dropped together. Other columns are not looked at.
    """
    spark = docs.sparkSession
    marks = (
        labels.filter(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min(F.coalesce((F.col("quality") == 1) & (F.col("toxic") == 0), F.lit(False))).alias("good"))
    )
    n = labels.count()
    share = F.lit(1.0) if n <= labelled else F.lit(labelled / n)
    target = marks.filter("good").filter(as_fraction(F.xxhash64("doc_id", F.lit(SEED))) <= share).select("doc_id")
    # Some more or fewer than the bound by chance, which the hard limit cuts.
    target = F.broadcast(stored(target.limit(2 * labelled), "target"))
    texts = keyed(docs, id_col, text_col)
    target_id = target.select(F.col("doc_id").alias("_target"))
    marked = texts.join(target_id, F.col("doc_id") == F.col("_target"), "left")
    is_level = F.col("_target").isNotNull() & held_out("doc_id", 5, 0)
    fit = marked.select("text", (F.col("_target").isNotNull() & ~held_out("doc_id", 5, 0)).alias("target"))
    parts = map_batches(fit, _counts, "bucket int, raw bigint, target bigint")
    sums = parts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    raw, good = np.zeros(KINDS * BUCKETS), np.zeros(KINDS * BUCKETS)
    raw[sums["bucket"]], good[sums["bucket"]] = sums["raw"], sums["target"]
    ratios = spark.sparkContext.broadcast(log_ratios(raw, good))  # a fixed number of buckets
    id_type = texts.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, key bigint, level_row boolean, whole double, passage double"
    weighed = stored(
        map_batches(marked.select("doc_id", "key", "text", is_level.alias("level_row")), _weigh(ratios), schema), "weights"
    )
    # At most the bound of labelled rows.
    own = weighed.filter("level_row and whole is not null").select("whole", "passage").toPandas()
    levels = [float(own[c].quantile(level)) if len(own) else -1e9 for c in ("whole", "passage")]
    weight = F.least((F.col("whole") - levels[0]) * RUN, F.col("passage") - levels[1])
    if not good.sum():
        weight = F.when(F.col("whole").isNotNull(), F.lit(0.0))
    gumbel = -F.log(-F.log(as_fraction(F.xxhash64("doc_id", F.lit(SEED + 1)))))
    drawn = weighed.withColumn("weight", weight).withColumn("draw", F.col("weight") + F.lit(noise) * gumbel)
    k = drawn.filter("weight >= 0").count()
    least = kth_largest(drawn.select("draw").filter("draw is not null"), "draw", k)
    kept = F.lit(False) if least is None else F.coalesce(F.col("draw") >= F.lit(least), F.lit(False))
    return drawn.select("doc_id", "key", "whole", "passage", "weight", kept.alias("kept"))
