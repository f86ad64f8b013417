"""Document fingerprints from Lempel-Ziv phrases.

A text is parsed from left to right into phrases, each the shortest string that is not yet a
phrase (the last one may be a phrase already and adds nothing). The fingerprint holds the
``VALUES`` smallest 32-bit hashes of the phrases; texts that compress well with one another
share phrases, and the share among the smallest hashes of both estimates how many. Up to
``VALUES`` phrases the fingerprint is the whole set and the likeness exact.

The next document of each is found without a join of texts: rows are cut into runs of
neighbouring ids, each run is sorted in one task, and the first row of the run that follows
is added to it as its end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from riskengine.llm.frames import id_text, map_batches
from riskengine.llm.tokens import mix, power_tables
from riskengine.operators.ranking import BUCKET, cut_points, fine_buckets, with_buckets
from riskengine.session import parallelism

VALUES = 128
# Part of a text that its edited version takes from the next one.
REPLACED = 3


def parse(text: str, phrases: dict[str, None], open_phrase: str = "") -> str:
    """Add the phrases of ``text`` in the order they end; returns the last, unfinished one."""
    cur = open_phrase
    for c in text:
        cur += c
        if cur not in phrases:
            phrases[cur] = None
            cur = ""
    return cur


def smallest_hashes(text: str, phrases: dict[str, None]) -> np.ndarray:
    """The smallest distinct hashes of the phrases, which follow one another from the start of ``text``."""
    if not phrases:
        return np.zeros(0, dtype=np.uint32)
    end = np.cumsum(np.fromiter(map(len, phrases), dtype=np.int64, count=len(phrases)))
    code = np.frombuffer(text[: end[-1]].encode("utf-32-le"), dtype=np.uint32)
    power, inverse = power_tables(0, len(code) + 1)
    sums = np.zeros(len(code) + 1, dtype=np.uint64)
    np.cumsum(mix(code + np.uint64(1)) * power[: len(code)], out=sums[1:])
    start = np.concatenate(([0], end[:-1]))
    return np.unique((mix((sums[end] - sums[start]) * inverse[start]) >> np.uint64(32)).astype(np.uint32))[:VALUES]


def likeness(x: np.ndarray, y: np.ndarray) -> float:
    """Share of common hashes among the smallest of both; 1 for two texts without phrases."""
    both = np.union1d(x, y)[:VALUES]
    common = np.intersect1d(x, y, assume_unique=True)
    return float(np.searchsorted(common, both[-1], side="right") / len(both)) if len(both) else 1.0


def fingerprint(text: str) -> np.ndarray:
    phrases: dict[str, None] = {}
    parse(text, phrases)
    return smallest_hashes(text, phrases)


def with_edited(text: str, following: str) -> tuple[str, np.ndarray, np.ndarray]:
    """(edited text, fingerprint, its fingerprint); what both begin with is parsed once."""
    cut = len(text) - len(text) // REPLACED
    edited = text[:cut] + following[: len(text) - cut]
    phrases: dict[str, None] = {}
    half = parse(text[:cut], phrases)
    others = dict(phrases)
    parse(text[cut:], phrases, half)
    parse(edited[cut:], others, half)
    return edited, smallest_hashes(text, phrases), smallest_hashes(edited, others)


def _said(x: np.ndarray) -> str:
    return x.astype(">u4").tobytes().hex()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for bucket, last, i, text in zip(*[batch.column(c) for c in (BUCKET, "last", "doc_id", "text")]):
            yield bucket.as_py(), last.as_py(), i, str(text.as_py(), "utf-8", "replace")


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Neighbours of a run; the run's last row is the first of the next one."""
    before = None
    for row in _rows(batches):
        if before is not None and before[0] == row[0] and not before[1]:
            yield before[2], before[3], row[3]
        before = row


def _printed(id_type: pa.DataType, pairs: Iterator[tuple], rows: int) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [id_type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)

    waiting = None  # a row and its fingerprint, until the next one's is known
    for i, text, following in pairs:
        edited, own, other = with_edited(text, following)
        if waiting is not None and waiting[1] == text:
            held.append((*waiting[0], likeness(waiting[2], own)))
            waiting = None
        elif waiting is not None:
            held.append((*waiting[0], likeness(waiting[2], fingerprint(waiting[1]))))
        row = (
            i.as_py(), len(text), hashlib.sha256(edited.encode()).hexdigest(), _said(own), _said(other), likeness(own, other)
        )
        waiting = row, following, own
        if len(held) >= rows:
            yield batch()
            held = []
    if waiting is not None:
        held.append((*waiting[0], likeness(waiting[2], fingerprint(waiting[1]))))
    if held:
        yield batch()


def in_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(bucket, last, doc_id, text): runs by descending id, each closed by the first row of the run after it.

    A run holds the ids between two cut points, so all rows of one id; the last run is closed by the first row of all.
    """
    texts = id_text(docs, id_col, text_col)
    spark = texts.sparkSession
    cuts = cut_points(texts, ["doc_id"], fine_buckets(spark))
    binned = with_buckets(texts.withColumn("id", F.col("doc_id").cast("double")), ["id"], cuts={"id": cuts["doc_id"]}, suffix=BUCKET)
    binned = binned.select(F.coalesce(F.col("id" + BUCKET), F.lit(-1.0)).cast("int").alias(BUCKET), "doc_id", "text")
    # One row per run: at most as many as cut points and one for rows without an id.
    firsts = binned.groupBy(BUCKET).agg(F.max("doc_id").alias("first"))
    order = Window.orderBy(F.desc(BUCKET))
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    follows = firsts.select(
        F.coalesce(F.lag(BUCKET).over(order), F.last(BUCKET).over(every)).alias("closes"), F.col(BUCKET).alias("of"), "first"
    )
    same = (F.col(BUCKET) == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("first"))
    ends = binned.join(F.broadcast(follows), same).groupBy("closes").agg(F.max("first").alias("doc_id"), F.min("text").alias("text"))
    rows = binned.select(BUCKET, F.lit(False).alias("last"), "doc_id", "text").union(
        ends.select("closes", F.lit(True), "doc_id", "text")
    )
    order = (F.col(BUCKET), F.col("last"), F.desc_nulls_last("doc_id"), F.col("text"))
    return rows.repartition(parallelism(spark), BUCKET).sortWithinPartitions(*order)


def phrase_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) per input row.

    Ids are integers. The next document of a row is the one with the next smaller id (rows of one
    id by text, null ids last), of the last row the first; a lone row's is itself. The edited text ends, in place
    of its last third, with what the next one begins with. Null text is empty; an empty text has
    an empty fingerprint, alike (1.0) only to another. Repeated rows come out once each. Other
    columns are not looked at; an empty table gives an empty result.
    """
    runs = in_runs(docs, id_col, text_col)
    id_type = to_arrow_type(runs.schema["doc_id"].dataType)

    def printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _printed(id_type, _pairs(batches), 500)

    schema = (
        f"doc_id {dict(runs.dtypes)['doc_id']}, n_chars bigint, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    return map_batches(runs, printed, schema)
