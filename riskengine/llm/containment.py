"""Benchmark decontamination: size-partitioned MinHash containment search, then exact verification.

Items are put in partitions by their number of shingles (powers of two). The signature of
an item is the smallest hashes of its shingles, their number set by the partition's largest
size m: floor((1 - t) m) + 1, or all of its shingles if it has fewer. A text that holds at
least t of an item's shingles lacks at most (1 - t) m of them, so it holds one of the
signature: no containing text is missed, however long it is.

Texts are probed against a Bloom filter of the signatures, whose size is fixed; hits are
joined to the signatures by Spark. The candidate pairs are then verified by counting the
item's distinct shingles, as words, in the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskengine.llm.frames import id_text, keyed, map_batches, stored
from riskengine.llm.tokens import U64, Words, mix, words

SHINGLE = 5
SIMILARITY = 0.8
BLOOM_BITS = 1 << 23
ITEMS = 256  # items checked together against a text, about; a text with more candidates is read once per so many


def shingle_hashes(h: np.ndarray, w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``size`` words within a text, and the number of its text in the batch."""
    n = len(h) - size + 1
    if n < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = h[:n].copy()
    for i in range(1, size):
        out = out * U64(0x9E3779B97F4A7C15) + h[i : n + i]
    inside = w.doc[:n] == w.doc[size - 1 :]
    return mix(out[inside] + U64(size)), w.doc[:n][inside]


def _signatures(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            keys = batch.column("key").to_pylist()
            for w in words(batch.column("text")):
                h = w.hashes(0)
                for d in w.docs:
                    own = slice(*np.searchsorted(w.doc, [d, d + 1]))
                    n = own.stop - own.start
                    if not n:
                        continue  # an item without words is in no text
                    size = min(n, SHINGLE)
                    one = Words(range(d, d + 1), w.low, w.start[own], w.end[own], w.doc[own], w.first)
                    hashes = np.unique(shingle_hashes(h[own], one, size)[0])
                    part = 1 << int(np.ceil(np.log2(len(hashes))))
                    keep = min(len(hashes), int(np.floor((1 - similarity) * part + 1e-9)) + 1)
                    rows.append((keys[d], size, len(hashes), part, hashes[:keep].view(np.int64).tolist()))
            cols = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(cols[0], pa.int64()),
                    pa.array(cols[1], pa.int32()),
                    pa.array(cols[2], pa.int64()),
                    pa.array(cols[3], pa.int64()),
                    pa.array(cols[4], pa.list_(pa.int64())),
                ],
                ["key", "shingle", "n_shingles", "part", "signature"],
            )

    return run


def _probe_bits(hashes: np.ndarray) -> list[np.ndarray]:
    return [(hashes >> U64(s)) % U64(BLOOM_BITS) for s in (0, 20, 40)]


def _bloom_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits = np.zeros(BLOOM_BITS // 8, dtype=np.uint8)
    for batch in batches:
        hashes = batch.column("h").to_numpy(zero_copy_only=False).view(np.uint64)
        for at in _probe_bits(hashes):
            np.bitwise_or.at(bits, (at >> U64(3)).astype(np.int64), (1 << (at & U64(7))).astype(np.uint8))
    at = np.flatnonzero(bits)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(bits[at].astype(np.int32))], ["byte", "bits"])


def _bloom(signatures: DataFrame) -> np.ndarray:
    """All signature hashes in one bit array of a fixed size."""
    found = map_batches(signatures.select("h"), _bloom_parts, "byte int, bits int")
    rows = found.groupBy("byte").agg(F.bit_or("bits").alias("bits")).toPandas()
    bits = np.zeros(BLOOM_BITS // 8, dtype=np.uint8)
    bits[rows["byte"]] = rows["bits"]
    return bits


def _probe(bloom, sizes: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bloom.value
        for batch in batches:
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            for w in words(batch.column("text")):
                h = w.hashes(0)
                for size in sizes:
                    hashes, doc = shingle_hashes(h, w, size)
                    hit = np.ones(len(hashes), dtype=bool)
                    for at in _probe_bits(hashes):
                        hit &= (bits[(at >> U64(3)).astype(np.int64)] >> (at & U64(7)).astype(np.uint8)) & 1 > 0
                    pair = np.unique(np.stack((doc[hit], hashes[hit].view(np.int64)), axis=1), axis=0)
                    if len(pair):
                        yield pa.RecordBatch.from_arrays([pa.array(keys[pair[:, 0]]), pa.array(pair[:, 1])], ["key", "h"])

    return run


def _verify(pdf_iter: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Share of an item's distinct shingles that stand in the text; both as lower-cased words."""
    for pdf in pdf_iter:
        out = []
        for key, doc_id, text, items in zip(pdf["key"], pdf["doc_id"], pdf["text"], pdf["items"]):
            found = bytes(text).lower().split()
            held: dict[int, set] = {}
            for item in items:
                own = bytes(item["text"]).lower().split()
                size = min(len(own), SHINGLE)
                if size not in held:
                    held[size] = {tuple(found[i : i + size]) for i in range(len(found) - size + 1)}
                wanted = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)}
                out.append((key, doc_id, item["item"], len(wanted & held[size]), len(wanted)))
        yield pd.DataFrame(out, columns=["key", "doc_id", "item", "n_found", "n_shingles"])


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    similarity: float = SIMILARITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(key, doc_id, item_id, n_found, n_shingles, containment) for pairs at or above ``similarity``.

    ``key`` is a hash of the document's id and text; rows equal in both give one result row.
    Shingles are five words (A-Z as a-z); an item of one to four words has one shingle, all
    its words; an item or text without words, null ones too, is in no pair. Items that are
    repeated give their rows once per distinct id and text. Other columns are not looked at.
    """
    spark = docs.sparkSession
    texts = keyed(docs, id_col, text_col)
    wanted = id_text(items, item_col, item_text_col).distinct()
    wanted = stored(wanted.withColumn("key", F.xxhash64(F.col("doc_id"), F.col("text"))), "items")
    signed = stored(
        map_batches(
            wanted.select("key", "text"),
            _signatures(similarity),
            "key bigint, shingle int, n_shingles bigint, part bigint, signature array<bigint>",
        ),
        "signatures",
    )
    entries = signed.select(F.col("key").alias("item"), F.explode("signature").alias("h"))
    bloom = spark.sparkContext.broadcast(_bloom(entries))
    sizes = [r["shingle"] for r in signed.select("shingle").distinct().collect()]  # at most five
    hits = map_batches(texts.select("key", "text"), _probe(bloom, sorted(sizes)), "key bigint, h bigint")
    pairs = stored(hits.join(entries, "h").select("key", "item").distinct(), "candidates")
    item_text = F.struct(F.col("item"), F.col("text"))
    # Mostly few per text: the items that share a signature shingle with it. A text is read once for all
    # of them; those of a text with many are spread over as many groups as keep each one small.
    many = pairs.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > ITEMS)
    parts = F.ceil(F.coalesce("n", F.lit(1)) / ITEMS)
    slots = pairs.join(many, "key", "left").select("key", "item", F.pmod(F.xxhash64("item"), parts).alias("slot"))
    named = slots.join(wanted.select(F.col("key").alias("item"), "text"), "item")
    per_text = named.groupBy("key", "slot").agg(F.collect_list(item_text).alias("items")).drop("slot")
    id_type = texts.schema["doc_id"].dataType.simpleString()
    checked = texts.join(per_text, "key").mapInPandas(
        _verify, f"key bigint, doc_id {id_type}, item bigint, n_found bigint, n_shingles bigint"
    )
    exact = checked.filter(F.col("n_found") >= F.lit(similarity) * F.col("n_shingles") - 1e-9).distinct()
    names = wanted.select(F.col("key").alias("item"), F.col("doc_id").alias("item_id"))
    return (
        exact.join(names, "item")
        .select("key", "doc_id", "item_id", "n_found", "n_shingles", (F.col("n_found") / F.col("n_shingles")).alias("containment"))
    )
