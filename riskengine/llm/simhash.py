"""SimHash near-duplicates through covering locality-sensitive hashing.

Each of the 64 bit positions is given a non-zero vector of ``RADIUS + 1`` bits. For each
non-zero vector v there is a table keyed by the fingerprint's bits whose vector has an odd
inner product with v. Whatever 3 positions two fingerprints differ in, some v is orthogonal
to all three vectors, so the two share a key in that table: no pair within the radius is
lost, and there are 15 tables with keys of 32 bits or more.

Fingerprints are made distinct first; copies never meet as pairs. A bucket with more than
``BUCKET`` fingerprints is cut again by the same construction over the bits its key leaves
open. That fixes 48 bits or more, so such a bucket holds at most 2**16 fingerprints whatever
the input, and still loses no pair. Inside a bucket a search from unvisited fingerprints
returns one link per fingerprint reached, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from riskengine.llm.components import components
from riskengine.llm.frames import keyed, map_batches, stored
from riskengine.llm.tokens import Words, words

RADIUS = 3
SHINGLE = 3
SEED = 42
BUCKET = 2048


def covering_masks(positions: list[int], radius: int = RADIUS) -> list[int]:
    """One mask per non-zero vector of ``radius + 1`` bits, over the given bit positions."""
    top = 1 << (radius + 1)
    vector = {p: 1 + i % (top - 1) for i, p in enumerate(positions)}
    return [sum(1 << p for p, x in vector.items() if (x & v).bit_count() % 2) for v in range(1, top)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


MASKS = covering_masks(list(range(64)))
FINER = [[m | s for s in covering_masks([p for p in range(64) if not m >> p & 1])] for m in MASKS]


def _spaced(w: Words) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words with one space between neighbours: the bytes, and where each word begins and ends."""
    size = w.end - w.start
    start = np.cumsum(size + 1) - (size + 1)
    out = np.full(int((size + 1).sum()), 0x20, dtype=np.uint8)
    shift = np.repeat(start - w.start, size)
    source = np.arange(len(shift)) - np.repeat(np.cumsum(size) - size - w.start, size)
    out[source + shift] = w.low[source]
    return out.tobytes(), start, start + size


def majority(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """64-bit fingerprints of runs of hashes that begin at ``first``: a bit is set if it is set in over half of a run."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8), bitorder="little").reshape(-1, 64)
    sums = np.add.reduceat(bits, first, axis=0, dtype=np.int32)
    count = np.diff(np.append(first, len(hashes)))
    return np.packbits((2 * sums > count[:, None]).astype(np.uint8), axis=1, bitorder="little").view("<u8").ravel()


def fingerprints_of(w: Words, shingle: int = SHINGLE) -> np.ndarray:
    """64-bit fingerprint of each text: a bit is set if it is set in over half of the shingles' hashes."""
    n = np.diff(w.first)
    out = np.zeros(len(n), dtype=np.uint64)
    has = n > 0
    if not has.any():
        return out
    body, start, end = _spaced(w)
    # The last shingles of a text would run into the next one; a short text has one shingle.
    count = np.where(has, np.maximum(n - shingle + 1, 1), 0)
    first = np.cumsum(count) - count
    at = np.arange(int(count.sum())) + np.repeat(w.first[:-1] - first, count)
    last = at + np.repeat(np.minimum(n, shingle), count) - 1
    digest = xxhash.xxh64_intdigest
    hashes = [digest(body[a:b], SEED) for a, b in zip(start[at].tolist(), end[last].tolist())]
    out[has] = majority(np.array(hashes, dtype=np.uint64), first[has])
    return out


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [fingerprints_of(w) for w in words(batch.column("text"))]
        fp = np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), pa.array(fp)], ["doc_id", "key", "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, key, fp): signed 64-bit fingerprints, 0 without words; ``key`` is a hash of id and text."""
    texts = keyed(docs, id_col, text_col)
    id_type = texts.schema["doc_id"].dataType.simpleString()
    return map_batches(texts, _fingerprints, f"doc_id {id_type}, key bigint, fp bigint")


def links_in_bucket(fps: np.ndarray, radius: int = RADIUS) -> tuple[list[int], list[int]]:
    """Links that connect everything connected within the radius, at most one per fingerprint."""
    rest, a, b = fps, [], []
    while len(rest):
        front, root = [rest[0]], int(rest[0])
        rest = rest[1:]
        while front and len(rest):
            near = np.bitwise_count(rest ^ front.pop()) <= radius
            if near.any():
                found = rest[near]
                front.extend(found)
                a.extend([root] * len(found))
                b.extend(found.tolist())
                rest = rest[~near]
    return a, b


def _link_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (t, key): compare within each run, carrying the last run over to the next batch."""
    held = None
    for batch in _with_end(batches):
        if batch is None:
            part = held
        else:
            part = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("t", "key", "fp")]
            if held is not None:
                part = [np.concatenate(x) for x in zip(held, part)]
        if part is None or not len(part[0]):
            continue
        t, key, fp = part
        edge = np.flatnonzero((t[1:] != t[:-1]) | (key[1:] != key[:-1])) + 1
        edge = np.concatenate(([0], edge, [len(t)]))
        if batch is not None:
            held = [x[edge[-2] :] for x in part]
            edge = edge[:-1]
        fp = fp.view(np.uint64)
        size = np.diff(edge)
        two = edge[:-1][size == 2]
        near = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= RADIUS]
        a, b = fp[near].tolist(), fp[near + 1].tolist()
        for i in np.flatnonzero(size > 2).tolist():
            x, y = links_in_bucket(fp[edge[i] : edge[i + 1]])
            a += x
            b += y
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.array(x, dtype=np.uint64).view(np.int64)) for x in (a, b)], ["a", "b"]
        )


def _with_end(batches):
    yield from batches
    yield None


def links(fps: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(a, b) links among distinct fingerprints ``fp``: their connected parts are those of all pairs within 3 bits."""
    fp = F.col("fp")
    tables = F.explode(
        F.array(*[F.struct(F.lit(i).alias("t"), fp.bitwiseAND(F.lit(_signed(m))).alias("key")) for i, m in enumerate(MASKS)])
    )
    keys = fps.select("fp", tables.alias("k")).select("k.t", "k.key", "fp")
    sizes = stored(keys.groupBy("t", "key").agg(F.count("*").alias("n")).filter("n > 1"), "buckets")
    held = keys.join(sizes, ["t", "key"])
    finer = F.array(
        *[F.array(*[F.lit(_signed(m)) for m in row]) for row in FINER]
    )
    cut = held.filter(F.col("n") > bucket).select(
        F.posexplode(finer[F.col("t")]).alias("u", "mask"), "t", "fp"
    )
    cut = cut.select(((F.col("t") + 1) * 100 + F.col("u")).alias("t"), fp.bitwiseAND(F.col("mask")).alias("key"), "fp")
    small = held.filter(F.col("n") <= bucket).select("t", "key", "fp")
    runs = small.union(cut).repartition("t", "key").sortWithinPartitions("t", "key")
    return map_batches(runs, _link_runs, "a bigint, b bigint")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, key, fp, root, component_id) per input row; ``root``: the smallest fingerprint reachable."""
    marked = stored(fingerprints(docs, id_col, text_col), "fingerprints")
    nodes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = components(links(nodes.select("fp"))).select(F.col("node").alias("fp"), "root")
    tied = roots.join(nodes, "fp")
    named = tied.join(tied.groupBy("root").agg(F.min("least").alias("name")), "root").select("fp", "root", "name")
    # Copies alone in their group are named by their own smallest id.
    per_fp = nodes.join(named, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("name", "least").alias("component_id")
    )
    return marked.join(per_fp, "fp", "left").select("doc_id", "key", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) per input row.

    ``component_id`` is the smallest id of the texts reachable over links of at most 3 bits.
    Null text and text without words have fingerprint 0 and are linked like any other;
    repeated rows come out once each; a null id is never a component's name unless all its
    ids are null. Other columns are not looked at; an empty table gives an empty result.
    """
    found = groups(docs, id_col, text_col)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key) of the text that stays of each group: the one with the smallest id, null ids last."""
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "key")
    return groups(docs, id_col, text_col).groupBy("root").agg(F.min_by("key", place).alias("key")).select("key")
