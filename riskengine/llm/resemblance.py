"""Groups of near duplicates by the exact Jaccard similarity of their sets of five-word shingles.

Texts with the same set are one node, with a SimHash fingerprint of the set. Fingerprints within
3 bits are found by the covering masks of ``simhash`` without loss, and their nodes are the first
candidates. A pair at 0.8 differs in some 10 bits, which no covering of 64 bits reaches. So two
nodes are candidates too if they share one of ``BANDS`` keys, each of ``ROWS`` MinHash values: at
similarity s a pair shares none with probability (1 - s**ROWS)**BANDS, which is 5 in a million at
0.8 and less above. Every link is checked on the whole sets. First each node is checked against
its links by fingerprint and one candidate more, the smallest node it shares a key with, which
ties a large group together by few links a node. Then the nodes of a key that are not yet of one
group meet with their sets in one task, which searches from node to node and gives one link per
group reached: pairs that are not similar are never rows. A key with more nodes than ``RUN`` or
``RUN_BYTES`` is cut into blocks that meet two by two.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskengine.llm.components import components
from riskengine.llm.frames import keyed, map_batches, stored
from riskengine.llm.simhash import links as simhash_links, majority
from riskengine.llm.tokens import Words, mix, words

SHINGLE = 5
LEAST = 0.8
ROWS, BANDS = 6, 40
# Most nodes, and bytes of their sets, of one key that a task holds at once.
RUN, RUN_BYTES = 4096, 64 << 20

_rng = np.random.default_rng(20250301)
PLACE = _rng.integers(1, 2**63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
FACTORS = _rng.integers(0, 2**31, ROWS * BANDS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
JOIN = _rng.integers(1, 2**63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of the texts one after the other, and where each text's begin.

    A text of fewer words has one shingle of all of them, one without words none.
    """
    n = np.diff(w.first)
    count = np.where(n > 0, np.maximum(n - SHINGLE + 1, 1), 0)
    first = np.cumsum(count) - count
    text = np.repeat(np.arange(len(n)), count)
    at = np.arange(int(count.sum())) - first[text] + w.first[:-1][text]
    own = w.hashes()
    h = np.zeros(len(at), dtype=np.uint64)
    for j in range(SHINGLE):
        here = j < n[text]
        h[here] += own[at[here] + j] * PLACE[j]
    h = mix(h)
    order = np.lexsort((h, text))
    h = h[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    return h[new], np.concatenate(([0], np.cumsum(np.bincount(text[new], minlength=len(n)))))


def _node(own: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(own.tobytes(), digest_size=8).digest(), "little", signed=True)


def band_keys(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The band keys of each set that is not empty, as rows of signed 64-bit numbers."""
    first = bounds[:-1][np.diff(bounds) > 0]
    low, high = h.astype(np.uint32), (h >> np.uint64(32)).astype(np.uint32)
    least = np.empty((len(first), ROWS * BANDS), dtype=np.uint32)
    for i, factor in enumerate(FACTORS):
        least[:, i] = np.minimum.reduceat(low * factor + high, first)
    return mix((least.reshape(-1, BANDS, ROWS) * JOIN).sum(axis=2, dtype=np.uint64)).view(np.int64)


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        done = 0
        for w in words(batch.column("text")):
            h, bounds = shingle_sets(w)
            size = np.diff(bounds)
            has = size > 0
            keys = band_keys(h, bounds) if has.any() else np.zeros((0, BANDS), np.int64)
            fp = np.zeros(len(size), dtype=np.uint64)
            if has.any():
                fp[has] = majority(h, bounds[:-1][has])
            offsets = np.concatenate(([0], np.cumsum(has * BANDS))).astype(np.int32)
            part = batch.slice(done, len(size))
            done += len(size)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("key"),
                    pa.array([_node(h[a:b]) for a, b in zip(bounds[:-1], bounds[1:])], pa.int64()),
                    pa.array(size.astype(np.int64)),
                    pa.array(fp.view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel())),
                ],
                ["doc_id", "key", "node", "size", "fp", "bands"],
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        done = 0
        for w in words(batch.column("text")):
            h, bounds = shingle_sets(w)
            nodes = batch.column("node").slice(done, len(bounds) - 1)
            done += len(bounds) - 1
            own = [h[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays([nodes, pa.array(own, pa.binary())], ["node", "own"])


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sorted sets have a Jaccard similarity of ``LEAST`` or more."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= LEAST * (len(x) + len(y) - both) - 1e-9


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [batch.column(c) for c in ("own_a", "own_b")]
        near = [similar(*[np.frombuffer(s.as_py(), np.uint64) for s in pair]) for pair in zip(*sets)]
        yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))


def _true_links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    a = sets.select(F.col("node").alias("a"), F.col("own").alias("own_a"))
    b = sets.select(F.col("node").alias("b"), F.col("own").alias("own_b"))
    return map_batches(pairs.join(b, "b").join(a, "a").select("a", "b", "own_a", "own_b"), _checked, "a bigint, b bigint")


def links_in_run(node: np.ndarray, root: np.ndarray, sets: list[np.ndarray]) -> tuple[list[int], list[int]]:
    """Links that join the groups ``root`` of similar nodes, one per group reached."""
    size = np.array([len(x) for x in sets])
    flat, which, shared = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), size)
    common = shared[which] > 1  # a shingle of one node alone is in no intersection
    which, owner = which[common], owner[common]
    own = np.split(which, np.searchsorted(owner, np.arange(1, len(sets))))
    asked = np.zeros(len(flat), dtype=bool)
    group = np.unique(root, return_inverse=True)[1]
    left = np.ones(len(sets), dtype=bool)
    a, b = [], []
    for first in range(len(sets)):
        if not left[first]:
            continue
        front = np.flatnonzero(left & (group == group[first])).tolist()
        left[front] = False
        while front:
            if 2 * np.count_nonzero(left[owner]) < len(owner):
                which, owner = which[left[owner]], owner[left[owner]]
            if not len(owner):
                break
            x = front.pop()
            asked[own[x]] = True
            both = np.bincount(owner[asked[which]], minlength=len(sets))
            asked[own[x]] = False
            near = np.flatnonzero(left & (both >= LEAST * (size[x] + size - both) - 1e-9))
            for g in np.unique(group[near]).tolist():
                a.append(int(node[x]))
                b.append(int(node[near[group[near] == g][0]]))
                reached = np.flatnonzero(left & (group == g))
                left[reached] = False
                front.extend(reached.tolist())
    return a, b


def _run_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (band, i, j); a run is searched when the next one begins."""
    now, held = None, []

    def search() -> pa.RecordBatch:
        node, root, own = zip(*held)
        found = links_in_run(np.array(node), np.array(root), [np.frombuffer(x, np.uint64) for x in own])
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], ["a", "b"])

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("band", "i", "j", "node", "root", "own")]
        for band, i, j, *row in zip(*columns):
            if held and now != (band, i, j):
                yield search()
                held = []
            now = (band, i, j)
            held.append(row)
    if held:
        yield search()


def _met(named: DataFrame, nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """(band, i, j, node, root, own): the nodes of every key that holds several groups, by pair of blocks."""
    sized = named.join(nodes.select("node", "size"), "node")
    mixed = sized.groupBy("band").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n"), F.sum("size").alias("shingles")
    ).filter("low <> high")
    blocks = F.greatest(F.ceil(F.col("n") / RUN), F.ceil(F.col("shingles") * 8 / RUN_BYTES)).cast("int")
    mixed = mixed.select("band", blocks.alias("blocks"))
    placed = named.join(mixed, "band").withColumn("block", F.pmod(F.hash("node"), F.col("blocks")))
    other = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    # A block meets itself only where there is just one: two blocks that meet hold their own pairs too.
    other = other.filter((F.col("blocks") == 1) | (F.col("block") != F.col("other")))
    pair = other.select(
        "band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "root"
    )
    return pair.join(sets, "node").repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")


def simhash_pairs(nodes: DataFrame) -> DataFrame:
    """(a, b): one pair per link of ``simhash.links``, and each node with the smallest one of its fingerprint.

    ``nodes``: (node, size, fp); nodes without shingles are left out.
    """
    marked = nodes.filter("size > 0").select("node", "fp")
    least = stored(marked.groupBy("fp").agg(F.min("node").alias("least")), "node-fingerprints")
    alike = marked.join(least, "fp").filter("least <> node").select(F.col("least").alias("a"), F.col("node").alias("b"))
    a, b = (least.select(F.col("fp").alias(c), F.col("least").alias(f"node_{c}")) for c in "ab")
    near = simhash_links(least.select("fp")).join(a, "a").join(b, "b")
    return alike.union(near.select(F.least("node_a", "node_b"), F.greatest("node_a", "node_b"))).distinct()


def roots(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, root) of the nodes that have a near duplicate.

    ``nodes``: (node, key, size, fp, bands); ``texts``: (key, text) with the text of each key.
    """
    bands = nodes.select("node", F.explode("bands").alias("band"))
    shared = bands.groupBy("band").agg(F.count("*").alias("n"), F.min("node").alias("least")).filter("n > 1").drop("n")
    held = stored(bands.join(shared, "band"), "shared-bands")
    near = stored(simhash_pairs(nodes), "simhash-pairs")
    asked = held.select("node").union(near.select("a")).union(near.select("b")).distinct()
    wanted = nodes.join(asked, "node", "left_semi").select("node", "key")
    found = texts.join(wanted, "key").select("node", "text")
    sets = stored(map_batches(found, _sets, "node bigint, own binary").dropDuplicates(["node"]), "sets")

    first = held.filter("least <> node").groupBy(F.col("node").alias("b")).agg(F.min("least").alias("a")).select("a", "b")
    links = stored(_true_links(near.union(first).distinct(), sets), "links")
    tied = components(links)
    named = held.select("band", "node").join(tied, "node", "left").select("band", "node", F.coalesce("root", "node").alias("root"))
    named = stored(named, "named")
    across = map_batches(_met(named, nodes, sets), _run_links, "a bigint, b bigint")
    return components(links.union(stored(across, "links")))


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key) of the text that stays of each group: the one with the smallest id, null ids last.

    A group is what is connected by similarities of ``LEAST`` or more. Null text and texts without
    words are one group; rows equal in id and text have one key. Columns other than the two are not
    looked at; an empty table has no keys.
    """
    texts = keyed(docs, id_col, text_col)
    id_type = texts.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, key bigint, node bigint, size bigint, fp bigint, bands array<bigint>"
    marked = map_batches(texts, _marks, schema)
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")
    same = [F.first(c).alias(c) for c in ("size", "fp", "bands")]
    nodes = marked.groupBy("node").agg(F.min(place).alias("place"), *same).withColumn("key", F.col("place.key"))
    nodes = stored(nodes, "nodes")
    grouped = nodes.select("node", "place").join(roots(nodes, texts.select("key", "text")), "node", "left")
    return grouped.groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("place").alias("place")).select("place.key")
