"""Ranked lexical search over a length-stratified index.

Documents of one normaliser m are a stratum; m depends on a document's length and two totals
of the corpus alone. The index is range-partitioned by m, so a stratum of any size spreads
over several tasks. Inside a task a stratum's postings lie by term, the impact of a count is
computed once per (stratum, count), and the largest impact of each term bounds what any
document of the stratum can score. Strata are visited from the highest bound; an item skips
those whose bound lies below the score it already has ``k`` times. A tie with that score is
not skipped, so the result is exact. Scores are 64-bit integers throughout.

Items are answered in blocks of about ``BLOCK_BYTES`` of text: what a task holds of them is
bounded, and every block is one pass over the corpus that keeps the postings of its terms.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from riskengine.llm.frames import id_text, map_batches, stored
from riskengine.llm.tokens import LOWER, HashIndex, Words, binary_parts, words
from riskengine.session import parallelism

BLOCK_BYTES = 8 << 20
SHELF = 1 << 20  # postings of the strata ordered and visited together in a task
WORK = 1 << 21  # (document, item) sums, and parts of sums, made at once

# Bytes of a term keep their (lower-cased) value, all others become spaces.
TERM_BYTES = np.full(256, 0x20, dtype=np.uint8)
for _low, _high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    TERM_BYTES[_low : _high + 1] = LOWER[_low : _high + 1]


def terms(column: pa.Array) -> Iterator[Words]:
    """Terms of texts: runs of ASCII letters and digits and of characters beyond ASCII."""
    data, offsets = binary_parts(column)
    yield from words(
        pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(TERM_BYTES[data].tobytes())]
        ),
        lower=False,
    )


@dataclass
class Block:
    """Items of one pass. Item i asks for ``term[first[i]:first[i + 1]]``, numbers of the distinct terms ``hashes``."""

    ids: list
    hashes: np.ndarray
    term: np.ndarray
    first: np.ndarray
    weight: np.ndarray | None = None

    @classmethod
    def of(cls, ids: list, texts: list[bytes]) -> Block:
        found = [np.zeros(0, np.uint64)] * len(texts)
        for w in terms(pa.array(texts, pa.large_binary())):
            h = w.hashes()
            for i in w.docs:
                at = i - w.docs.start
                found[i] = np.unique(h[w.first[at] : w.first[at + 1]])
        hashes, term = np.unique(np.concatenate([np.zeros(0, np.uint64), *found]), return_inverse=True)
        return cls(ids, hashes, term.astype(np.int64), np.cumsum([0, *map(len, found)]))


def _postings(block: Block):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = HashIndex(block.hashes)
        for batch in batches:
            done = 0
            for w in terms(batch.column("text")):
                at = index.find(w.hashes())
                asked = at >= 0
                doc = (w.doc - w.docs.start)[asked]
                pair, tf = np.unique(doc * len(block.hashes) + at[asked], return_counts=True)
                size = len(w.docs)
                doc = pair // max(1, len(block.hashes))
                offsets = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=size)))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(done, size),
                        pa.array(np.diff(w.first).astype(np.int64)),
                        pa.ListArray.from_arrays(offsets, pa.array((pair - doc * len(block.hashes)).astype(np.int32))),
                        pa.ListArray.from_arrays(offsets, pa.array(tf.astype(np.int64))),
                    ],
                    ["doc_id", "n", "terms", "tfs"],
                )
                done += size

    return cut


def _holders(size: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            total += np.bincount(_flat(batch, "terms"), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["term", "df"])

    return count


def _flat(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).astype(np.int64)


class Best:
    """The ``k`` best (score, id) of each item so far; equal scores by id, null ids last."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.floor = np.ones(items, dtype=np.int64)  # below it a score is out
        self.kept = [np.zeros(0, dtype=t) for t in (np.int64, np.int64, bool, np.int64)]  # item, score, no id, id
        self.more: list[list[np.ndarray]] = []
        self.waiting = 0

    def add(self, *found: np.ndarray) -> None:
        self.more.append(list(found))
        self.waiting += len(found[0])
        if self.waiting >= max(WORK // 16, len(self.kept[0])):
            self.settle()

    def settle(self) -> None:
        item, score, no_id, i = (np.concatenate(x) for x in zip(self.kept, *self.more))
        order = np.lexsort((i, no_id, -score, item))
        item = item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        last = order[place == self.k - 1]
        order = order[place < self.k]
        self.kept = [x[order] for x in (np.concatenate(x) for x in zip(self.kept, *self.more))]
        self.floor[item[place == self.k - 1]] = score[last]
        self.more, self.waiting = [], 0


class Visitor:
    """Visits strata for all items of a block."""

    def __init__(self, block: Block, k: int):
        self.block, self.best = block, Best(len(block.ids), k)
        # Items by term: item ``by[at[t] + j]`` asks for term t.
        owner = np.repeat(np.arange(len(block.ids)), np.diff(block.first))
        order = np.argsort(block.term, kind="stable")
        self.by = owner[order]
        self.at = np.searchsorted(block.term[order], np.arange(len(block.hashes) + 1))
        self.filled = np.flatnonzero(np.diff(block.first))

    def bounds(self, term: np.ndarray, impact: np.ndarray) -> np.ndarray:
        """The most that a document of the stratum can score, per item."""
        most = np.zeros(len(self.block.hashes), dtype=np.int64)
        np.maximum.at(most, term, impact)
        out = np.zeros(len(self.block.ids), dtype=np.int64)
        if len(self.filled):
            parts = (self.block.weight * most)[self.block.term]
            out[self.filled] = np.add.reduceat(parts, self.block.first[self.filled])
        return out

    def shelf(self, m, size, no_id, ids, term, tf) -> None:
        """Documents sorted by ``m`` with their numbers of postings ``size``; ``term`` and ``tf`` hold the postings."""
        first = np.concatenate(([0], np.cumsum(size)))
        edge = np.concatenate((np.flatnonzero(np.diff(m, prepend=m[0] - 1)), [len(m)]))
        strata = []
        for a, b in zip(edge[:-1], edge[1:]):
            own = slice(first[a], first[b])
            counts, which = np.unique(tf[own], return_inverse=True)
            impact = (1_000_000_000 * counts // (1000 * counts + 20 * m[a]))[which]  # once per count
            bound = self.bounds(term[own], impact)
            strata.append((bound.max(initial=0), a, b, bound, impact))
        for _, a, b, bound, impact in sorted(strata, key=lambda s: -s[0]):
            self.visit(a, b, bound, impact, first, size, no_id, ids, term)

    def visit(self, a, b, bound, impact, first, size, no_id, ids, term) -> None:
        begin = first[a]
        asked = np.diff(self.at)
        while a < b:
            open_items = bound >= self.best.floor
            if not open_items.any():
                return
            # As many documents at once as keep the sums in bounds, one at least.
            parts = np.cumsum(asked[term[first[a] : first[b]]])[first[a + 1 : b + 1] - first[a] - 1] if first[b] > first[a] else [0]
            upto = a + max(1, min(int(np.searchsorted(parts, WORK)), WORK // len(self.block.ids)))
            upto = min(upto, b)
            own = slice(first[a], first[upto])
            t = term[own]
            doc = np.repeat(np.arange(upto - a), size[a:upto])
            n = asked[t]
            start = np.repeat(self.at[:-1][t], n)
            item = self.by[start + np.arange(len(start)) - np.repeat(np.cumsum(n) - n, n)]
            value = np.repeat(impact[own.start - begin : own.stop - begin] * self.block.weight[t], n)
            keep = open_items[item]
            sums = np.zeros((upto - a) * len(self.block.ids), dtype=np.int64)
            np.add.at(sums, (np.repeat(doc, n) * len(self.block.ids) + item)[keep], value[keep])
            sums = sums.reshape(upto - a, -1)
            d, i = np.nonzero(sums >= self.best.floor)
            self.best.add(i, sums[d, i], no_id[a + d], ids[a + d])
            a = upto


def _searched(block: Block, k: int):
    names = ["item", "item_id", "doc_id", "score"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        visitor, held, count = Visitor(block, k), [], 0

        def put_up():
            visitor.shelf(*[np.concatenate(x) for x in zip(*held)])

        for batch in batches:
            size = np.diff(batch.column("terms").offsets.to_numpy()).astype(np.int64)
            ids = batch.column("doc_id")
            parts = [batch.column("m").to_numpy(), size, ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()]
            held.append([*parts, _flat(batch, "terms"), _flat(batch, "tfs")])
            count += len(held[-1][-1])
            if count >= SHELF:
                put_up()
                held, count = [], 0
        if held:
            put_up()
        visitor.best.settle()
        item, score, no_id, ids = visitor.best.kept
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(item.astype(np.int32)), pa.array([block.ids[i] for i in item], pa.int64()),
                pa.array(ids, pa.int64(), mask=no_id), pa.array(score),
            ],
            names,
        )

    return search


def _blocks(items: DataFrame) -> Iterator[Block]:
    """Distinct items with their terms, about ``BLOCK_BYTES`` of text at a time."""
    total = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    parts = int(total // BLOCK_BYTES) + 1
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts))
    for p in range(parts if total else 0):
        rows = items.filter(part == p).orderBy("doc_id", "text").collect()
        if rows:
            yield Block.of([r["doc_id"] for r in rows], [bytes(r["text"]) for r in rows])


def ranked_search(
    docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents that score highest for each item, above 0.

    Ids are integers. Equal scores rank by ascending id, null ids last; repeated documents rank
    each for themselves. Items equal in id and text are one; of one id with different texts each
    is ranked. Null and empty texts have no terms: such a document is never found, such an item
    finds nothing. Other columns are not looked at; an empty table on either side gives no rows.
    """
    spark = docs.sparkSession
    texts = id_text(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    asked = id_text(items, item_col, item_text_col).withColumn("doc_id", F.col("doc_id").cast("bigint")).distinct()
    out = spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    for block in _blocks(asked):
        out = out.union(_answers(texts, block, k))
    return out


def _answers(texts: DataFrame, block: Block, k: int) -> DataFrame:
    schema = "doc_id bigint, n bigint, terms array<int>, tfs array<bigint>"
    postings = stored(map_batches(texts, _postings(block), schema), "postings")
    totals = postings.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
    holders = map_batches(postings.select("terms"), _holders(len(block.hashes)), "term bigint, df bigint")
    df = np.zeros(len(block.hashes), dtype=np.int64)
    for r in holders.groupBy("term").agg(F.sum("df").alias("df")).collect():  # one row per term of the block
        df[r["term"]] = r["df"]
    block.weight = np.floor(1000 * np.log((2 * totals["docs"] + 2) / (2 * df + 1))).astype(np.int64)
    m = F.expr(f"100 - 50 + ((50 * n * {totals['docs']}L) div {max(1, totals['terms'] or 0)}L)")
    index = postings.filter(F.size("terms") > 0).select("doc_id", m.alias("m"), "terms", "tfs")
    index = index.repartitionByRange(parallelism(texts.sparkSession), "m", F.xxhash64("doc_id")).sortWithinPartitions("m")
    found = map_batches(index, _searched(block, k), "item int, item_id bigint, doc_id bigint, score bigint")
    place = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
