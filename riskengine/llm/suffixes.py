"""Exact repeated byte strings by two-stage suffix sorting.

Which suffixes meet. The 64-byte grams of a text are hashed; the smallest hash within the
400 bytes from a place p is the anchor of p. Equal 400-byte strings have equal anchors, so
places can only match places with the same anchor, and a run of neighbouring places with one
anchor travels together, with the 399 bytes after it. Runs are first compared as wholes by a
128-bit digest: an anchor that occurs once is dropped, a run of which there are copies is
sorted once, and an anchor whose runs are all copies of one needs no sorting.

The sort. The runs of many anchors are laid end to end. Suffixes that are smaller than their
successors are sorted directly, in the order of the substrings between them (named by rank,
then by doubling); all others are induced by scanning the buckets of first bytes. The common
prefix of neighbours in the suffix order then tells which places have a 400-byte string in common.

An anchor with more than ``RUNS`` different runs or ``MOST_BYTES`` of them is not gathered: its places are compared by
128-bit digests of their 400 bytes, counted by Spark, in however many tasks that takes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from riskengine.llm.frames import id_text, map_batches, stored
from riskengine.llm.tokens import U64

LENGTH = 400
GRAM = 64
RUNS = 8192  # most different runs of one anchor that are sorted in one task
MOST_BYTES = 6 << 20  # and most bytes of them; runs of periodic text are as long as the text
SORT_BYTES = 1 << 20
PLACES = 1 << 16  # digests handed to Spark at a time


def anchors(body: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, start, end) of the runs of a text of at least ``length`` bytes, and all gram hashes."""
    gram = min(GRAM, length)
    raw = np.frombuffer(body + b"\0" * 8, dtype=np.uint8)
    n = len(body)
    h = np.ndarray((n - 7,), dtype="<u8", buffer=raw, strides=(1,)).astype(np.uint64)
    h *= U64(0x9E3779B97F4A7C15)
    h ^= h >> U64(29)
    step = 8
    while 2 * step <= gram:
        h = h[:-step] * U64(0xBF58476D1CE4E5B9) + h[step:]
        h ^= h >> U64(31)
        step *= 2
    width = length - step + 1
    least, have = h, 1
    while 2 * have <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    least = np.minimum(least[: n - length + 1], least[width - have : width - have + n - length + 1])
    start = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    return least[start], start, np.append(start[1:], len(least)), h


def _runs(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            cols: list[list] = [[], [], [], [], [], []]
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text")):
                body = text.as_py()
                if len(body) < length:
                    continue
                anchor, start, end, h = anchors(body, length)
                width = len(h) - (len(body) - length)
                view = memoryview(body)
                for a, s, e in zip(anchor, start.tolist(), end.tolist()):
                    cols[0].append(a)
                    cols[1].append(digest(view[s : e + length - 1]))
                    cols[2].append(key)
                    cols[3].append(s)
                    cols[4].append(e - s)
                    # A gram that occurs again within a run may repeat the run's own bytes.
                    cols[5].append(np.count_nonzero(h[s : e + width - 1] == a) > 1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.array(cols[0], dtype=np.uint64).view(np.int64)),
                    pa.array(cols[1], pa.binary()),
                    pa.array(cols[2], pa.binary()),
                    pa.array(cols[3], pa.int32()),
                    pa.array(cols[4], pa.int32()),
                    pa.array(cols[5], pa.bool_()),
                ],
                ["anchor", "run", "key", "start", "size", "inner"],
            )

    return run


def _cut(length: int):
    """The bytes of the wanted runs of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[], [], [], [], []]
            for text, wanted in zip(batch.column("text"), batch.column("wanted")):
                body = text.as_py()
                for w in wanted.as_py():
                    cols[0].append(w["anchor"])
                    cols[1].append(w["run"])
                    cols[2].append(w["size"])
                    cols[3].append(w["hot"])
                    cols[4].append(body[w["start"] : w["start"] + w["size"] + length - 1])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(c, t)
                    for c, t in zip(cols, (pa.int64(), pa.binary(), pa.int32(), pa.bool_(), pa.binary()))
                ],
                ["anchor", "run", "size", "hot", "body"],
            )

    return run


def _ranks(*keys: np.ndarray) -> np.ndarray:
    """Rank of each row among the distinct rows, columns in order of weight."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), dtype=bool)
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.cumsum(new)
    return out


def _induce(text: np.ndarray, smaller: np.ndarray, ordered: np.ndarray, sigma: int) -> np.ndarray:
    """The order of all suffixes, from that of the directly sorted ones (``ordered``), by two bucket scans.

    Left to right, each suffix in order places the suffix before it if that one is larger than
    its successor; right to left, each places the one before it if that is smaller.
    """
    n = len(text)
    total = np.bincount(text, minlength=sigma)
    small_n = np.bincount(text[smaller], minlength=sigma)
    first = np.cumsum(total) - total
    large_n = total - small_n
    out = np.full(n, -1, dtype=np.int64)
    # Directly sorted suffixes by first byte, in their order.
    byte = text[ordered]
    by = np.argsort(byte, kind="stable")
    seeds, seed_at = ordered[by], np.searchsorted(byte[by], np.arange(sigma + 1))
    fill = first.copy()

    def place(before: np.ndarray) -> None:
        b = text[before]
        o = np.argsort(b, kind="stable")
        b, before = b[o], before[o]
        here = np.arange(len(b)) - np.searchsorted(b, b)
        out[fill[b] + here] = before
        np.add.at(fill, b, 1)

    # The end of the text is smaller than everything: its last suffix is larger than its successor.
    if not smaller[n - 1]:
        place(np.array([n - 1]))
    for c in range(sigma):
        at = first[c]
        while at < first[c] + large_n[c] and fill[c] > at:
            upto = fill[c]
            before = out[at:upto] - 1
            before = before[before >= 0]
            place(before[~smaller[before]])
            at = upto
        before = seeds[seed_at[c] : seed_at[c + 1]] - 1
        before = before[before >= 0]
        place(before[~smaller[before]])
    # Smaller ones, from the back: buckets fill from their ends.
    last = first + total
    back = last.copy()

    def place_back(before: np.ndarray) -> None:
        b = text[before]
        o = np.argsort(b, kind="stable")
        b, before = b[o], before[o]
        here = np.arange(len(b)) - np.searchsorted(b, b)
        out[back[b] - 1 - here] = before
        np.subtract.at(back, b, 1)

    for c in range(sigma - 1, -1, -1):
        at = last[c]
        while at > last[c] - small_n[c] and back[c] < at:
            low = back[c]
            before = out[low:at][::-1] - 1
            before = before[before >= 0]
            place_back(before[smaller[before]])
            at = low
        before = out[first[c] : first[c] + large_n[c]][::-1] - 1
        before = before[before >= 0]
        place_back(before[smaller[before]])
    return out


def suffix_order(text: np.ndarray, sigma: int, depth: int) -> np.ndarray:
    """Start places of all suffixes of ``text`` (integers below ``sigma``) in lexicographic order.

    Suffixes equal in their first ``depth`` places may stand in any order among themselves.
    """
    n = len(text)
    if n < 2:
        return np.arange(n)
    # Smaller than the successor: by the next place that differs.
    change = np.flatnonzero(text[1:] != text[:-1])
    nxt = np.searchsorted(change, np.arange(n - 1))
    has = nxt < len(change)
    smaller = np.zeros(n, dtype=bool)
    at = change[np.minimum(nxt, len(change) - 1)] if len(change) else np.zeros(n - 1, dtype=np.int64)
    smaller[: n - 1] = has & (text[:-1] < text[np.minimum(at + 1, n - 1)])
    left = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1  # leftmost of each run of smaller ones
    if not len(left):
        return _induce(text, smaller, left, sigma)
    # Substrings from one such place to the next, compared eight places at a time.
    wide = int(sigma).bit_length()
    per = max(1, 63 // wide)
    size = np.append(left[1:] + 1, n) - left
    rank = np.zeros(len(left), dtype=np.int64)
    # A substring that another one continues is the larger of the two: it turns upwards where
    # the other still goes down. The last one ends with the text, which is smaller than anything.
    after = np.full(len(left), (1 << wide) - 1, dtype=np.uint64)
    after[-1] = 0
    padded = np.concatenate((text.astype(np.uint64) + U64(1), np.zeros(per, dtype=np.uint64)))
    longest = int(min(size.max(), depth))
    for at in range(0, longest, per):
        key = np.zeros(len(left), dtype=np.uint64)
        for i in range(per):
            place = left + at + i
            inside = (at + i < size) & (place < n)
            key = (key << U64(wide)) | np.where(inside, padded[np.minimum(place, n)], after)
        open_ = size > at
        if at == 0:
            rank = _ranks(key)
        elif open_.any():
            rank = _ranks(rank, key)
        if rank.max() == len(left) - 1:
            break
    # Order of the suffixes of the named string, by doubling; names stand for at least two places each.
    reach = 1
    while rank.max() < len(left) - 1 and reach < depth:
        second = np.zeros(len(left), dtype=np.int64)
        second[:-reach] = rank[reach:] + 1
        rank = _ranks(rank, second)
        reach *= 2
    return _induce(text, smaller, left[np.argsort(rank, kind="stable")], sigma)


def common_at_least(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For each neighbouring pair of suffixes in order, whether they share ``length`` bytes."""
    n = len(text)
    words = np.ndarray((n,), dtype="<u8", buffer=np.concatenate((text, np.zeros(8, np.uint8))), strides=(1,))
    a, b = order[:-1], order[1:]
    same = np.maximum(a, b) + length <= n
    at = np.flatnonzero(same)
    for i in [*range(0, length - 7, 8), max(0, length - 8)] if length >= 8 else []:
        at = at[words[a[at] + i] == words[b[at] + i]]
    if length < 8:
        for i in range(length):
            at = at[text[a[at] + i] == text[b[at] + i]]
    out = np.zeros(len(a), dtype=bool)
    out[at] = True
    return out


def repeated_places(bodies: list[bytes], sizes: list[int], length: int) -> list[np.ndarray]:
    """For each run the places (of its first ``size``) whose ``length`` bytes start at another place too."""
    lay = np.frombuffer(b"".join(bodies), dtype=np.uint8)
    span = np.array([len(b) for b in bodies])
    begin = np.cumsum(span) - span
    owner = np.repeat(np.arange(len(bodies)), span)
    valid = np.arange(len(lay)) - begin[owner] < np.array(sizes)[owner]
    order = suffix_order(lay.astype(np.int64), 256, length)
    order = order[valid[order]]  # places in a run's last bytes belong to other runs
    shared = common_at_least(lay, order, length)
    hit = np.zeros(len(lay), dtype=bool)
    hit[order[:-1][shared]] = True
    hit[order[1:][shared]] = True
    return [np.flatnonzero(hit[b : b + s]) for b, s in zip(begin.tolist(), sizes)]


def _spans(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(places) != 1)
    return places[np.concatenate(([0], edge + 1))], places[np.concatenate((edge, [len(places) - 1]))]


def _sort_runs(length: int):
    """Rows come sorted by anchor; whole anchors are sorted together, about ``SORT_BYTES`` at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def flush(rows: list[tuple]) -> pa.RecordBatch:
            found = repeated_places([r[3] for r in rows], [r[2] for r in rows], length)
            out: list[tuple] = []
            for row, places in zip(rows, found):
                if len(places):
                    out += [(row[0], row[1], int(x), int(y)) for x, y in zip(*_spans(places))]
            cols = list(zip(*out)) if out else [()] * 4
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.binary(), pa.int32(), pa.int32()))],
                ["anchor", "run", "low", "high"],
            )

        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("anchor", "run", "size", "body")))
            for row in rows:
                if size > SORT_BYTES and row[0] != held[-1][0]:
                    yield flush(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield flush(held)

    return run


def _place_digests(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            for anchor, name, size, body in zip(
                *(batch.column(c).to_pylist() for c in ("anchor", "run", "size", "body"))
            ):
                view = memoryview(body)
                for low in range(0, size, PLACES):
                    at = range(low, min(size, low + PLACES))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([anchor] * len(at), pa.int64()),
                            pa.array([name] * len(at), pa.binary()),
                            pa.array(np.array(at, dtype=np.int32)),
                            pa.array([digest(view[i : i + length]) for i in at], pa.binary()),
                        ],
                        ["anchor", "run", "place", "d"],
                    )

    return run


def _removed(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_bytes, n_removed, n_spans, kept_text = [], [], [], []
            for text, spans in zip(batch.column("text"), batch.column("spans").to_pylist()):
                body = text.as_py()
                cover = np.zeros(len(body) + 1, dtype=np.int32)
                for s in spans or ():
                    cover[s["low"]] += 1
                    cover[min(len(body), s["high"] + length)] -= 1
                gone = np.cumsum(cover[:-1]) > 0
                kept_text.append(np.frombuffer(body, dtype=np.uint8)[~gone].tobytes() if spans else body)
                n_bytes.append(len(body))
                n_removed.append(int(gone.sum()))
                n_spans.append(int(np.count_nonzero(gone[1:] & ~gone[:-1]) + bool(len(gone) and gone[0])))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n_bytes, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(n_spans, pa.int64()),
                    pa.array(kept_text, pa.binary()),
                ],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return run


def repeated_spans(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """(key, spans): for texts that have any, runs (low..high) of places whose ``length`` bytes occur elsewhere.

    ``rows``: (key, text); rows of one key have one text.
    """
    found = stored(
        map_batches(
            rows, _runs(length), "anchor bigint, run binary, key binary, start int, size int, inner boolean"
        ),
        "runs",
    )
    per_run = found.groupBy("anchor", "run").agg(
        F.count("*").alias("copies"),
        F.min(F.struct("key", "start")).alias("first"),
        F.max("size").alias("size"),
        F.max("inner").alias("inner"),
    )
    # One row per different run; an anchor's are counted by a second, combined aggregation.
    per_run = stored(per_run, "different-runs")
    per_anchor = per_run.groupBy("anchor").agg(
        F.count("*").alias("n"),
        F.sum("copies").alias("all"),
        F.max("inner").alias("any_inner"),
        F.sum(F.col("size") + (length - 1)).alias("bytes"),
    )
    hot = (F.col("n") > RUNS) | (F.col("bytes") > MOST_BYTES)
    live = per_run.join(per_anchor.filter("all > 1 or any_inner"), "anchor")
    # Copies of one run: every place of it occurs elsewhere.
    copied = live.filter("copies > 1").select("anchor", "run", F.lit(0).alias("low"), (F.col("size") - 1).alias("high"))
    sort_runs = live.filter("n > 1 or inner").select(
        F.col("first.key").alias("key"),
        F.struct("anchor", "run", "first.start", "size", hot.alias("hot")).alias("w"),
    )
    wanted = sort_runs.groupBy("key").agg(F.collect_list("w").alias("wanted"))
    bodies = stored(
        map_batches(
            rows.join(wanted, "key").select("text", "wanted"),
            _cut(length),
            "anchor bigint, run binary, size int, hot boolean, body binary",
        ),
        "run-bytes",
    )
    plain = bodies.filter("not hot").drop("hot").repartition("anchor").sortWithinPartitions("anchor")
    sorted_ = map_batches(plain, _sort_runs(length), "anchor bigint, run binary, low int, high int")
    places = map_batches(
        bodies.filter("hot").drop("hot"), _place_digests(length), "anchor bigint, run binary, place int, d binary"
    )
    twice = places.groupBy("anchor", "d").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    # Neighbouring places of a run become one span; a run has at most the places of a text.
    by_place = Window.partitionBy("anchor", "run").orderBy("place")
    islands = places.join(twice, ["anchor", "d"]).withColumn("island", F.col("place") - F.row_number().over(by_place))
    marked = islands.groupBy("anchor", "run", "island").agg(F.min("place").alias("low"), F.max("place").alias("high")).drop("island")
    marks = copied.union(sorted_).union(marked)
    hits = found.join(marks, ["anchor", "run"]).select(
        "key", F.struct((F.col("start") + F.col("low")).alias("low"), (F.col("start") + F.col("high")).alias("high")).alias("s")
    )
    return hits.groupBy("key").agg(F.collect_list("s").alias("spans"))


def without_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) per input row; ``kept``: the remaining bytes.

    Bytes covered by a string of ``length`` bytes that also starts at another place of any
    text go. Null text is empty. Repeated rows are texts of their own, so all of their
    bytes go if they have ``length`` (8 or more) or more. Other columns are not looked at.
    """
    if length < 8:
        raise ValueError(f"length must be 8 or more, got {length}")
    texts = id_text(docs, id_col, text_col)
    # Rows equal in id and text share a key; each is a text of its own all the same, as its runs are counted.
    named = texts.withColumn(
        "key", F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"), F.lit(b"\0"), "text")))
    )
    spans = repeated_spans(named.select("key", "text"), length)
    id_type = texts.schema["doc_id"].dataType.simpleString()
    return map_batches(
        named.join(spans, "key", "left").select("doc_id", "text", "spans"),
        _removed(length),
        f"doc_id {id_type}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary",
    )
