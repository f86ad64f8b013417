"""Hashed maximum-entropy language model: class-factored softmax over n-gram and skip features.

A token's probability is p(class | two tokens before) * p(token | class, two tokens before).
Both factors are softmax models over three features of the context: the token before
(bigram), the token two before (skip) and the pair (trigram). Weight rows of pairs, and of
features joined with a class, are hashed.

The most frequent words have classes of their own, ``IN_CLASS`` words each. All other words
share tail classes, told apart by their last two bytes; within such a class a word
has its smoothed relative frequency over all training text, so every counted word, however
rare, has its own probability, and one unseen word per class has the rest. As the token
before, a rarer word is known by its own hash in its class; as the token two before, and in
pairs, by its class. How many classes, word buckets and weight rows there are follows the
distinct words of the training text (``Shape``), up to a bound that keeps the weights in memory.

Training counts (context, token) over all training text with Spark. Each round sends the
weights out; each task computes, from the counts it holds, what the model expects of every
weight row; the blocks of rows are summed by Spark and the weights move along the gradient
(observed less expected) in the scaled form log(observed/expected). Nothing but the weights
and the bounded list of frequent words comes to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskengine.llm.frames import held_out, id_text, map_batches, stored
from riskengine.llm.tokens import HashIndex, U64, mix, words

COUNTED = 1 << 18  # most words whose counts are sent to every task
HEAD_CLASSES, IN_CLASS = 32, 32
HEAD = HEAD_CLASSES * IN_CLASS
MOST_TAILS = 64
ROUNDS = 6
RATE = 0.5  # of three active features a third is safe; a half converges faster and stays stable
PRIOR = 1.0  # pseudo-count of a weight
ADD = 0.1  # pseudo-count of a word
BLOCK = 256
COUNTED_AT_ONCE = 1 << 20  # tokens that a task counts together
# The end of a text has a key of its own; no word hash is reserved for it, both hashes would have to agree.
END = (U64(0x5EED0FE2D0000001), U64(0x5EED0FE2D0000003))


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


class Shape(NamedTuple):
    """Sizes of a model, all powers of two."""

    tails: int  # classes of the rarer words
    near: int  # buckets by which a rarer word is told apart as the token before
    pair_rows: int
    fine_rows: int

    @classmethod
    def of(cls, distinct: int) -> Shape:
        """The shape for a number of distinct training words; the upper bounds hold a task's weights and sums to about 270 MB."""

        def sized(words_each: int, least: int, most: int) -> int:
            return 1 << min(max(round(math.log2(max(1, distinct) / words_each)), least), most)

        return cls(sized(1 << 13, 5, 6), sized(1 << 11, 8, 14), sized(1 << 8, 13, 15), sized(1 << 6, 15, 18))

    @property
    def classes(self) -> int:
        return HEAD_CLASSES + self.tails

    @property
    def symbols(self) -> int:
        """Head words, tail classes and, last, what is before the start of a text."""
        return HEAD + self.tails + 1

    @property
    def start(self) -> int:
        return self.symbols - 1

    @property
    def befores(self) -> int:
        """What the token before can be: a head word, a bucket of a rarer one or, last, the start."""
        return HEAD + self.near + 1

    @property
    def coarse_rows(self) -> int:
        return self.befores + self.symbols + self.pair_rows

    def before(self, symbol: np.ndarray, h: np.ndarray) -> np.ndarray:
        own = self.near // self.tails
        bucket = HEAD + (symbol - HEAD) * own + (h % U64(own)).astype(np.int64)
        return np.where(symbol < HEAD, symbol, bucket)

    def symbol_of(self, before: np.ndarray) -> np.ndarray:
        return np.where(before < HEAD, before, HEAD + (before - HEAD) // (self.near // self.tails))

    def rows(self, one: np.ndarray, two: np.ndarray) -> list[np.ndarray]:
        """Weight rows of the three features."""
        pair = mix((self.symbol_of(one) * self.symbols + two).astype(np.uint64)) % U64(self.pair_rows)
        return [one, self.befores + two, self.befores + self.symbols + pair.astype(np.int64)]

    def fine(self, one: np.ndarray, two: np.ndarray, cls: np.ndarray) -> list[np.ndarray]:
        """Weight rows of the three features, each joined with a class."""
        return [
            (mix((f.astype(np.uint64) * U64(3) + U64(i)) * U64(self.classes) + cls.astype(np.uint64)) % U64(self.fine_rows)).astype(np.int64)
            for i, f in enumerate((one, two, self.symbol_of(one) * self.symbols + two))
        ]


def _tail(last: np.ndarray, before: np.ndarray) -> np.ndarray:
    """The widest tail class; a model with fewer takes the remainder."""
    return (mix(last.astype(np.uint64) * U64(256) + before) % U64(MOST_TAILS)).astype(np.int32)


def _streams(column: pa.Array) -> Iterator[tuple]:
    """Per run of texts: text numbers, both hashes and tail class of each token, ends included, and first tokens."""
    for w in words(column):
        n, docs = len(w.start), len(w.docs)
        place = np.arange(n) + (w.doc - w.docs.start)  # an end token follows each text
        ends = w.first[1:] + np.arange(docs)
        h1, h2 = np.full(n + docs, END[0]), np.full(n + docs, END[1])
        h1[place], h2[place] = w.hashes(0), w.hashes(1)
        tail = np.zeros(n + docs, dtype=np.int32)
        last = w.low[w.end - 1]
        tail[place] = _tail(last, np.where(w.end - w.start > 1, w.low[w.end - 2], 0))
        doc = np.empty(n + docs, dtype=np.int64)
        doc[place], doc[ends] = w.doc, np.arange(w.docs.start, w.docs.stop)
        yield w.docs, doc, h1, h2, tail, np.concatenate(([0], ends + 1))


def _distinct(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that groups equal rows, and where groups begin in it."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for c in columns:
        s = c[order]
        new[1:] |= s[1:] != s[:-1]
    return order, np.flatnonzero(new)


def _gathered(parts: Iterator[tuple[np.ndarray, ...]], rows: int) -> Iterator[list[np.ndarray]]:
    """Arrays of many parts put together, about ``rows`` long, so that what a task counts it counts once."""
    held, size = [], 0
    for part in parts:
        held.append(part)
        size += len(part[0])
        if size >= rows:
            yield [np.concatenate(c) for c in zip(*held)]
            held, size = [], 0
    if held:
        yield [np.concatenate(c) for c in zip(*held)]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    runs = ((h1, h2, tail) for batch in batches for _, _, h1, h2, tail, _ in _streams(batch.column("text")))
    for h1, h2, tail in _gathered(runs, COUNTED_AT_ONCE):
        order = np.argsort(h1, kind="stable")
        a, b = h1[order], h2[order]
        new = np.ones(len(a), dtype=bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        at = np.flatnonzero(new)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(_signed(a[at])),
                pa.array(_signed(b[at])),
                pa.array(tail[order[at]]),
                pa.array(np.diff(np.append(at, len(a))).astype(np.int64)),
            ],
            ["h1", "h2", "tail", "n"],
        )


def word_counts(docs: DataFrame) -> DataFrame:
    """(h1, h2, tail, n): count of every distinct token of the texts, under a 128-bit hash."""
    part = map_batches(docs.select("text"), _count_words, "h1 bigint, h2 bigint, tail int, n bigint")
    return stored(part.groupBy("h1", "h2").agg(F.max("tail").alias("tail"), F.sum("n").alias("n")), "lm-words")


def frequent(counts: DataFrame, most: int = COUNTED) -> pd.DataFrame:
    """The words at or above the lowest count that at most ``most`` words reach, most frequent first."""
    level = F.floor(F.log2("n") * 16).cast("int")
    sizes = counts.groupBy(level.alias("level")).agg(F.count("*").alias("words")).collect()  # one row per level
    least, total = None, 0
    for row in sorted(sizes, key=lambda r: -r["level"]):
        total += row["words"]
        if total > most:
            break
        least = row["level"]
    if least is None:
        return pd.DataFrame({"h1": np.zeros(0, np.int64), "h2": np.zeros(0, np.int64), "n": np.zeros(0, np.int64)})
    top = counts.filter(level >= least).select("h1", "h2", "n").toPandas()
    return top.sort_values(["n", "h1"], ascending=[False, True], ignore_index=True)


class Lexicon:
    """Counts of the frequent words; the first ``HEAD`` of them, the end included, are modelled one by one."""

    def __init__(self, top: pd.DataFrame, shape: Shape):
        self.shape = shape
        h1, h2 = top["h1"].to_numpy().view(np.uint64), top["h2"].to_numpy().view(np.uint64)
        end = (h1 == END[0]) & (h2 == END[1])
        n = top["n"].to_numpy()
        # The end is always there, with count 0 if there is no training text.
        self.h1 = np.concatenate(([END[0]], h1[~end])).astype(np.uint64)
        self.h2 = np.concatenate(([END[1]], h2[~end])).astype(np.uint64)
        self.n = np.concatenate(([n[end].sum()], n[~end])).astype(np.int64)
        self.index = HashIndex(self.h1)
        self.head = min(HEAD, len(self.h1))

    def find(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        at = self.index.find(h1)
        at[(at >= 0) & (self.h2[at] != h2)] = -1
        return at

    def symbols(self, at: np.ndarray, tail: np.ndarray) -> np.ndarray:
        return np.where((at >= 0) & (at < self.head), at, HEAD + tail % self.shape.tails).astype(np.int64)


def _contexts(symbol: np.ndarray, h: np.ndarray, first: np.ndarray, shape: Shape) -> np.ndarray:
    """What stands one and two places before, within each text, as one number."""
    one, two = np.full(len(symbol), shape.befores - 1), np.full(len(symbol), shape.start)
    one[1:], two[2:] = shape.before(symbol[:-1], h[:-1]), symbol[:-2]
    starts = first[:-1]
    one[starts] = shape.befores - 1
    second = starts + 1
    two[second[second < len(symbol)]] = shape.start
    # A text of one token has no second one: that place starts the next text.
    two[starts] = shape.start
    return one * shape.symbols + two


def _symbol_counts(lexicon):
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray]]:
        lex = lexicon.value
        for batch in batches:
            for _, _, h1, h2, tail, first in _streams(batch.column("text")):
                s = lex.symbols(lex.find(h1, h2), tail)
                yield (_contexts(s, h1, first, lex.shape) * lex.shape.symbols + s,)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols = lexicon.value.shape.symbols
        for (every,) in _gathered(keys(batches), 4 * COUNTED_AT_ONCE):
            key, n = np.unique(every, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key // symbols), pa.array((key % symbols).astype(np.int32)), pa.array(n.astype(np.int64))],
                ["context", "symbol", "n"],
            )

    return run


def _softmax(rows: list[np.ndarray], weights: np.ndarray, base: np.ndarray) -> np.ndarray:
    z = weights[rows[0]]
    z += weights[rows[1]]
    z += weights[rows[2]]
    z += base
    z -= z.max(axis=1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(axis=1, keepdims=True)
    return z


class Model:
    """Weights: ``coarse`` (feature rows x classes), ``fine`` (feature rows x words of a class), and both priors."""

    def __init__(self, class_n: np.ndarray, word_n: np.ndarray, shape: Shape):
        self.shape = shape
        self.base = np.log((class_n + ADD) / (class_n + ADD).sum()).astype(np.float32)
        word = word_n.reshape(HEAD_CLASSES, IN_CLASS)
        # A place of a class that no word fills is out of reach.
        self.word_base = np.where(word < 0, -1e9, np.log(np.maximum(word, 0) + ADD)).astype(np.float32)
        self.coarse = np.zeros((shape.coarse_rows, shape.classes), dtype=np.float32)
        self.fine = np.zeros((shape.fine_rows, IN_CLASS), dtype=np.float32)

    def classes(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return _softmax(self.shape.rows(one, two), self.coarse, self.base)

    def words(self, one: np.ndarray, two: np.ndarray, cls: np.ndarray) -> np.ndarray:
        return _softmax(self.shape.fine(one, two, cls), self.fine, self.word_base[cls])


def _class_of(symbol: np.ndarray) -> np.ndarray:
    return np.where(symbol < HEAD, symbol // IN_CLASS, HEAD_CLASSES + symbol - HEAD)


STEP = 1 << 15  # counts, or contexts, of one sparse batch


def _blocks(kind: str, array: np.ndarray) -> Iterator[tuple[str, int, bytes]]:
    for at in range(0, len(array), BLOCK):
        part = array[at : at + BLOCK]
        if part.any():
            yield kind, at // BLOCK, part.astype(np.float32).tobytes()


def _add_rows(into: np.ndarray, rows: list[np.ndarray], values: np.ndarray) -> None:
    """Add row i of ``values`` to the row of ``into`` that each array of ``rows`` names at i."""
    width = into.shape[1]
    values = values.astype(np.float64).ravel()
    for r in rows:
        np.add.at(into.reshape(-1), (r[:, None] * width + np.arange(width)).ravel(), values)


def _gradient(model, observe: bool):
    """What the model expects of each weight row (in the first round also what was observed), in blocks of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        sums = {"expected": np.zeros(m.coarse.shape), "fine expected": np.zeros(m.fine.shape)}
        if observe:
            sums |= {"observed": np.zeros(m.coarse.shape), "fine observed": np.zeros(m.fine.shape)}
        rows = ([batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "n")] for batch in batches)
        for key, n in _gathered(rows, STEP):
            _observe(m, key, n.astype(np.float32), sums, observe)
        out = [row for kind, array in sums.items() for row in _blocks(kind, array)]
        kinds, blocks, values = zip(*out) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(kinds, pa.string()), pa.array(blocks, pa.int32()), pa.array(values, pa.binary())],
            ["kind", "block", "value"],
        )

    return run


def _observe(m: Model, key: np.ndarray, n: np.ndarray, sums: dict, observe: bool) -> None:
    symbols, classes = m.shape.symbols, m.shape.classes
    s = key % symbols
    cls = _class_of(s)
    context, inverse = np.unique(key // symbols, return_inverse=True)
    one, two = context // symbols, context % symbols
    total = np.bincount(inverse, weights=n, minlength=len(context)).astype(np.float32)
    rows = m.shape.rows(one, two)
    _add_rows(sums["expected"], rows, m.classes(one, two) * total[:, None])
    if observe:
        seen = np.zeros((len(context), classes), dtype=np.float32)
        np.add.at(seen, (inverse, cls), n)
        _add_rows(sums["observed"], rows, seen)
    head = s < HEAD
    if not head.any():
        return
    fine, inverse = np.unique((key[head] // symbols) * classes + cls[head], return_inverse=True)
    cls_f, ctx = fine % classes, fine // classes
    one, two = ctx // symbols, ctx % symbols
    total = np.bincount(inverse, weights=n[head], minlength=len(fine)).astype(np.float32)
    rows = m.shape.fine(one, two, cls_f)
    _add_rows(sums["fine expected"], rows, m.words(one, two, cls_f) * total[:, None])
    if observe:
        seen = np.zeros((len(fine), IN_CLASS), dtype=np.float32)
        np.add.at(seen, (inverse, s[head] % IN_CLASS), n[head])
        _add_rows(sums["fine observed"], rows, seen)


def _sum_blocks(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.sum([np.frombuffer(v, dtype=np.float32) for v in pdf["value"]], axis=0, dtype=np.float64)
    return pd.DataFrame({"kind": pdf["kind"].iloc[:1], "block": pdf["block"].iloc[:1], "value": [total.astype(np.float32).tobytes()]})


def train(docs: DataFrame, lexicon: Lexicon, rounds: int = ROUNDS) -> Model:
    """Fit on the texts of ``docs``; the driver sees sums per weight row only, a fixed number of them."""
    spark = docs.sparkSession
    shape = lexicon.shape
    lex = spark.sparkContext.broadcast(lexicon)
    part = map_batches(docs.select("text"), _symbol_counts(lex), "context bigint, symbol int, n bigint")
    # All counts of a context lie side by side: what the model expects there is computed once a round.
    counts = part.repartition("context").groupBy("context", "symbol").agg(F.sum("n").alias("n"))
    key = F.col("context") * shape.symbols + F.col("symbol")
    counts = stored(counts.select(key.alias("key"), "n").sortWithinPartitions("key"), "lm-contexts")
    by_symbol = counts.groupBy((F.col("key") % shape.symbols).cast("int").alias("s")).agg(F.sum("n").alias("n")).collect()
    seen = np.zeros(shape.symbols)
    for row in by_symbol:  # at most one per symbol
        seen[row["s"]] = row["n"]
    class_n = np.bincount(_class_of(np.arange(shape.start)), weights=seen[: shape.start], minlength=shape.classes)
    word_n = np.where(np.arange(HEAD) < lexicon.head, seen[:HEAD], -1)
    model = Model(class_n, word_n, shape)
    schema = "kind string, block int, value binary"
    # Each task sends sums of all weight rows: as many tasks as run at a time, however many files the counts have.
    at_once = counts.coalesce(spark.sparkContext.defaultParallelism)
    observed: dict[str, np.ndarray] = {}
    for r in range(rounds):
        sent = spark.sparkContext.broadcast(model)
        sums = {k: np.zeros(a.shape) for k, a in (("expected", model.coarse), ("fine expected", model.fine))}
        if not r:
            sums |= {"observed": np.zeros(model.coarse.shape), "fine observed": np.zeros(model.fine.shape)}
        parts = map_batches(at_once, _gradient(sent, not r), schema)
        for row in parts.groupBy("kind", "block").applyInPandas(_sum_blocks, schema).toLocalIterator():
            width = sums[row["kind"]].shape[1]
            part = np.frombuffer(row["value"], dtype=np.float32).reshape(-1, width)
            sums[row["kind"]][row["block"] * BLOCK : row["block"] * BLOCK + len(part)] = part
        sent.unpersist()
        observed |= {k: sums[k] for k in sums if k.endswith("observed")}
        for weights, name in ((model.coarse, "expected"), (model.fine, "fine expected")):
            seen_rows = observed[name.replace("expected", "observed")]
            weights += (RATE * np.log((seen_rows + PRIOR) / (sums[name] + PRIOR))).astype(np.float32)
    return model


def _score(lexicon, model, figures: dict):
    log_all = np.log10(figures["train_tokens"] + ADD * (figures["distinct"] + 1))
    tail_all = np.log10(np.array(figures["tail_n"]) + ADD * (np.array(figures["tail_words"]) + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex, m = lexicon.value, model.value
        symbols, classes = m.shape.symbols, m.shape.classes
        known = np.log10(lex.n + ADD)
        for batch in batches:
            ids = batch.column("doc_id")
            for docs, doc, h1, h2, tail, first in _streams(batch.column("text")):
                at = lex.find(h1, h2)
                s = lex.symbols(at, tail)
                cls = _class_of(s)
                context, inverse = np.unique(_contexts(s, h1, first, m.shape), return_inverse=True)
                value = np.empty(len(s))
                for lo in range(0, len(context), STEP):
                    pick = np.flatnonzero((inverse >= lo) & (inverse < lo + STEP))
                    ctx = context[lo : lo + STEP]
                    p = m.classes(ctx // symbols, ctx % symbols)
                    value[pick] = np.log10(p[inverse[pick] - lo, cls[pick]])
                head = np.flatnonzero(s < HEAD)
                fine, inverse = np.unique(context[inverse[head]] * classes + cls[head], return_inverse=True)
                for lo in range(0, len(fine), STEP):
                    pick = np.flatnonzero((inverse >= lo) & (inverse < lo + STEP))
                    f = fine[lo : lo + STEP]
                    ctx = f // classes
                    p = m.words(ctx // symbols, ctx % symbols, f % classes)
                    value[head[pick]] += np.log10(p[inverse[pick] - lo, s[head[pick]] % IN_CLASS])
                rare = s >= HEAD
                value[rare] -= tail_all[cls[rare] - HEAD_CLASSES]
                # Counts of words that are not sent out come by a join: for those, this holds all but log10(c + 0.1).
                listed = at >= 0
                own = np.where(listed, known[at], 0.0)
                value[rare] += own[rare]
                starts = first[:-1]
                left = np.flatnonzero(~listed)
                order, groups = _distinct(doc[left], h1[left], h2[left])
                seen = left[order[groups]]
                times = np.diff(np.append(groups, len(left)))
                per = np.searchsorted(doc[seen], np.arange(docs.start, docs.stop + 1))
                words_left = pa.StructArray.from_arrays(
                    [
                        pa.array(_signed(h1[seen])),
                        pa.array(_signed(h2[seen])),
                        pa.array(times.astype(np.int32)),
                    ],
                    ["h1", "h2", "n"],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([f"{x.hex()}" for x in _unique_ids(len(docs))]),
                        ids.slice(docs.start, len(docs)),
                        pa.array(np.diff(first).astype(np.int64)),
                        pa.array(np.add.reduceat((listed & (lex.n[at] > 0)).astype(np.int64), starts)),
                        pa.array(np.add.reduceat(own, starts) - np.diff(first) * log_all),
                        pa.array(np.add.reduceat(value, starts)),
                        pa.ListArray.from_arrays(pa.array(per.astype(np.int32)), words_left),
                    ],
                    ["row", "doc_id", "n_tokens", "n_known", "base_score", "score", "left"],
                )

    return run


def _unique_ids(n: int) -> list[bytes]:
    import os

    body = os.urandom(12 * n)
    return [body[12 * i : 12 * i + 12] for i in range(n)]


def lm_scores(docs: DataFrame, rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: token counts, unigram base score and model score (log10).

    Null text is empty: one token, the end. A null id is scored and trained on. Repeated rows
    are each scored and each trained on. With no training text every count is 0 and the
    scores are those of the pseudo-counts. Other columns are not looked at.
    """
    spark = docs.sparkSession
    texts = id_text(docs, id_col, text_col)
    learn = texts.filter(~held_out("doc_id", 10, 0))
    counts = word_counts(learn)
    total = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    shape = Shape.of(total["v"])
    lexicon = Lexicon(frequent(counts), shape)
    model = train(learn, lexicon, rounds)
    # Per tail class: tokens and distinct words of training text outside the modelled words.
    by_class = counts.groupBy((F.col("tail") % shape.tails).alias("tail")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    tail_n, tail_words = np.zeros(shape.tails), np.zeros(shape.tails)
    for row in by_class:
        tail_n[row["tail"]], tail_words[row["tail"]] = row["n"], row["v"]
    head = pd.DataFrame({"h1": _signed(lexicon.h1[: lexicon.head]), "h2": _signed(lexicon.h2[: lexicon.head])})
    listed = spark.createDataFrame(head, "h1 bigint, h2 bigint")  # at most HEAD rows
    for row in counts.join(F.broadcast(listed), ["h1", "h2"]).select("tail", "n").collect():
        tail_n[row["tail"] % shape.tails] -= row["n"]
        tail_words[row["tail"] % shape.tails] -= 1
    figures = {
        "train_tokens": total["n"] or 0,
        "distinct": total["v"],
        "tail_n": tail_n.tolist(),
        "tail_words": tail_words.tolist(),
    }
    lex, sent = spark.sparkContext.broadcast(lexicon), spark.sparkContext.broadcast(model)
    schema = (
        "row string, doc_id " + texts.schema["doc_id"].dataType.simpleString() + ", n_tokens bigint, n_known bigint, "
        "base_score double, score double, left array<struct<h1:bigint,h2:bigint,n:int>>"
    )
    scored = stored(map_batches(texts, _score(lex, sent, figures), schema), "lm-scored")
    # Only words too rare to be sent out are joined: none of them is a large share of the tokens.
    rare = scored.select("row", F.explode("left").alias("w")).select("row", "w.*")
    count = F.coalesce(F.col("c"), F.lit(0))
    found = rare.join(counts.select("h1", "h2", F.col("n").alias("c")), ["h1", "h2"], "left")
    added = found.groupBy("row").agg(
        F.sum(F.when(count > 0, F.col("n")).otherwise(0)).alias("k"),
        F.sum(F.col("n") * F.log10(count + F.lit(ADD))).alias("x"),
    )
    more_k, more = F.coalesce(F.col("k"), F.lit(0)), F.coalesce(F.col("x"), F.lit(0.0))
    return scored.drop("left").join(added, "row", "left").select(
        "doc_id",
        held_out("doc_id", 10, 0).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + more_k).alias("n_known"),
        F.lit(int(figures["train_tokens"])).cast("bigint").alias("train_tokens"),
        (F.col("base_score") + more).alias("base_score"),
        (F.col("score") + more).alias("score"),
    )
