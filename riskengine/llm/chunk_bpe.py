"""BPE encoding and decoding with content-defined chunks that are encoded once and reused.

A text is cut after a word whenever a rolling hash of that word and the one before it hits a
fixed residue, so equal passages are cut alike wherever they stand. A chunk met again in a
task, in whatever document, takes its ids from the task's store. A new chunk is put together
from its words, each encoded by the tokenizer once; words are cut at space and 0x09-0x0D
only, which the vocabulary's normaliser and splitter never join across.

Each join of two chunks is then checked: the words on both sides are encoded together and
compared with what was put together. If they differ, the window doubles on both sides until
it agrees or is the whole text, which then is encoded as one. Stores hold ids only, in a bounded number
of bytes, and are per Python worker, so nothing is shuffled; they forget what was not asked for of
late. Texts are decoded from their own ids, many at once.

New words, and new joins, go to the tokenizer 32 to a text, with a word of one id between that
tells them apart; a text that shows another number of that id is given again piece by piece.
Pieces of plain ASCII skip the normaliser where its steps do no more than lower-case them.

Only a vocabulary that marks the ends of words and decodes them with one space between
(``words_apart``) can be put together so; with any other, as a byte-level one whose tokens
hold spaces, each text is encoded whole.
"""

from __future__ import annotations

import hashlib
import json
import os
from array import array
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from riskengine.llm.frames import id_text, map_batches
from riskengine.llm.tokens import U64, binary_parts, mix, words

TEXT_BYTES = 1 << 17  # of the texts that are cut at once
RESIDUE = 64  # one cut in about so many words
WORDS_BYTES, STORE_BYTES = 64 << 20, 32 << 20  # of the store of words, and of each other
AT_ONCE = 256  # texts given to the tokenizer at once: what it returns takes 1 to 2 KB a word
IN_LINE = 32  # words or joins given to it as one text
PLAIN = bytes(range(0x20, 0x7F))

LISTS = 128  # texts whose ids and decoded text are returned at once
ENTRY_BYTES = 150  # of an entry, besides its key's and value's own bytes


class Store(dict):
    """A dict of at most ``most`` bytes of keys and values: once half are taken, it starts again beside what it held.

    Those of ``old`` that are asked for are taken over, so what comes often stays; the others go at the next start.
    """

    def __init__(self, most: int = STORE_BYTES):
        super().__init__()
        self.most, self.size, self.old = most, 0, {}

    def keep(self, more: dict) -> None:
        """Add pieces; nothing is looked up between this and the next texts."""
        size = sum(map(len, more)) + sum(map(len, more.values())) + ENTRY_BYTES * len(more)
        if self.size + size > self.most // 2:
            self.old = dict(self)
            self.clear()
            self.size = 0
        self.size += size
        self.update(more)


Piece = tuple[bytes, bytes]  # ids as little-endian 32-bit integers, decoded UTF-8
HOLDS, BREAKS = (b"1", b""), (b"", b"")  # one object each, however many joins are kept


def joined(pieces: list[Piece]) -> Piece:
    # Decoding puts one space between tokens; a piece without tokens leaves none.
    return b"".join([p[0] for p in pieces]), b" ".join([p[1] for p in pieces if p[0]])


def words_apart(spec: str, tokenizer: Tokenizer) -> bool:
    """Whether a text's ids are those of its words one by one, by the file's settings and by a probe of each white space."""
    settings = json.loads(spec)
    if not settings["model"].get("end_of_word_suffix") or settings.get("decoder") is not None:
        return False

    def ids(text: str) -> list[int]:
        return tokenizer.encode(text, add_special_tokens=False).ids

    return all(ids(f"{space}on{space}{space}he 1{space}") == ids("on") + ids("he") + ids("1") for space in " \t\n\v\f\r")


def mark(settings: dict, tokenizer: Tokenizer) -> tuple[str, int] | None:
    """A word of letters that is encoded as one id of its own, of the rarest of the vocabulary, and that id."""
    suffix = settings["model"]["end_of_word_suffix"]
    for token, i in sorted(tokenizer.get_vocab(with_added_tokens=False).items(), key=lambda entry: -entry[1]):
        word = token.removesuffix(suffix)
        if word != token and word.isascii() and word.isalpha() and tokenizer.encode(f"1 {word} 1", add_special_tokens=False).ids[1:-1] == [i]:
            return word, i
    return None


def plain_steps(normalizer: dict | None) -> set[str] | None:
    """The kinds of steps of a normaliser, if none of them does more to words of ``PLAIN`` with one space between than lower-case them."""
    if normalizer is None:
        return set()
    steps = normalizer["normalizers"] if normalizer["type"] == "Sequence" else [normalizer]
    space = {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}
    known = all(s == space or s["type"] in ("NFC", "NFD", "NFKC", "NFKD", "Lowercase") for s in steps)
    return {s["type"] for s in steps} if known else None


class Encoder:
    mark = plain = None  # see ``mark``; the tokenizer without its normaliser, for plain texts

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core already
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.words_apart = words_apart(spec, self.tokenizer)
        if self.words_apart:
            settings = json.loads(spec)
            self.mark = mark(settings, self.tokenizer)
            steps = plain_steps(settings.get("normalizer"))
            if steps is not None:
                self.plain = Tokenizer.from_str(json.dumps({**settings, "normalizer": None, "truncation": None, "padding": None}))
                self.fold = str.lower if "Lowercase" in steps else str
                self.added = [self.fold(t["content"]) for t in settings.get("added_tokens") or []]  # looked for in the text as it was
        tokens = {i: t.encode("utf-8") + b" " for t, i in self.tokenizer.get_vocab(with_added_tokens=True).items()}
        self.tokens = pa.array([tokens.get(i, b"") for i in range(max(tokens, default=-1) + 1)], pa.large_binary())
        self.words, self.chunks, self.joins = Store(WORDS_BYTES), Store(), Store()

    def whole(self, texts: list[bytes]) -> list[Piece]:
        """Pieces of texts as the tokenizer itself encodes and decodes them."""
        out = []
        for a in range(0, len(texts), AT_ONCE):
            part = [t.decode("utf-8", "replace") for t in texts[a : a + AT_ONCE]]
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            packed = [array("I", i).tobytes() for i in ids]
            if self.words_apart:
                out += zip(packed, self.decoded(packed))
            else:
                said = self.tokenizer.decode_batch(ids, skip_special_tokens=False)
                out += [(i, s.encode("utf-8")) for i, s in zip(packed, said)]
        return out

    def side_by_side(self, texts: list[bytes]) -> list[bytes]:
        """The ids of words or joins, many encoded as one text with the mark between them."""
        if self.mark is None:
            return [p[0] for p in self.whole(texts)]
        word, own = self.mark
        between = f" {word} ".encode()
        plain = [self.plain is not None and not t.translate(None, PLAIN) and b"  " not in t for t in texts]
        out: dict[int, bytes] = {}
        for kind in (True, False):
            at = [i for i, k in enumerate(plain) if k == kind]
            lines = [at[a : a + IN_LINE] for a in range(0, len(at), IN_LINE)]
            for a in range(0, len(lines), AT_ONCE // IN_LINE):
                part = lines[a : a + AT_ONCE // IN_LINE]
                given = [between.join([texts[i] for i in line]).decode("utf-8", "replace") for line in part]
                tokenizer, folded = self.tokenizer, list(map(self.fold, given)) if kind else []
                if kind and not any(t in line for t in self.added for line in folded):
                    tokenizer, given = self.plain, folded
                for line, found in zip(part, tokenizer.encode_batch_fast(given, add_special_tokens=False)):
                    ids = np.array(found.ids, dtype="<u4")
                    marks = np.flatnonzero(ids == own)
                    if len(marks) == len(line) - 1:
                        body, ends = ids.tobytes(), (4 * marks).tolist()
                        out.update(zip(line, [body[x:y] for x, y in zip([0, *[e + 4 for e in ends]], [*ends, len(body)])]))
                    else:  # a text holds the mark itself
                        out.update(zip(line, [p[0] for p in self.whole([texts[i] for i in line])]))
        return [out[i] for i in range(len(texts))]

    def decoded(self, packed: list[bytes]) -> list[bytes]:
        """What a tokenizer without a decoder makes of ids: their tokens with one space between."""
        said = self.tokens.take(pa.array(np.frombuffer(b"".join(packed), dtype="<u4")))
        data, offsets = binary_parts(said)
        data, ends = data.tobytes(), offsets[np.cumsum([0, *map(len, packed)]) // 4].tolist()
        return [data[a : b - 1] if b > a else b"" for a, b in zip(ends, ends[1:])]

    def looked_up(self, store: Store, keys: list[bytes], make) -> list:
        """What ``make`` gives for each of ``keys``; those not in the store are made together and kept there."""
        found = list(map(store.get, keys))
        lost = [i for i, v in enumerate(found) if v is None]
        if lost:
            fresh = {k: store.old.get(k) for k in dict.fromkeys([keys[i] for i in lost])}
            new = [k for k, v in fresh.items() if v is None]
            if new:
                fresh.update(zip(new, make(new)))
            for i in lost:
                found[i] = fresh[keys[i]]
            store.keep(fresh)
        return found

    def alone(self, bodies: list[bytes]) -> Iterator[bytes]:
        """The ids of the words of each body, each encoded alone, end to end."""
        split = [b.split() for b in bodies]
        ids = iter(self.looked_up(self.words, list(chain.from_iterable(split)), self.side_by_side))
        return (b"".join(islice(ids, len(parts))) for parts in split)

    def new_chunks(self, bodies: list[bytes]) -> list[bytes]:
        """The ids of chunks."""
        return list(self.alone(bodies))

    def new_joins(self, windows: list[bytes]) -> list[Piece]:
        """(1 if the two words of a window encode together as they do alone, else nothing; nothing)."""
        return [HOLDS if together == apart else BREAKS for together, apart in zip(self.side_by_side(windows), self.alone(windows))]

    def repaired(self, text: bytes, start: list[int], end: list[int], joins: list[int]) -> Piece:
        """Pieces of a text some of whose joins don't hold, by re-encoding windows of words around them.

        A window doubles until the words at both its rims come out as they do alone; one that
        reaches back into what is already settled, or either end, makes the whole text one window.
        """
        n, taken, done = len(start), [], 0

        def alone(low: int, high: int) -> list[Piece]:
            parts = [text[a:b] for a, b in zip(start[low:high], end[low:high])]
            distinct = list(dict.fromkeys(parts))
            known = dict(zip(distinct, self.whole(distinct)))
            return [known[w] for w in parts]

        for at in joins:
            if at < done:
                continue
            width = 2
            while True:
                low, high = at - width, at + width
                if low <= done or high >= n:
                    return self.whole([text[start[0] : end[-1]]])[0]
                window = self.whole([text[start[low] : end[high - 1]]])[0]
                if window[0].startswith(alone(low, low + 1)[0][0]) and window[0].endswith(alone(high - 1, high)[0][0]):
                    break
                width *= 2
            taken += [*alone(done, low), window]
            done = high
        return joined([*taken, *alone(done, n)])


_encoders: dict[int, Encoder] = {}


def _encoder(spec: str) -> Encoder:
    """One encoder per Python worker and vocabulary, kept for the tasks to come."""
    key = hash(spec)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(spec)
    return _encoders[key]


def encoded(column: pa.Array, encoder: Encoder) -> Iterator[Piece]:
    """(ids, decoded text) of each text of a binary column."""
    if not encoder.words_apart:
        yield from encoder.whole(column.to_pylist())
        return
    for w in words(column, TEXT_BYTES, lower=False):
        h = w.hashes(0)
        cut = np.zeros(len(h) + 1, dtype=bool)
        if len(h) > 1:  # a cut before word i hangs on words i - 1 and i - 2
            cut[1:-1] = mix(h[:-1] * U64(3) + np.concatenate((h[:1], h[:-2]))) % U64(RESIDUE) == U64(0)
        cut[w.first] = True
        text = w.low.tobytes()
        start, end = w.start.tolist(), w.end.tolist()
        edges = np.flatnonzero(cut[: len(h)]).tolist() + [len(h)]  # first words of chunks
        bodies = [text[start[x] : end[y - 1]] for x, y in zip(edges, edges[1:])] if len(h) else []
        at_text = np.zeros(len(h) + 1, dtype=bool)
        at_text[w.first] = True
        joins = [x for x in edges[:-1] if not at_text[x]]
        windows = [text[start[x - 1] : end[x]] for x in joins]
        chunks = encoder.looked_up(encoder.chunks, bodies, encoder.new_chunks)
        holds = encoder.looked_up(encoder.joins, windows, encoder.new_joins)
        broken = [x for x, (held, _) in zip(joins, holds) if not held]
        first_chunk = np.searchsorted(edges, w.first).tolist()
        ids = [b"".join(chunks[a:b]) for a, b in zip(first_chunk, first_chunk[1:])]
        said = encoder.decoded(ids)
        for i in range(len(w.docs)):
            a, b = int(w.first[i]), int(w.first[i + 1])
            bad = [x - a for x in broken if a < x < b] if broken else []
            if bad:
                yield encoder.repaired(text, start[a:b], end[a:b], bad)
            else:
                yield ids[i], said[i]


def _digest(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(sent.value)
        for batch in batches:
            n, ids, said = [], [], []
            for a, b in encoded(batch.column("text"), encoder):
                n.append(len(a) // 4)
                ids.append(hashlib.sha256(a).hexdigest())
                said.append(hashlib.sha256(b).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(said, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def _lists(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(sent.value)
        for batch in batches:
            found = encoded(batch.column("text"), encoder)
            for at in range(0, batch.num_rows, LISTS):
                part = batch.column("doc_id").slice(at, LISTS)
                ids, said = zip(*islice(found, len(part)))
                offsets = np.cumsum([0, *map(len, ids)]) // 4
                flat = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"))
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)
                decoded = pa.array(said, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([part, lists, decoded], ["doc_id", "ids", "decoded"])

    return run


def _send(docs: DataFrame, vocabulary: str):
    with open(vocabulary, encoding="utf-8") as f:  # a file of the driver; executors get its contents
        return docs.sparkSession.sparkContext.broadcast(f.read())


def bpe(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded) per input row, equal to the tokenizer's own encoding and decoding.

    ``vocabulary`` is the path of a tokenizer file. Null and empty text have no ids and an
    empty decoded text; repeated rows each give a row; other columns are not looked at.
    """
    texts = id_text(docs, id_col, text_col)
    id_type = texts.schema["doc_id"].dataType.simpleString()
    return map_batches(texts, _lists(_send(docs, vocabulary)), f"doc_id {id_type}, ids array<int>, decoded string")


def bpe_digests(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``bpe``, with the SHA-256 of ids and decoded text in place of them."""
    texts = id_text(docs, id_col, text_col)
    id_type = texts.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return map_batches(texts, _digest(_send(docs, vocabulary)), schema)
