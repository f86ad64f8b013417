"""The parts of the methods that SQL cannot hold to account, against brute force."""

import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from riskengine.llm import chunk_bpe, containment as C, pii_tagger as P, simhash as S, suffixes as X
from riskengine.llm.components import components
from riskengine.llm.frames import table
from riskengine.llm.ftrl_langid import language_id
from riskengine.llm.importance import kth_largest, resampled
from riskengine.llm.line_windows import remove_repeated_windows
from riskengine.llm.maxent_lm import HEAD, Shape, _add_rows, _contexts, lm_scores


def test_covering_masks_lose_no_pair():
    rng = random.Random(4)
    pairs = [rng.sample(range(64), k) for k in (1, 2, 3) for _ in range(500)]
    for where in pairs:
        differ = sum(1 << p for p in where)
        hit = [i for i, m in enumerate(S.MASKS) if not differ & m]
        assert hit
        assert any(not differ & m for i in hit for m in S.FINER[i])
    assert min(m.bit_count() for m in S.MASKS) >= 32
    assert min(m.bit_count() for row in S.FINER for m in row) >= 48


def test_links_of_large_buckets_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    base = int(rng.integers(0, 2**63))
    fps = {base}
    while len(fps) < 300:
        fps.add(random.choice(sorted(fps)) ^ sum(1 << int(b) for b in set(rng.integers(0, 64, int(rng.integers(1, 6))))))
    ids = sorted(fps)
    parent = {x: x for x in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(ids, 2):
        if (a ^ b).bit_count() <= 3:
            parent[max(root(a), root(b))] = min(root(a), root(b))
    groups = Counter(root(x) for x in ids if sum(root(y) == root(x) for y in ids) > 1)
    signed = [(x - 2**64 if x >= 2**63 else x,) for x in ids]
    for bucket in (2048, 3):  # the second sends every larger bucket to the finer tables
        found = components(S.links(spark.createDataFrame(signed, "fp bigint"), bucket))
        assert sorted(r["n"] for r in found.groupBy("root").agg(F.count("*").alias("n")).collect()) == sorted(groups.values())


def test_fingerprints(spark, tiny_dir):
    docs = table(spark, tiny_dir, "documents")
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    for r in S.near_duplicates(docs).collect():
        w = texts[r.doc_id].encode().lower().split()
        h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
        assert int(r.fingerprint, 16) == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("seed", range(40))
def test_suffix_order(seed):
    rng = random.Random(seed)
    text = bytes(rng.choice(b"abc"[: 1 + seed % 3]) for _ in range(rng.randint(1, 80))) * (1 + seed % 2)
    order = X.suffix_order(np.frombuffer(text, np.uint8).astype(np.int64), 256, 400)
    assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def without(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        out.append((len(t), int(gone.sum()), int(np.count_nonzero(np.diff(np.r_[0, gone.astype(int)]) == 1))))
    return out


@pytest.mark.parametrize("limit, most", [("RUNS", X.RUNS), ("RUNS", 1), ("MOST_BYTES", 1000)])
def test_repeats_equal_brute_force(spark, tiny_dir, limit, most, monkeypatch):
    monkeypatch.setattr(X, limit, most)  # small: anchors with different or long runs take the way for hot ones
    docs = table(spark, tiny_dir, "documents")
    texts = {r.doc_id: (r.text or "").encode() for r in docs.select("doc_id", "text").collect()}
    expected = dict(zip(texts, without(list(texts.values()), 400)))
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in X.without_repeats(docs).collect()}
    assert found == expected and sum(x[1] for x in found.values()) > 0


def test_passages_go_from_400_bytes_on(spark):
    """Planted once in each of two texts: a shorter passage stays, whatever its number of words."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5))
    texts, planted = [], {}
    for size in (300, 306, 350, 390, 399, 400, 401, 450, 600):
        passage = " ".join(word() for _ in range(120))[:size]
        assert size < 306 or len(passage.split()) > 50
        for _ in range(2):
            own = chr(ord("A") + len(texts))  # a letter of its own ends the passage on both sides
            texts.append((len(texts), " ".join(word() for _ in range(30)) + own + passage + own + word()))
            planted[len(texts) - 1] = size
    found = {r.doc_id: r for r in X.without_repeats(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()}
    for i, size in planted.items():
        assert found[i].n_removed == (size if size >= 400 else 0) and found[i].n_bytes == len(texts[i][1])


def test_repeats_of_a_periodic_text(spark, monkeypatch):
    monkeypatch.setattr(X, "MOST_BYTES", 5000)
    monkeypatch.setattr(X, "PLACES", 1000)
    texts = [(1, "ab" * 20_000), (2, "a" * 399), (3, "x" + "ab" * 150)]
    found = {r.doc_id: tuple(r)[1:4] for r in X.without_repeats(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()}
    assert found == {1: (40_000, 40_000, 1), 2: (399, 0, 0), 3: (301, 0, 0)}


def test_base_scores_equal_brute_force_and_the_model_beats_them(spark, tiny_dir):
    docs = table(spark, tiny_dir, "documents")
    texts = {r.doc_id: (r.text or "").encode().lower().split() + [None] for r in docs.select("doc_id", "text").collect()}
    train = Counter(w for i, ws in texts.items() if zlib.crc32(str(i).encode()) % 10 for w in ws)
    total = np.log10(train.total() + 0.1 * (len(train) + 1))
    rows = lm_scores(docs).collect()
    for r in rows:
        ws = texts[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(train[w] > 0 for w in ws), train.total())
        assert r.base_score == pytest.approx(sum(np.log10(train[w] + 0.1) - total for w in ws), rel=1e-9)
    unseen = [r for r in rows if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


def test_model_sizes_follow_the_distinct_words():
    shapes = [Shape.of(n) for n in (0, 10**5, 10**6, 10**7, 10**8, 10**9)]
    for small, large in itertools.pairwise(shapes):
        assert all(a <= b for a, b in zip(small, large))
    assert len(set(shapes[:-1])) > 3 and shapes[0].near >= shapes[0].tails
    largest = Shape.of(10**12)  # the bound on memory
    assert (largest.coarse_rows * largest.classes + largest.fine_rows * 32) * (2 * 8 + 4) < 270e6


def test_contexts_know_rarer_words_by_their_hash():
    shape = Shape(32, 256, 1 << 13, 1 << 15)
    symbol, h = np.array([3, HEAD + 5, 7, 0, 9]), np.array([1, 2**64 - 3, 8, 9, 10], dtype=np.uint64)
    found = _contexts(symbol, h, np.array([0, 4, 5]), shape)  # texts of four tokens and of one
    one, two = found // shape.symbols, found % shape.symbols
    bucket = HEAD + 5 * 8 + (2**64 - 3) % 8
    assert one.tolist() == [shape.befores - 1, 3, bucket, 7, shape.befores - 1]
    assert two.tolist() == [shape.start, shape.start, 3, HEAD + 5, shape.start]
    assert shape.symbol_of(one).tolist() == [shape.start, 3, HEAD + 5, 7, shape.start]


def test_sums_per_weight_row():
    rng = np.random.default_rng(3)
    rows, values, into = [rng.integers(0, 9, 50) for _ in range(3)], rng.random((50, 4), dtype=np.float32), np.ones((9, 4))
    expected = np.ones((9, 4))
    for r in rows:
        for i, x in zip(r, values):
            expected[i] += x
    _add_rows(into, rows, values)
    assert into == pytest.approx(expected)


def test_tagger_gradient():
    t = P.Tagger(3)
    rng = np.random.default_rng(0)
    codes, tags = rng.integers(0, P.CODES, (3, 6)), rng.integers(0, P.TAGS, (3, 6))
    t.p = {n: a.astype(np.float64) for n, a in t.p.items()}
    _, g = t.gradient(codes, tags)
    for name, a in t.p.items():
        at = np.unravel_index(np.abs(g[name]).argmax(), g[name].shape)
        was, e = a[at], 1e-3
        a[at] = was + e
        up = t.gradient(codes, tags)[0]
        a[at] = was - e
        down = t.gradient(codes, tags)[0]
        a[at] = was
        assert g[name][at] == pytest.approx((up - down) / (2 * e), rel=2e-2, abs=1e-4)


def test_skipped_windows_give_no_span():
    t = P.Tagger(5)
    text = "words without any sign of data, " * 40 + "call 743-555-3824 now " + "and more words " * 40
    base = P.base_spans(text)
    every = []
    for s in P.window_starts(len(text)):
        w = np.full(P.WIDTH, P.PAD)
        c = P.codes(text[s : s + P.WIDTH])
        w[: len(c)] = c
        path, lead = t.decode(w[None])
        every += P.spans_of(path[0], lead[0], s, len(text))
    assert P.added_spans([text], [base], t)[0] == P.reconciled(text, base, every)


@pytest.mark.parametrize("address", ["jane.doe [at] example.com", "jane.doe(at)example.com", "jane.doe (at) example.com"])
def test_windows_with_a_spelled_out_at_sign_are_decoded(address):
    class Seeing(P.Tagger):
        """Tags the address wherever a window holds it whole."""

        def decode(self, codes):
            path = np.zeros(codes.shape, dtype=np.int64)
            for row, window in zip(path, codes):
                for i in range(P.WIDTH - len(address) + 1):
                    if (window[i : i + len(address)] == P.codes(address)).all():
                        row[i : i + len(address)] = 2
                        row[i] = 1
            return path, np.ones(codes.shape)

    for shift in range(P.STRIDE):
        text = "words only, " * 10 + "x" * shift + " write to " + address + " please" + ", words only" * 10
        at = text.index(address)
        assert P.added_spans([text], [[]], Seeing()) == [[(0, at, at + len(address))]]
    assert re.search(P.MARK, text)


@pytest.mark.parametrize("length", [41, 50, 79, 120, 329])
def test_long_addresses_are_found_at_every_offset(length):
    class Seeing(P.Tagger):
        """Tags what a window holds of the address: all but spaces and semicolons."""

        def decode(self, codes):
            own = ~np.isin(codes, [*P.codes("; "), P.PAD])
            before = np.pad(own, ((0, 0), (1, 0)))[:, :-1]
            return np.where(own, np.where(before, 2, 1), 0), np.ones(codes.shape)

    address = "firstname.lastname(at)" + ("mail." * length)[: length - 25] + "com"
    for shift in range(P.STRIDE):
        text = "; " * 200 + ";" * shift + " " + address + " " + "; " * 200
        at = text.index(address)
        assert P.added_spans([text], [[]], Seeing()) == [[(0, at, at + length)]]


def test_base_spans():
    text = "a@b.c 1.2.3.256 10.0.0.1, 4111 1111 1111 1111 x +1 (743) 555-3824, 4111111111111112"
    assert P._said(P.base_spans(text)) == "email:0:5,ip:16:24,card:26:45,phone:48:65"


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


@pytest.mark.parametrize("seed", range(20))
def test_base_spans_equal_the_patterns(seed):
    rng = random.Random(seed)
    for _ in range(300):
        text = "".join(rng.choice("a1._@ -+é"[: 5 + seed % 5]) for _ in range(rng.randint(1, 60)))
        spans = P.base_spans(text)
        assert [s[1:] for s in spans if s[0] == 0] == [m.span() for m in EMAIL.finditer(text)]
        assert [s[1:] for s in spans if s[0] == 1] == [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]


def test_base_spans_of_long_runs():
    run = 300_000
    spans = P.base_spans("a" * run + " x@y.z " + "1" * run + " " + "0" * 5000 + ".1.2.3")
    assert spans == [(0, run + 1, run + 6), (1, 2 * run + 8, 2 * run + 5014)]


def test_joins_that_do_not_hold_are_repaired():
    class Glue:
        """A stand-in whose words stick together: 'b c' is one token."""

        def __call__(self, texts):
            out = []
            for t in texts:
                ws = t.split()
                ids, i = [], 0
                while i < len(ws):
                    two = ws[i] == b"b" and ws[i + 1 : i + 2] == [b"c"]
                    ids.append(b" ".join(ws[i : i + 1 + two]))
                    i += 1 + two
                out.append((b"".join(len(x).to_bytes(4, "little") for x in ids), b" ".join(ids)))
            return out

    encoder = chunk_bpe.Encoder.__new__(chunk_bpe.Encoder)
    encoder.words, encoder.chunks, encoder.joins = chunk_bpe.Store(), chunk_bpe.Store(), chunk_bpe.Store()
    encoder.whole = Glue()
    text = b"a a a a a a b c a a a a a a"
    start = list(range(0, len(text), 2))
    end = [s + 1 for s in start]
    assert encoder.new_joins([b"b c", b"a a"]) == [(b"", b""), (b"1", b"")]
    assert encoder.repaired(text, start, end, [7]) == encoder.whole([text])[0]


def test_stores_take_no_more_memory_than_they_count():
    import sys

    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        encoder = chunk_bpe.Encoder(f.read())
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choices("abcdeghinorst", k=rng.randint(3, 9))) for _ in range(2000)) for _ in range(15)]
    found = list(chunk_bpe.encoded(pa.array([t.encode() for t in texts], pa.binary()), encoder))
    expected = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [a for a, _ in found] == [np.array(e.ids, "<u4").tobytes() for e in expected]
    assert [b.decode() for _, b in found] == encoder.tokenizer.decode_batch([e.ids for e in expected], skip_special_tokens=False)

    def taken(x):
        return sys.getsizeof(x) + (sum(map(taken, x)) if isinstance(x, tuple) else 0)

    for store in (encoder.words, encoder.chunks, encoder.joins):
        values = {id(v): v for v in store.values()}.values()
        assert 100 < len(store) and sys.getsizeof(store) + sum(map(taken, store)) + sum(map(taken, values)) <= 1.1 * store.size

def test_frequent_words_are_encoded_once_though_the_store_starts_again():
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        encoder = chunk_bpe.Encoder(f.read())
    between = f" {encoder.mark[0]} " if getattr(encoder, "mark", None) else None
    alone = Counter()

    class Counting:
        def __init__(self, tokenizer):
            self.tokenizer = tokenizer

        def encode_batch(self, texts, **how):
            alone.update(w for t in texts for w in (t.split(between) if between else [t]) if " " not in w)
            return self.tokenizer.encode_batch(texts, **how)

    Counting.encode_batch_fast = Counting.encode_batch
    expected = encoder.tokenizer.encode
    encoder.tokenizer, encoder.plain = Counting(encoder.tokenizer), Counting(getattr(encoder, "plain", None))
    encoder.words = chunk_bpe.Store(100_000)
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdeghinorst\u00e9", k=8))
    often = [word() for _ in range(50)]
    for _ in range(40):
        parts = often + [word() for _ in range(150)]
        rng.shuffle(parts)
        [(ids, _)] = chunk_bpe.encoded(pa.array([" ".join(parts).encode()], pa.binary()), encoder)
        assert ids == np.array(expected(" ".join(parts), add_special_tokens=False).ids, "<u4").tobytes()
    assert all(alone[w] == 1 for w in often) and len(encoder.words) < 600


def test_words_side_by_side_are_encoded_as_alone():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        encoder = chunk_bpe.Encoder(f.read())
    tokenizer, mark = Tokenizer.from_file(path), encoder.mark[0]
    odd = [mark, mark.upper(), f"{mark},{mark}", f"{mark} {mark}", "<|endoftext|>", "<|ENDOFTEXT|>", "x<|endoftext|>y", "It's", "'S", "a  b", "A\tb", "a\n b"]
    odd += ["", "\u0301a", "e\u0301", "\u212b", "\u0130", "\u03a3", "\x00", "\x1c", "\x85", "\u3000", "(987)", "12.5%", "\U0001f600!", "The", "ZEBRA"]
    texts = [t.encode() for x in odd for t in (x, "of", "Plain")]
    given = texts * 3 + [b"plain"] * 70
    assert encoder.side_by_side(given) == [np.array(tokenizer.encode(t.decode(), add_special_tokens=False).ids, "<u4").tobytes() for t in given]


@pytest.mark.parametrize("together", [C.ITEMS, 1])
def test_items_of_a_text_in_several_groups(spark, tiny_dir, together, monkeypatch):
    monkeypatch.setattr(C, "ITEMS", together)
    docs, items = table(spark, tiny_dir, "documents"), table(spark, tiny_dir, "benchmark")
    one = docs.agg(F.lit(-1).cast("bigint").alias("doc_id"), F.lit(" ").alias("text")).crossJoin(
        items.agg(F.concat_ws(" ", F.sort_array(F.collect_list("text"))).alias("every"))
    )
    everything = docs.select("doc_id", "text").union(one.select("doc_id", "every"))
    found = {(r.doc_id, r.item_id) for r in C.contaminated(everything, items).collect()}
    shingles = lambda w, k: {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}
    split = {r.item_id: (r.text or "").encode().lower().split() for r in items.collect()}
    expected = set()
    for r in everything.collect():
        words = (r.text or "").encode().lower().split()
        own = {k: shingles(words, k) for k in range(1, 6)}
        for i, w in split.items():
            k = min(5, len(w))
            if w and len(own[k] & shingles(w, k)) >= 0.8 * len(shingles(w, k)) - 1e-9:
                expected.add((r.doc_id, i))
    assert found == expected and sum(d == -1 for d, _ in found) > 1


def test_kth_largest(spark):
    values = [float(x % 97) for x in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for k in (1, 40, 1500, 3000):
        assert kth_largest(df, "x", k, few=5) == sorted(values, reverse=True)[k - 1]


def test_languages_of_held_out_texts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = language_id(docs).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    assert found.filter("lang = lang_pred").count() > 0.95 * found.count()


def test_rejects_go_and_good_texts_stay(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    found = resampled(table(spark, sf_dir, "documents"), labels).join(labels, "doc_id")
    share = {r.quality: r.kept for r in found.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[0] < 0.1 and share[1] > 0.9


def test_words_of_texts():
    from riskengine.llm.tokens import HashIndex, words

    texts = [b"", b"The  the\tEND", b"\xc3\x89t\xc3\xa9 x" * 5, b" ", b"a"]
    for chunk in (1, 20, 1 << 20):
        found, hashes = [], {}
        for w in words(pa.array(texts, pa.binary()), chunk):
            for i, (s, e, h) in enumerate(zip(w.start, w.end, w.hashes())):
                word = w.low[s:e].tobytes()
                found.append((int(w.doc[i]), word))
                assert hashes.setdefault(word, h) == h
        assert found == [(i, x) for i, t in enumerate(texts) for x in t.lower().split()]
    keys = np.random.default_rng(2).integers(0, 2**63, 1000).astype(np.uint64)
    index = HashIndex(keys)
    assert (keys[index.find(keys)] == keys).all() and (index.find(keys + np.uint64(1))[:5] == -1).all()


def test_lines_of_a_long_repeated_text(spark):
    passage = "\n".join(f"line {i}" for i in range(60_000))
    rows = [(1, passage), (2, f"own\n{passage}\nlast"), (3, "line 7\nline 8")]
    found = {r.row.doc_id: r for r in remove_repeated_windows(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert (found[1].kept_text, found[1].n_removed) == (passage, 0)
    assert (found[2].kept_text, found[2].n_removed) == ("own\nlast", 60_000)
    assert (found[3].kept_text, found[3].n_lines) == ("line 7\nline 8", 2)


def test_rows_meet_their_covered_lines_with_one_copy_of_the_text(spark):
    docs = spark.createDataFrame([(1, "a\nb\nc"), (2, "a\nb\nc")], "doc_id bigint, text string")
    node = remove_repeated_windows(docs)._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "Join":
        node = node.children().head()
    output = node.children().head().output()
    types = [output.apply(i).dataType().json() for i in range(output.size())]
    assert sum(t.count('"string"') for t in types) == 1
