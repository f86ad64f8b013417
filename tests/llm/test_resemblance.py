"""The pipeline's near duplicates against brute-force Jaccard similarity of five-word shingles."""

import itertools
import random

import corpus_pipeline as CP
import pytest

from riskengine.llm import resemblance as R
from riskengine.llm.frames import table


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def kept(texts):
    """Smallest id of every group tied by a similarity of 0.8 or more, and the number of links."""
    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in sets}
    n = 0

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x == y or 5 * len(x & y) >= 4 * len(x | y):
            root[max(top(a), top(b))] = min(top(a), top(b))
            n += x != y
    return {i for i in root if root[i] == i}, n


@pytest.mark.parametrize("seed", range(2))
def test_edited_copies(spark, seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") + str(rng.randrange(400))
    texts = {}
    while len(texts) < 240:
        base = [word() for _ in range(rng.choice((3, 9, 40, 90, 300)))]
        for _ in range(rng.randint(1, 8)):
            own = list(base)
            for _ in range(rng.randint(0, 1 + len(base) // 30)):
                own[rng.randrange(len(own))] = word()
            texts[len(texts)] = " ".join(own[rng.randint(0, 1) :])
    texts[len(texts)], texts[len(texts)] = "", None
    expected, links = kept(texts)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    assert {r.doc_id for r in CP.near_dedup(spark, docs, "").collect()} == expected and links > 20


def test_given_texts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    expected, links = kept({r.doc_id: r.text for r in docs.collect()})
    assert {r.doc_id for r in CP.near_dedup(spark, docs, sf_dir).collect()} == expected and links > 5


def unlike_family(n, seed=3, edits=3):
    """Texts of 160 words with ``edits`` changed words each: five-word sets 0.68 to 0.82 similar with 3, 0.77 to 0.88 with 2."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(160)]
    texts = {}
    for i in range(n):
        own = list(base)
        for at in rng.sample(range(0, 160, 5), edits):
            own[at] = f"x{rng.randrange(10**6)}"
        texts[i] = " ".join(own)
    return texts


def checked_rows(spark, texts, monkeypatch):
    """Kept ids, and the rows that met in tasks and that came out of them."""
    seen = []
    plain = R.stored

    def counted(df, name):
        out = plain(df, name)
        if name == "links":
            seen.append(out.count())
        return out

    monkeypatch.setattr(R, "stored", counted)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    return {r.doc_id for r in CP.near_dedup(spark, docs, "").collect()}, sum(seen)


@pytest.mark.parametrize("n", [100, 400])
def test_a_family_below_the_threshold_gives_no_pairs(spark, monkeypatch, n):
    texts = unlike_family(n)
    expected, links = kept(texts)
    found, rows = checked_rows(spark, texts, monkeypatch)
    assert found == expected and links < n and rows <= 10 * n


@pytest.mark.parametrize("run", [R.RUN, 40])
def test_links_grow_with_the_nodes_and_not_their_pairs(spark, monkeypatch, run):
    monkeypatch.setattr(R, "RUN", run)  # 40: a key's nodes meet in several pairs of blocks
    texts = unlike_family(300, edits=2)
    expected, links = kept(texts)
    found, rows = checked_rows(spark, texts, monkeypatch)
    assert found == expected and links > 1000 and rows <= R.BANDS * len(texts) * (1 + len(texts) // run)


def test_no_documents(spark, no_docs):
    assert R.one_per_group(no_docs).count() == 0
    assert CP.near_dedup(spark, no_docs, "").count() == 0


@pytest.mark.parametrize("seed", range(30))
def test_links_in_run_connect_what_all_pairs_connect(seed):
    import numpy as np

    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, 60).astype(np.uint64)
    sets = []
    for _ in range(25):
        own = base[rng.random(60) < rng.choice([0.95, 0.85])]
        sets.append(np.unique(np.concatenate((own, rng.integers(0, 2**63, rng.integers(0, 4)).astype(np.uint64), base[:1]))))
    root = np.arange(25) // rng.integers(1, 4)
    tie = {i: int(r) for i, r in enumerate(root)}

    def merged(links):
        names = dict(tie)
        for a, b in links:
            old, new = names[b], names[a]
            names = {i: new if x == old else x for i, x in names.items()}
        return {frozenset(i for i in names if names[i] == x) for x in names.values()}

    every = [(a, b) for a, b in itertools.combinations(range(25), 2) if R.similar(sets[a], sets[b])]
    found = list(zip(*R.links_in_run(np.arange(25), root, sets)))
    assert merged(found) == merged(every) and len(found) < 25 and set(map(frozenset, found)) <= set(map(frozenset, every))


def test_simhash_alone_ties_what_lies_within_its_bits(spark):
    """Without MinHash keys the nodes are tied by fingerprints at 3 bits or fewer, checked on the sets."""
    from pyspark.sql import functions as F

    rng = random.Random(5)
    texts = {}
    for _ in range(12):
        base = [f"w{rng.randrange(10**6)}" for _ in range(600)]
        for edits in (0, 1, 1, 2):
            own = list(base)
            for _ in range(edits):
                own[rng.randrange(600)] = f"x{rng.randrange(10**6)}"
            texts[len(texts)] = " ".join(own)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    keyed = R.keyed(docs)
    schema = "doc_id bigint, key bigint, node bigint, size bigint, fp bigint, bands array<bigint>"
    nodes = R.map_batches(keyed, R._marks, schema).withColumn("bands", F.slice("bands", 1, 0)).cache()
    rows = nodes.collect()
    root = {r.node: r.node for r in rows}

    def top(x):
        return x if root[x] == x else top(root[x])

    sets = {r.node: shingles(texts[r.doc_id]) for r in rows}
    for x, y in itertools.combinations(rows, 2):
        both = len(sets[x.node] & sets[y.node])
        if ((x.fp ^ y.fp) % (1 << 64)).bit_count() <= 3 and 5 * both >= 4 * (len(sets[x.node]) + len(sets[y.node]) - both):
            low, high = sorted((top(x.node), top(y.node)))
            root[high] = low
    expected = {n: top(n) for n in root}
    found = {r.node: r.root for r in R.roots(nodes, keyed.select("key", "text")).collect()}
    assert {n: found.get(n, n) for n in root} == expected and len(set(expected.values())) < 40
