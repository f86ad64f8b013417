"""The stratified search against scores of every document by the formula."""

import math
import random
import re
from collections import Counter

import pytest

from riskengine.llm import strata_search as S

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(docs, items, k):
    counted = [(i, Counter(TERM.findall((t or "").translate(LOW)))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, total = len(counted), sum(c.total() for _, c in counted)
    df = Counter(w for _, c in counted for w in c)
    out = []
    for item, text in set(items):
        asked = {w for w in TERM.findall((text or "").translate(LOW)) if w in df}
        scores = []
        for i, c in counted:
            m = 100 - 50 + (50 * c.total() * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 20 * m))
                for w in asked if c[w]
            )
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def got(docs, items, k):
    return sorted([tuple(r) for r in S.ranked_search(docs, items, k).select("item_id", "rank", "doc_id", "score").collect()], key=repr)


@pytest.mark.parametrize("shelf, work, block_bytes", [(S.SHELF, S.WORK, S.BLOCK_BYTES), (50, 64, S.BLOCK_BYTES), (1, 1, 300)])
def test_any_shelf_and_block(spark, monkeypatch, shelf, work, block_bytes):
    for name, value in (("SHELF", shelf), ("WORK", work), ("BLOCK_BYTES", block_bytes)):
        monkeypatch.setattr(S, name, value)
    rng = random.Random(7)
    word = lambda: rng.choice("abcdefghij") + str(int(rng.expovariate(0.3)))
    docs = [(i, " ".join(word() for _ in range(rng.choice((5, 5, 5, 20, 60))))) for i in range(150)]
    docs += [(200 + i, docs[3][1]) for i in range(40)] + [(300 + i, "a0 b1") for i in range(30)]  # ties and a hot stratum
    items = [(i, ". ".join(word() for _ in range(rng.randint(1, 12)))) for i in range(25)] + [(90, docs[3][1]), (91, "a0")]
    found = got(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"), 7)
    assert found == expected(docs, items, 7)


def test_odd_rows(spark, odd_docs, no_docs):
    items = [(1, "The QUICK brown fox; café 12345"), (1, "other text words"), (2, None), (3, ""), (4, "alpha lazy"), (4, "alpha lazy"), (None, "fox x")]
    asked = spark.createDataFrame([(*i, "z") for i in items], "item_id bigint, text string, score string")
    docs = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    assert got(odd_docs, asked, 3) == expected(docs, items, 3)
    assert S.ranked_search(no_docs, asked).count() == 0 and S.ranked_search(odd_docs, asked.limit(0)).count() == 0
