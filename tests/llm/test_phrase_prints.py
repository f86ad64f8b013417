"""Phrase fingerprints against a plain parse with whole phrase sets."""

import hashlib
import random

import pytest

from riskengine.llm import phrase_prints as P
from riskengine.llm.frames import table


def phrases(text):
    out, cur = set(), ""
    for c in text:
        cur += c
        if cur not in out:
            out.add(cur)
            cur = ""
    return out


def jaccard(x, y):
    return len(x & y) / len(x | y) if x | y else 1.0


def expected(rows):
    """(n_chars, digest of the edited text, likeness to it, likeness to the next) by id; ids are distinct."""
    order = sorted(rows, reverse=True)
    out = {}
    for place, i in enumerate(order):
        text, after = rows[i] or "", rows[order[(place + 1) % len(order)]] or ""
        tail = len(text) // 3
        edited = text[: len(text) - tail] + after[:tail]
        own = phrases(text)
        out[i] = len(text), hashlib.sha256(edited.encode()).hexdigest(), jaccard(own, phrases(edited)), jaccard(own, phrases(after))
    return out


def test_given_texts(spark, tiny_dir):
    docs = table(spark, tiny_dir, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    want = expected(texts)
    found = {r.doc_id: r for r in P.phrase_fingerprints(docs).collect()}
    assert found.keys() == want.keys()
    off = []
    for i, r in found.items():
        assert (r.n_chars, r.edited_sha256) == want[i][:2]
        off += [abs(r.near_edited - want[i][2]), abs(r.near_next - want[i][3])]
        assert r.fingerprint == P._said(P.fingerprint(texts[i] or ""))
    assert max(off) < 0.2 and sum(off) / len(off) < 0.03
    prints = {}
    for i, r in found.items():
        assert prints.setdefault(r.fingerprint, texts[i]) == texts[i]
    assert sum(r.near_edited > r.near_next for r in found.values()) > 0.95 * len(found)


@pytest.mark.parametrize("cuts", [[], [3.0], [5.0, 9.0, 10.0, 10.5, 40.0], [float(i) for i in range(60)]])
def test_short_texts_are_exact_wherever_runs_are_cut(spark, monkeypatch, cuts):
    rng = random.Random(len(cuts))
    texts = {i: "".join(rng.choice("abé \U0001f600") for _ in range(rng.randint(0, 40))) or None for i in rng.sample(range(60), 41)}
    monkeypatch.setattr(P, "cut_points", lambda *_: {"doc_id": cuts})
    want = expected(texts)
    found = P.phrase_fingerprints(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")).collect()
    got = {r.doc_id: (r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in found}
    assert len(found) == len(texts) and got == want


def test_a_lone_document_is_its_own_next(spark):
    (r,) = P.phrase_fingerprints(spark.createDataFrame([(1, "abcabcabcxyz")], "doc_id bigint, text string")).collect()
    assert r.edited_sha256 == hashlib.sha256(b"abcabcababca"[:8] + b"abca").hexdigest() and r.near_next == 1.0


def test_odd_rows(odd_docs, no_docs):
    found = P.phrase_fingerprints(odd_docs).collect()
    rows = {r.doc_id: r for r in found}
    assert len(found) == odd_docs.count() and P.phrase_fingerprints(no_docs).count() == 0
    assert rows[2].fingerprint == rows[3].fingerprint == "" and (rows[3].n_chars, rows[3].near_edited) == (0, 1.0)
    assert rows[3].near_next == 1.0 and rows[4].near_next == 0.0  # the next of 3 is 2, of 4 is 3
    assert rows[5].n_chars == 69000 and rows[10].near_next < 1
    assert len({r.fingerprint for r in found if r.doc_id == 1}) == 1
