"""The Merkle manifest against a tree folded by hand."""

import hashlib
import itertools
import zlib

import pytest
from pyspark.sql import functions as F

from riskengine.llm.interval_merkle import lower_cased_fifth, merkle_manifest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    doc_id, text, lang, source, n_chars = row
    fields = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return h(*["-" if f is None else f"{len(f.encode())}:{f}" for f in fields])


def folded(digests):
    """(root, siblings of each leaf: per level those before and after)."""
    paths = [[] for _ in digests]
    of = {i: [i] for i in range(len(digests))}
    level = list(digests)
    while len(level) > 1:
        up, owners = [], {}
        for b in range(0, len(level), 16):
            run = level[b : b + 16]
            for j in range(len(run)):
                for i in of[b + j]:
                    paths[i].append((run[:j], run[j + 1 :]))
            owners[b // 16] = [i for j in range(len(run)) for i in of[b + j]]
            up.append(h(*run))
        level, of = up, owners
    return level[0], paths


def lowered(text):
    return None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def expected(rows):
    key = lambda r: (r[3] is not None, (r[3] or "").encode())
    order = lambda r: (r[0] is not None, r[0] or 0, leaf(r))
    groups = [sorted(g, key=order) for _, g in itertools.groupby(sorted(rows, key=key), key)]
    trees = [folded([leaf(r) for r in g]) for g in groups]
    root, upper = folded([t[0] for t in trees])
    out = []
    for g, (sub, paths), above in zip(groups, trees, upper):
        for r, path in zip(g, paths):
            steps = path + above
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            node = leaf((r[0], lowered(r[1]), *r[2:])) if hit else leaf(r)
            for left, right in steps:
                node = h(*left, node, *right)
            proof = h(*[d for left, right in steps for d in left + right])
            out.append((r[0], leaf(r), sub, root, proof, node, node == root))
    return sorted(out, key=repr)


def got(docs):
    rows = merkle_manifest(docs, lower_cased_fifth()).collect()
    return sorted([tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")) for r in rows], key=repr)


@pytest.mark.parametrize("sizes", [[1], [16], [17, 1], [257, 15, 3], [1] * 18, [600, 1, 1, 40]])
def test_trees_of_any_shape(spark, sizes):
    rows = [
        (1000 * s + i, f"Text {i}" if i % 3 else f"plain {i}", "en" if i % 2 else None, f"src{s}" if s else None, i)
        for s, n in enumerate(sizes) for i in range(n)
    ]
    found = got(spark.createDataFrame(rows, SCHEMA))
    assert found == expected(rows)
    assert any(not r[-1] for r in found) == any(zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[1] != lowered(r[1]) for r in rows)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [tuple(r)[:5] for r in odd_docs.collect()]
    assert got(odd_docs) == expected(rows) and merkle_manifest(no_docs).count() == 0


def test_without_an_audit_all_rows_verify(spark, odd_docs):
    assert merkle_manifest(odd_docs).filter("not verified").isEmpty()
    other = merkle_manifest(odd_docs, {"lang": F.lit("xx")})
    assert other.filter("verified").isEmpty() and other.select("root").distinct().count() == 1
