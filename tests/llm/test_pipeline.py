"""The pipeline's stages: each keeps the columns, and its decisions take effect on what it was given."""

import corpus_pipeline as CP
from riskengine.llm.containment import contaminated
from riskengine.llm.frames import stored, table
from riskengine.llm.line_windows import remove_repeated_windows
from test_resemblance import kept


def test_stages_in_turn(spark, tiny_dir):
    docs = table(spark, tiny_dir, "documents")
    items = table(spark, tiny_dir, "benchmark")
    given = docs
    for name, stage in CP.STAGES:
        out = stored(stage(spark, given, tiny_dir), name)
        if name != "bpe_encoding":
            assert out.columns == docs.columns
        if name == "line_dedup":
            assert out.count() == given.count()
            assert remove_repeated_windows(given).filter("n_removed > 0").count() > 0
        if name == "near_dedup":
            expected, _ = kept({r.doc_id: r.text for r in given.collect()})
            assert {r.doc_id for r in out.collect()} == expected and out.count() == len(expected)
        if name == "decontamination":
            assert out.count() + contaminated(given, items).select("doc_id").distinct().count() == given.count()
            assert contaminated(out, items).count() == 0
        given = out
    assert given.filter("n_tokens <> size(ids)").count() == 0


def test_stages_take_odd_rows(spark, odd_docs, tiny_dir):
    given = odd_docs
    for name, stage in CP.STAGES:
        given = stored(stage(spark, given, tiny_dir), name)
    assert {"doc_id", "n_tokens", "ids"} <= set(given.columns)


def test_stages_take_no_rows(spark, no_docs, tiny_dir):
    for name, stage in CP.STAGES:
        out = stage(spark, no_docs, tiny_dir)
        assert out.count() == 0 and (name == "bpe_encoding" or out.columns == no_docs.columns)
