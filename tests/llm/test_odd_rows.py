"""Every operator over odd rows and over no rows: defined results, one row per input row where that is promised."""

import public_tokenizers
import pytest

from riskengine.llm.chunk_bpe import bpe, bpe_digests
from riskengine.llm.containment import contaminated
from riskengine.llm.ftrl_langid import language_id
from riskengine.llm.host_rules import quality_rules
from riskengine.llm.importance import resampled
from riskengine.llm.line_windows import remove_repeated_windows
from riskengine.llm.maxent_lm import lm_scores
from riskengine.llm.pii_tagger import personal_data
from riskengine.llm.simhash import near_duplicates, one_per_group
from riskengine.llm.suffixes import without_repeats

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (7, 1, 0), (9, 0, 0), (None, 1, 1), (8, None, None)], "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, "quick brown fox jumps over the lazy dog again"), (2, None), (3, ""), (4, "two three"), (4, "two three")]
    return spark.createDataFrame(rows, "item_id bigint, text string")


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_language_model(odd_docs, no_docs):
    found = lm_scores(odd_docs, rounds=1)
    rows = by_id(found)
    assert found.count() == odd_docs.count() and lm_scores(no_docs, rounds=1).count() == 0
    assert rows[3].n_tokens == rows[2].n_tokens == rows[4].n_tokens == 1 and rows[3].score == rows[2].score
    assert rows[5].n_tokens == 12001
    assert all(r.score < 0 and r.base_score < 0 for r in rows.values())


def test_simhash(odd_docs, no_docs):
    rows = by_id(near_duplicates(odd_docs))
    assert near_duplicates(odd_docs).count() == odd_docs.count() and near_duplicates(no_docs).count() == 0
    assert {rows[i].fingerprint for i in (2, 3, 4)} == {"0" * 16} and {rows[i].component_id for i in (2, 3, 4)} == {2}
    assert rows[1].component_id == 1 and rows[None].component_id is None
    assert one_per_group(odd_docs).count() == len({r.component_id for r in rows.values()})


def test_line_windows(odd_docs, no_docs):
    found = remove_repeated_windows(odd_docs).select("row.*", "kept_text", "n_lines", "n_removed")
    rows = by_id(found)
    assert found.count() == odd_docs.count() and remove_repeated_windows(no_docs).count() == 0
    assert rows[8].kept_text == "zero\nfive" and rows[8].n_removed == 3 and rows[7].n_removed == 0
    assert rows[3].kept_text is None and rows[3].n_lines == 0 and rows[2].n_lines == 1
    assert rows[1].n_removed == 0 and rows[1].covered == "z"


def test_pii(odd_docs, no_docs):
    rows = by_id(personal_data(odd_docs))
    assert personal_data(odd_docs).count() == odd_docs.count() and personal_data(no_docs).count() == 0
    assert rows[10].n_email == 1 and rows[3].spans == "" and rows[None].n_card == 0


def test_importance(odd_docs, no_docs, labels):
    rows = by_id(resampled(odd_docs, labels))
    assert rows[3].kept is False and rows[3].weight is None and rows[4].kept is False
    assert rows[1].kept is True
    assert resampled(no_docs, labels).count() == 0
    assert all(r.kept == (r.whole is not None) for r in resampled(odd_docs, labels.limit(0)).collect())


def test_containment(odd_docs, no_docs, items):
    found = {(r.doc_id, r.item_id, r.n_found, r.n_shingles) for r in contaminated(odd_docs, items).collect()}
    assert found == {(1, 1, 5, 5), (7, 4, 1, 1), (8, 4, 1, 1)}
    assert contaminated(odd_docs, items).count() == 3
    assert contaminated(no_docs, items).count() == 0 and contaminated(odd_docs, items.limit(0)).count() == 0


def test_suffixes(odd_docs, no_docs):
    rows = by_id(without_repeats(odd_docs))
    assert without_repeats(odd_docs).count() == odd_docs.count() and without_repeats(no_docs).count() == 0
    assert rows[3].n_bytes == rows[2].n_bytes == 0 and rows[5].n_removed == rows[5].n_bytes and rows[5].n_spans == 1
    assert without_repeats(odd_docs, 40).filter("doc_id = 1 and n_removed = n_bytes").count() == 2


def test_bpe(odd_docs, no_docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(VOCABULARY)
    rows = bpe(odd_docs, VOCABULARY).collect()
    texts = [(r.doc_id, r.text or "") for r in odd_docs.select("doc_id", "text").collect()]
    expected = sorted((str(i), tokenizer.encode(t, add_special_tokens=False).ids) for i, t in texts)
    assert sorted((str(r.doc_id), r.ids) for r in rows) == expected
    said = {r.doc_id: r.decoded for r in rows}
    assert all(said[i] == tokenizer.decode(tokenizer.encode(t, add_special_tokens=False).ids, skip_special_tokens=False) for i, t in texts)
    assert bpe_digests(no_docs, VOCABULARY).count() == 0


def test_bpe_of_a_byte_level_vocabulary(odd_docs):
    """Its tokens hold the spaces, so words can't be encoded one by one."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    expected = []
    for r in odd_docs.select("doc_id", "text").collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids
        expected.append((str(r.doc_id), ids, tokenizer.decode(ids, skip_special_tokens=False)))
    assert sorted((str(r.doc_id), r.ids, r.decoded) for r in bpe(odd_docs, path).collect()) == sorted(expected)


def test_bpe_of_the_given_documents(spark, tiny_dir):
    import hashlib

    from tokenizers import Tokenizer

    from riskengine.llm.chunk_bpe import Encoder
    from riskengine.llm.frames import table

    with open(VOCABULARY, encoding="utf-8") as f:
        assert Encoder(f.read()).words_apart  # the reuse of chunks is what is tested here
    tokenizer = Tokenizer.from_file(VOCABULARY)
    docs = table(spark, tiny_dir, "documents").select("doc_id", "text")
    found = {r.doc_id: (r.n_tokens, r.decoded_sha256) for r in bpe_digests(docs, VOCABULARY).collect()}
    for r in docs.collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids
        said = tokenizer.decode(ids, skip_special_tokens=False)
        assert found[r.doc_id] == (len(ids), hashlib.sha256(said.encode()).hexdigest())


def test_language_id(odd_docs, no_docs):
    rows = by_id(language_id(odd_docs))
    assert language_id(odd_docs).count() == odd_docs.count() and language_id(no_docs).count() == 0
    assert {rows[i].lang_pred for i in (2, 3, 4, 9)} == {"und"}
    assert all(0 <= r.score <= 1 for r in rows.values()) and rows[5].lang_pred != "und"


def test_quality_rules(odd_docs, no_docs):
    rows = by_id(quality_rules(odd_docs))
    assert quality_rules(odd_docs).count() == odd_docs.count() and quality_rules(no_docs).count() == 0
    assert rows[3].n_words == 0 and rows[3].base_failed and not rows[3].kept
    assert rows[5].n_words == rows[5].n_repeat_words == 12000 and rows[5].base_failed
