"""Every operator on nulls, empty and long texts, repeated rows, empty tables and clashing columns."""

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from pricebench.llm import classifier, html_text, minhash, packing, pieces, pii, repeats, rules, sharding, simhash
from pricebench.llm.catalog import token_files
from cases import CLASHING, ODD_TEXTS, documents

MODEL = classifier.Model(np.zeros(classifier.BUCKETS), 0.25)


def run_pieces(docs):
    return pieces.encoded(docs, public_tokenizers.path("piece_bpe_32k.model"))


OPERATORS = {
    "sentencepiece": run_pieces,
    "pii": pii.found_spans,
    "classifier": lambda docs: classifier.scored(docs, MODEL),
    "repeats": lambda docs: repeats.without_repeats(docs).select("row.doc_id", "cut.*"),
    "sharding": sharding.shard_documents,
    "simhash": simhash.near_duplicates,
    "rules": rules.quality_verdicts,
    "minhash": minhash.fingerprints_with_edits,
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_one_row_for_each_row(spark, name):
    docs = documents(spark, extra=CLASHING)
    rows = OPERATORS[name](docs).collect()
    expected = sorted([i for i, _ in ODD_TEXTS if i is not None] + [6])
    assert sorted(r["doc_id"] for r in rows if r["doc_id"] is not None) == expected
    assert len(rows) == len(ODD_TEXTS) + 1
    assert len({tuple(map(str, r)) for r in rows if r["doc_id"] == 6}) <= 2


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(spark, name):
    assert OPERATORS[name](documents(spark, [])).collect() == []


def test_packing_edges(spark):
    packed = packing.packed_documents(documents(spark, extra=CLASHING), *token_files()).collect()
    assert {r["doc_id"] for r in packed} == {i for i, _ in ODD_TEXTS}
    assert {r["length"] for r in packed if r["doc_id"] in (0, 1)} == {1}
    assert packing.packed_documents(documents(spark, []), *token_files()).collect() == []


def test_minhash_classes_edges(spark):
    found = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(documents(spark, extra=CLASHING)).collect()}
    assert found[0] == found[1] == found[2] == 0
    assert found[7] == 6 and found[15] == 14 and found[14] == 14
    assert minhash.near_duplicates(documents(spark, [])).collect() == []


def test_pages_edges(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p>a&amp;b<p>c"), (3, "u", "<p>a&amp;b<p>c"), (None, "u", "x" * 200_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'q' AS text", "1 AS n_chars")
    found = html_text.extract_pages(pages).collect()
    assert sorted((r["page_id"] or 0, r["text"][:9], r["n_chars"]) for r in found) == [
        (0, "x" * 9, 200_000), (1, "", 0), (2, "", 0), (3, "a&b c", 5), (3, "a&b c", 5)
    ]
    assert html_text.extract_pages(pages.limit(0)).collect() == []


@pytest.mark.parametrize("stage", [s[0] for s in corpus_pipeline.STAGES])
def test_stages_keep_columns_and_bear_odd_rows(spark, stage):
    function = dict(corpus_pipeline.STAGES)[stage]
    docs = documents(spark)
    found = function(spark, docs, "")
    if stage != "best-fit packing":
        assert found.dtypes == docs.dtypes
        wide = documents(spark, extra=CLASHING)
        assert function(spark, wide, "").columns == wide.columns
    assert found.count() > 0
    assert function(spark, documents(spark, []), "").count() == 0
