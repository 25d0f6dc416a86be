"""Nulls, empty and very long texts, ties, repeated rows, empty tables and
extra columns with clashing names, for every query and every pipeline stage."""

import hashlib

import pytest

import corpus_pipeline
from skyledger.llm.queries import QUERIES
from .conftest import EDGE_DOCS

SHA_EMPTY = hashlib.sha256(b"").hexdigest()
PER_DOCUMENT = [n for n in QUERIES if n.split("_")[0] not in ("op3", "op5", "op11", "op13")]


@pytest.mark.parametrize("name", list(QUERIES))
def test_empty_tables_give_no_rows(spark, folders, name):
    assert QUERIES[name](spark, folders[1]).collect() == []


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_one_row_for_every_document_row(spark, folders, name):
    got = QUERIES[name](spark, folders[0]).collect()
    key = lambda i: (i is None, i or 0)
    assert sorted((r.doc_id for r in got), key=key) == sorted((d[0] for d in EDGE_DOCS), key=key)
    copies = [tuple(r[c] for c in r.__fields__ if c not in ("slot", "shard", "folded_root")) for r in got if r.doc_id == 7]
    assert copies[0] == copies[1]


def by_id(rows):
    return {r.doc_id: r for r in rows}


def test_defined_values(spark, folders):
    got = {n: by_id(QUERIES[n](spark, folders[0]).collect()) for n in PER_DOCUMENT}
    for i in (1, 2, 3):
        assert got["op10_ngram_join"][i].n_shingles == 0 and got["op10_ngram_join"][i].component_id == i
        assert got["op4_language_spans"][i].lang_pred == "und" and got["op6_decontamination"][i].n_words == 0
    assert got["op4_language_spans"][8].lang_pred == "und"
    assert got["op10_ngram_join"][10].component_id == 4 and got["op10_ngram_join"][7].component_id == 6
    assert got["op9_suffix_dedup"][1].kept_sha256 == got["op7_byte_bpe"][1].ids_sha256 == SHA_EMPTY
    assert got["op1_sentence_spans"][7].n_removed == got["op1_sentence_spans"][7].n_sentences == 3
    assert got["op1_sentence_spans"][6].n_removed == 0
    assert got["op6_decontamination"][6].n_items == 2 and got["op6_decontamination"][6].n_hit == got["op6_decontamination"][6].n_words
    assert got["op8_best_fit_shards"][1].size == 16 and got["op8_best_fit_shards"][1].text_crc32 == 0
    assert all(0 <= r.score <= 1 for r in got["op2_toxicity"].values())


def test_url_rules(spark, folders):
    rows = QUERIES["op5_url_filter"](spark, folders[0]).collect()
    got = {r.page_id: r for r in rows}
    assert len(rows) == 12
    for i in (1, 2, 3):
        assert (got[i].host, got[i].path, got[i].rule) == ("", "", None)
    assert (got[4].host, got[4].path, got[4].rule, got[4].verdict) == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert (got[5].rule, got[5].verdict) == ("net/", "block") and got[6].rule is None
    assert (got[7].rule, got[7].verdict) == ("example.com/de/", "block") and got[9].rule == "net/"
    assert (got[None].rule, got[None].verdict) == ("org/fr/", "allow") and (got[10].host, got[10].path) == ("org", "")


def test_vectors(spark, folders):
    got = QUERIES["op3_impact_topk"](spark, folders[0]).collect()
    tie = 128 * 128 + 64 * 64
    assert sorted(map(tuple, got)) == [(0, 1, 50, 128 * 256), (0, 2, 1, tie), (0, 3, 2, tie),
                                       (50, 1, 0, 128 * 256), (50, 2, 1, 128 * 256), (50, 3, 2, 128 * 256)]


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
@pytest.mark.parametrize("full", [True, False])
def test_stage(spark, folders, stage, full):
    folder = folders[0] if full else folders[1]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = stage[1](spark, docs, folder)
    rows = out.collect()
    if not full:
        assert rows == []
    if stage[0] != "byte_level_bpe":
        assert out.columns == docs.columns
        assert all((r.row, r.score, r.n_removed, r.own, r._row, r._number, r._row_key, r.number)
                   == ("r", "s", "x", "o", "p", "q", "k", "n") for r in rows)
        if full:
            assert any(r.text is None for r in rows) and any(r.doc_id == 5 for r in rows)
