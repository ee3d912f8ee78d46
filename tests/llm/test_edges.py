"""Every operator and stage on nulls, empty and long texts, ties, repeated rows, clashing names, empty tables."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from layerhouse.llm import pii, pu_quality, toxicity
from layerhouse.llm.exact_dedup import drop_copies, exact_dedup
from layerhouse.llm.language_id import identify, learn_profiles
from layerhouse.llm.near_dedup import drop_near_copies, near_dedup
from layerhouse.llm.packing import pack
from layerhouse.llm.pieces import encode
from layerhouse.llm.quality_rules import quality_rules
from layerhouse.llm.sharding import rendezvous

OPERATORS = {
    "sentencepiece": lambda df, labels: encode(df, public_tokenizers.path("piece_bpe_32k.model")),
    "near": lambda df, labels: near_dedup(df),
    "language": lambda df, labels: identify(df, learn_profiles(df)),
    "pii": lambda df, labels: pii.find(df, pii.learn(df)),
    "exact": lambda df, labels: exact_dedup(df),
    "rules": lambda df, labels: quality_rules(df),
    "toxicity": lambda df, labels: toxicity.score(df, toxicity.learn(df, labels)),
    "quality": lambda df, labels: pu_quality.score(df, pu_quality.learn(df, labels)),
    "sharding": lambda df, labels: rendezvous(df),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_for_every_row(edge, labels, name):
    out = OPERATORS[name](edge, labels)
    assert sorted(str(r[0]) for r in out.select("doc_id").collect()) == sorted(str(r[0]) for r in edge.select("doc_id").collect())


@pytest.mark.parametrize("name", OPERATORS)
def test_an_empty_table_gives_an_empty_result(edge, labels, name):
    assert OPERATORS[name](edge.limit(0), labels.limit(0)).collect() == []


def test_packing_places_every_row(edge):
    out = pack(edge, public_tokenizers.path("word_bpe_49k.json"))
    rows = out.where("piece = 0").collect()
    assert len(rows) == edge.count()
    assert {r["length"] for r in rows if r["doc_id"] in (1, 2, 3)} == {1}
    assert pack(edge.limit(0), public_tokenizers.path("word_bpe_49k.json")).collect() == []


@pytest.mark.parametrize("stage", [s for s, _ in corpus_pipeline.STAGES])
def test_stages_keep_their_columns(spark, edge, stage):
    run = dict(corpus_pipeline.STAGES)[stage]
    for docs in (edge, edge.limit(0)):
        out = run(spark, docs, "")
        if stage == "packing":
            assert "sequence_id" in out.columns
        else:
            assert out.columns == edge.columns
            assert [t for _, t in out.dtypes] == [t for _, t in edge.dtypes]
        assert (out.count() > 0) == (docs is edge)


def test_documents_without_letters_go_and_missing_languages_are_filled(spark, edge):
    out = corpus_pipeline.language(spark, edge, "")
    kept = {r["doc_id"]: r["lang"] for r in out.collect()}
    assert kept.keys() >= {4, 5, 6, 7, 8, 9, 10, 12, None} and not kept.keys() & {1, 2, 3, 11}
    assert kept[5] is not None and kept[10] == "fr"


def test_one_document_of_equal_texts_stays(edge):
    kept = sorted((str(r["doc_id"]) for r in drop_copies(edge).collect()))
    # of the empty texts the one of blanks is the longest; a null identifier loses; the repeated row stays once
    assert kept == sorted(["3", "4", "5", "6", "7", "8", "9", "10", "11", "12"])


def test_one_document_of_near_copies_stays(edge):
    kept = sorted((str(r["doc_id"]) for r in drop_near_copies(edge).collect()))
    assert kept.count("8") == 1 and "9" not in kept and "7" not in kept
    assert kept.count("6") == 2 and kept.count("None") == 2  # repeated rows stay together, unnamed rows are linked with nothing


def test_masked_text_and_its_length(spark, edge):
    row = corpus_pipeline.personal_data(spark, edge, "").where("doc_id = 12").first()
    assert row["text"] == "mail [EMAIL] or [PHONE], [CARD] at [IP]"
    assert row["n_chars"] == len(row["text"])
    assert corpus_pipeline.personal_data(spark, edge, "").where(F.col("text").isNull()).count() == 2
