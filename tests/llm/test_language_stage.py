"""The language stage where no language can be learned."""

import zlib

import pytest

import corpus_pipeline

TEXTS = ["the hand of the thing", "12 345 !", None, "", "\u65e5\u672c\u8a9e", "x", "der hund", "la maison"]


@pytest.mark.parametrize("told", [False, True])
def test_documents_stay_where_no_language_is_learned(spark, told):
    """No language at all, or languages only in the split that is not learned from."""
    held = {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(80)}
    rows = [(i, TEXTS[i % 8], "en" if told and held[i] else None) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    out = corpus_pipeline.language(spark, docs, "").collect()
    assert sorted((r["doc_id"], r["lang"]) for r in out) == [(i, lang) for i, text, lang in rows if i % 8 not in (1, 2, 3)]
