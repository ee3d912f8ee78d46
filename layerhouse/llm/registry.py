"""The registered queries of this subpackage and their SQL equivalents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from layerhouse.llm import oracle, pii, pu_quality, toxicity
from layerhouse.llm.bitsliced import ranked_search
from layerhouse.llm.inputs import remainder, table
from layerhouse.llm.exact_dedup import exact_dedup
from layerhouse.llm.language_id import identify, learn_profiles, learnable
from layerhouse.llm.near_dedup import near_dedup
from layerhouse.llm.nearest import nearest
from layerhouse.llm.packing import pack
from layerhouse.llm.pieces import encode
from layerhouse.llm.quality_rules import quality_rules
from layerhouse.llm.sharding import rendezvous
from layerhouse.llm.whitening import whiten


def _documents(operator):
    return lambda spark, sf_dir: operator(table(spark, sf_dir, "documents"))


def _encoded(df):
    """Digests of the ids and of the text they decode to."""
    return encode(df, public_tokenizers.path("piece_bpe_32k.model"), as_text=True).select(
        "doc_id", F.col("n_ids").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def _languages(df):
    profiles = learn_profiles(df.where(learnable("doc_id", 4, 2)))
    return identify(df, profiles).select(
        "doc_id", F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def _personal(df):
    """Counts and digest of the base spans, and all spans as text."""
    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in pii.KINDS]
    return pii.find(df, pii.learn(df)).select(
        "doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def _packed(df):
    return pack(df, public_tokenizers.path("word_bpe_49k.json"))


def _labelled(operator, parts, held):
    """Learn on one split, score every document."""
    def run(spark, sf_dir):
        documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
        open_rows = learnable("doc_id", parts, held)
        model = operator.learn(documents.where(open_rows), labels.where(open_rows))
        held_out = F.coalesce(remainder("doc_id", parts) == held, F.lit(False)).alias("held_out")
        return operator.score(documents, model).select("doc_id", held_out, "score", "predicted")

    return run


QUERIES = {
    "op1_sentencepiece": _documents(_encoded),
    "op2_minhash": _documents(near_dedup),
    "op3_language_id": _documents(_languages),
    "op4_pii": _documents(_personal),
    "op5_exact_dedup": _documents(exact_dedup),
    "op6_quality_rules": _documents(lambda df: quality_rules(df).drop("failed")),
    "op7_packing": _documents(_packed),
    "op8_toxicity": _labelled(toxicity, 5, 0),
    "op9_quality_pu": _labelled(pu_quality, 3, 1),
    "op10_sharding": _documents(rendezvous),
    "op11_bitsliced_search": lambda spark, sf_dir: ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")),
    "op12_nearest": lambda spark, sf_dir: nearest(table(spark, sf_dir, "embeddings")),
    "op13_whitening": lambda spark, sf_dir: whiten(table(spark, sf_dir, "embeddings")),
}

#: SQL only; an operator that SQL cannot express has no entry and is held against brute force in the tests.
ORACLE = {
    "op5_exact_dedup": oracle.EXACT_DEDUP,
    "op6_quality_rules": oracle.quality_rules(),
    "op11_bitsliced_search": oracle.RANKED_SEARCH,
    "op12_nearest": oracle.NEAREST,
}
