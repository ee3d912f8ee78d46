import pytest

#: Columns that operators use inside; a table may have columns of these names.
CLASHES = ("digest", "run", "best", "rows", "rep", "bucket", "label", "key", "task", "length", "rank", "first", "shard",
           "slot", "__task", "__row", "x", "found", "score", "lang_pred", "spans", "base", "kept", "size", "piece", "band")

LONG = "wort und the la " * 15_000 + "y" * 60_000

EDGE = [
    (1, None, "en"), (2, "", None), (3, " \t\n\r", "fr"), (4, "one", "en"), (5, "one two three", None),
    (6, "the cat and the dog sat on the mat near the house", "en"), (6, "the cat and the dog sat on the mat near the house", "en"),
    (7, "The cat and the dog  sat on the mat\nnear the house", "en"), (8, LONG, "de"), (9, LONG + " more", "de"),
    (None, "the cat and the dog sat on the mat near the house", "en"), (None, None, None),
    (10, "été 日本語 \U0001f600 ź", "fr"), (11, "12345 67890 !!! ---", "es"),
    (12, "mail a.b@c.example.org or +1 (619) 555-1368, 4111 1111 1111 1111 at 10.0.0.1", "en"),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls in every column, empty and very long texts, repeated rows and clashing names."""
    wide = [(d, t, lang, None if d is None else f"s{d % 2}", None if t is None else len(t), *["x"] * len(CLASHES)) for d, t, lang in EDGE]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES)
    return spark.createDataFrame(wide, schema).repartition(3)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(d, q, t) for d, q, t in [(4, 1, 0), (5, 0, 1), (6, 1, 0), (8, None, None), (None, 1, 1), (11, 0, 1), (12, 1, 0)]],
                                 "doc_id long, quality int, toxic int")
