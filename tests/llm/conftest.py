import pytest

# texts every operator must stand: null, empty, blank, ties, repeats, very long
EDGE = [
    (1, None), (2, ""), (3, " \t\n "), (4, "the same words here"), (5, "the  same\twords here"), (5, "the  same\twords here"),
    (None, "the same words here"), (6, "x" * 50_000), (7, "long text " * 20_000), (8, "Ünïcödé wörds — ça va"), (9, "one"),
    (10, "\u0000odd\u2028signs\u00a0here"), (11, "emoji 😀 😀 a.b-c"),
]
EXTRA = "lang string, score double, kept boolean, row int, h string, first string, words string, path string"


@pytest.fixture(scope="session")
def edge_docs(spark):
    rows = [(i, t, "en", 0.5, False, 7, "h", "f", "w", "p") for i, t in EDGE]
    return spark.createDataFrame(rows, "doc_id bigint, text string, " + EXTRA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
