import duckdb
import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, kept boolean, name string, _row string"


@pytest.fixture(scope="module")
def edge_rows():
    """Nulls, empty and long texts, ties, repeated rows and ids, one hot group, clashing column names."""
    texts = [
        (1, "Alpha beta gamma delta"), (2, "alpha BETA gamma delta"), (3, None), (4, ""), (5, "one id"), (5, "one id"),
        (5, "another text of this id"), (None, "no id"), (None, None), (6, "  spaced \n\n out  "), (7, "ÄÖ é 日本 🙂 <|endoftext|>"),
        (8, "word " * 40_000), (9, "word " * 40_000), (10, "x" * 20_000),
    ]
    texts += [(100 + i, "the same copy here") for i in range(60)]
    return [(d, t, "en", s, len(t or ""), 1, True, "n", "r") for n, (d, t) in enumerate(texts) for s in [["a", "b", None][n % 3]]]


@pytest.fixture(scope="module")
def edge_docs(spark, edge_rows):
    return spark.createDataFrame(edge_rows, SCHEMA)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents():
    return duckdb.sql(f"SELECT doc_id, text, source FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()
