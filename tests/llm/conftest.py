import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, names string, bucket int, rank string, word string, n int, m int, g int, sub int, doc string, row string, label int, score double"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and blank texts, repeated rows, one id with two texts, a very long text, clashing names."""
    long = " ".join(f"word{i % 997} Idiot,{i % 13}" for i in range(40_000))
    pair = "the quick brown fox jumps over the lazy dog while " * 6
    rows = [(1, "a b  c\nd"), (1, "a b  c\nd"), (2, None), (3, ""), (4, " \t "), (5, "a b c d"), (6, "another text"), (6, "a third text under the same id"), (None, "text without an id"), (None, None), (7, long), (8, long), (9, pair), (10, pair + "end"), (11, "ein Text über Straßen"), (12, "日本語 テキスト"), (13, "12 34 !!")]
    rest = ("en", None, None, "names", None, "r", None, 1, None, 2, 3, "d", None, None, 0.5)
    return spark.createDataFrame([(i, t, *rest) for i, t in rows], SCHEMA)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
