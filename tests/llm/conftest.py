import pytest

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row int, found string, spans string, key long"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r["doc_id"]: r["text"] for r in documents.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in any column, empty, very long and repeated texts, repeated rows, and columns with names that operators use."""
    long = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, " \n\t ", "en", None, 4),
        (4, long, "en", "a", len(long)),
        (5, long + " and more", "en", "a", None),
        (None, "no id here, but a text of some words all the same", "en", "a", 10),
        (7, "same text", "fr", "a", 9),
        (7, "same text", "fr", "a", 9),
        (7, "other text of one id", "fr", "a", 20),
        (8, "x" * 50_000, None, "a", 50_000),
        (9, "12345 67890 %%% 日本語 \u00a0", "de", "a", 1),
    ]
    return spark.createDataFrame([(*r, 5, "clash", "clash", 9) for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
