import pytest


TABLES = "/root/testdata/sf0.001"

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{TABLES}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{TABLES}/labels.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows and columns whose names an operator might use."""
    long = "lorem ipsum dolor " * 20_000
    rows = [
        (1, "Some words in a row", "en"),
        (1, "Some words in a row", "en"),
        (2, "SOME words in a row", None),
        (3, None, "en"),
        (None, "", "de"),
        (None, None, None),
        (4, "\x00\x01 été \U0001f600 \n\n\t", "fr"),
        (5, long, "en"),
        (6, "1234 --- !!!", "en"),
    ]
    extra = "hash string, row string, fp string, mix string, words string, text_key string, key string, label string"
    return spark.createDataFrame(
        [(i, t, lang, "s", 1, *["x"] * 8) for i, t, lang in rows], f"{DOC}, {extra}"
    )


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOC)
