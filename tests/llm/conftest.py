import pytest

DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, and
    columns that clash with what operators add."""
    long = " ".join(f"w{i % 997}" for i in range(60_000))
    phrase = " ".join(f"p{i}" for i in range(40))
    rows = [
        (None, "text without a key", "en", "a", 5),
        (None, None, None, None, None),
        (1, None, "en", "a", 0),
        (2, "", "en", "a", 0),
        (3, " \t\n ", "en", None, 4),
        (4, long, "en", "a", len(long)),
        (5, long + " end", "en", "b", len(long) + 4),
        (6, "same words here twice", "en", "b", 21),
        (6, "same words here twice", "en", "b", 21),
        (7, "same words here twice", "en", "b", 21),
        (8, phrase, "fr", "c", len(phrase)),
        (9, "before " + phrase + " after", "fr", "c", len(phrase) + 13),
        (10, "x" * 300_000, "en", "c", 300_000),
        (11, "nul \x00 and 😀 <|endoftext|> é", "en", "a", 30),
        (12, "mail a.b@c.org now", "en", "a", 18),
    ]
    clash = [(*row, i, f"t{i}", float(i)) for i, row in enumerate(rows)]
    return spark.createDataFrame(
        clash, f"{DOCUMENT}, size int, score string, target double"
    ).repartition(3)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCUMENT)


@pytest.fixture(scope="session")
def labels(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/labels.parquet")
