import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside.
CLASHES = ["size", "shard", "slot", "cid", "kept", "bucket", "h", "row", "spread", "th", "rid", "target", "root", "id", "position", "component"]
LONG = " ".join(f"word{i * i % 9973}" for i in range(30_000))
ROWS = [
    (1, "Plain words of a first document that says nothing at all to anyone here", "en", "a", 5),
    (2, "Plain words of a first document that says nothing at all to anyone here", "en", "b", 5),
    (2, "Plain words of a first document that says nothing at all to anyone here", "en", "b", 5),
    (3, None, None, None, None),
    (4, "", "en", "", 0),
    (5, " \t\n\x0b ", "en", "a", 5),
    (None, "no id but quite a few words and some more words to be found here", "en", "a", 1),
    (None, None, None, None, None),
    (6, "one", "en", "c", 3),
    (7, LONG, "en", "c", len(LONG)),
    (8, LONG + " tail", "en", "a", len(LONG)),
    (9, "Ärger über große Öfen und ΩΩ 漢字 😀 bleibt hier stehen wie immer", "de", "Ä", 9),
    (10, "x" * 300, "en", "a", 300),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Rows with nulls, empty and very long texts, ties, repeated rows."""
    return spark.createDataFrame(ROWS, COLUMNS)


@pytest.fixture(scope="session")
def clashing(spark, edge):
    """The same with columns named as operators name theirs."""
    from pyspark.sql import functions as F
    return edge.select("*", *[F.lit("theirs").alias(c) for c in CLASHES])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def docs(spark, sf_small):
    return spark.read.parquet(f"{sf_small}/documents.parquet")
