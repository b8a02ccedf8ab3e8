import pytest

# Rows that every operator must survive: (doc_id, text, lang, source, n_chars).
ODD = [
    (1, None, "en", "a", 0),
    (2, "", "en", "a", 0),
    (3, " \t\n", None, None, 3),
    (4, "one", "en", "b", 3),
    (5, "alpha beta gamma delta epsilon zeta eta theta", "en", "b", 40),
    (6, "alpha beta  gamma\tdelta epsilon zeta eta theta", "en", "b", 40),
    (6, "alpha beta  gamma\tdelta epsilon zeta eta theta", "en", "b", 40),
    (None, "alpha beta gamma delta epsilon zeta eta theta", None, "c", 40),
    (8, "naïve 😀 größe — straße\x1cx y\x0bz", "de", "c", 20),
    (9, "word " * 30_000, "en", "hot", 150_000),
    (10, "line one\nline two\nline one\n\nline one", "en", "hot", 30),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def small_batches(spark):
    """A session whose Python tasks see many small batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    yield spark
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.fixture
def odd(small_batches):
    return small_batches.createDataFrame(ODD, SCHEMA).repartition(3)


@pytest.fixture
def empty(small_batches):
    return small_batches.createDataFrame([], SCHEMA)


@pytest.fixture
def clashing(odd):
    """Extra columns with names that operators use inside or return."""
    from pyspark.sql import functions as F

    names = ["size", "copies", "kept", "row", "digest", "words", "n_words", "bad", "at", "target",
             "token", "component_id", "label", "batch", "id", "score", "piece", "length"]
    return odd.withColumns({n: F.lit("x") for n in names})


@pytest.fixture(scope="session")
def corpus(spark):
    """The smallest driver table as rows: (doc_id, text, lang, source)."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()]
