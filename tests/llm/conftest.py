import pytest

from adtally.llm.ship import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


#: Null id, null and empty texts, repeated rows, ties, a very long text, extra columns with clashing names.
LONG = " ".join(f"word{i % 977} the" for i in range(30_000))
EDGES = [
    (1, "alpha beta gamma delta epsilon zeta", "x", 1, 0), (1, "alpha beta gamma delta epsilon zeta", "x", 1, 0),
    (2, None, None, None, None), (3, "", "y", 2, 1), (4, " \n\t ", "y", 2, 1), (None, "alpha beta gamma", "z", 3, 2),
    (None, None, None, None, None), (5, LONG, "w", 4, 3), (6, "Ünï 漢字 😀 İ", "w", 4, 3), (7, "one", "w", 4, 3)]
LAYOUT = "doc_id bigint, text string, score string, size int, rank int"


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(EDGES, LAYOUT)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], LAYOUT)


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return sorted((r.doc_id, r.text) for r in documents.select("doc_id", "text").collect())
