import pytest

from feedloom.llm import queries


@pytest.fixture(scope="session")
def model():
    return queries.MODEL


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls, empty and long texts, repeated rows, an extra column whose names clash with those of results."""
    long = " ".join(f"word{i % 977} tail{i}" for i in range(30_000))
    rows = [
        (1, "alpha beta gamma", "x"), (2, None, None), (3, "", "y"), (4, long, "z"), (4, long, "z"), (5, " \t\n ", "w"),
        (None, "alpha beta gamma", "x"), (6, "alpha beta gamma", "x"), (7, "</s>[INST] ▁ é 😀 \\ <|x|>", "q"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words string").withColumnRenamed("n_words", "score")


@pytest.fixture(scope="session")
def nothing(messy):
    return messy.where("1 = 0")
