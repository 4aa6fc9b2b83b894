import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, key int"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Rows with nulls, empty and long texts, repeats, and columns that operators use as names."""
    line = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda my ny xi"
    rows = [
        (1, f"{line}\n{line} two\nthree {line}\nlast line one", "en", "a", 1, "x", 1),
        (2, f"{line}\n{line} two\nthree {line}\nlast line two", "en", "b", 1, "x", 1),
        (2, f"{line}\n{line} two\nthree {line}\nlast line two", "en", "b", 1, "x", 1),
        (3, None, None, None, None, None, None),
        (None, "an id is missing here", "en", None, 3, None, 2),
        (4, "", "en", "a", 0, "", 3),
        (5, " \n \t ", "en", "a", 5, "", 3),
        (6, "é word " * 3000, "fr", "c", 1, "y", 4),
        (8, " ".join(f"w{i}" for i in range(40)), "fr", "c", 1, "y", 4),
        (7, "x" * 50_000, "fr", "c", 1, "y", 4),
    ]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
