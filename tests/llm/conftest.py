import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """Rows with nulls, empty and long texts, ties and exact repeats."""
    base = " ".join(f"word{i % 97}x{i}" for i in range(400))
    rows = [(i, f"{base} tail{i}. Another sentence here {i}.", "en", "s", 1) for i in range(6)]
    rows += [(6, None, None, None, None), (7, "", "en", None, 0), (7, "", "en", None, 0), (None, "a b", "en", "s", 3),
             (8, "x" * 50_000, "de", "s", 50_000), (9, " ".join(["same"] * 3000), "en", "s", 1)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
