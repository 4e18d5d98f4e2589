import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty, blank and very long texts, equal rows, and columns with clashing names."""
    long = " ".join(f"word{k % 977} of{k % 13}" for k in range(40_000))
    rows = [
        (1, None, "en", 5), (2, "", None, None), (3, " \t\n ", "en", 3), (4, "One two", "en", 7),
        (5, long, "en", len(long)), (6, long, None, len(long)), (6, long, None, len(long)),
        (None, "no key here at all, but some words to read.", "en", 9), (7, "é ñ ß 漢字 \U0001f600 end.", "xx", 1),
        (8, "x" * 300_000, "en", 300_000), (9, "a b c d e f g\n" * 300, "en", 1), (10, "tie tie tie", "en", 11),
        (11, "tie tie tie", "de", 11),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long").selectExpr(
        "*", "'s' as source", "0.5D as score", "1 as n", "'k' as key", "3 as rep", "'u' as url",
        "7 as component_id", "'t' as token")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
