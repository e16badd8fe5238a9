import pytest

SMALL = "/root/testdata/sf0.001"

#: Nulls, empty, blank, repeated and very long texts, repeated and null ids.
ODD_TEXTS = [None, "", " \n\t ", "word", "One two three.", "One two three.", "über naïve ñandú çava", "x" * 50_000, "tok " * 30_000, "İ ΣΑΣ <|endoftext|> \x1c á"]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with odd cells and columns named as the operators' outputs."""
    rows = [(i % 9, t, None if i % 3 == 0 else "en", None, None, 7, 0.5) for i, t in enumerate(ODD_TEXTS)] + [(None, "no id", "de", "s", 5, 7, 0.5)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, component_id long, score double").repartition(3)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def small():
    return SMALL
