import pytest

ODD_DOCS = "doc_id long, text string, lang string, source string, n_chars long, row struct<a:int>, node long, key string, words int"
LONG = " ".join(f"wort{i % 977}x{i % 31}" for i in range(30_000))
BASE = " ".join(f"alpha{i} beta{i % 7}" for i in range(60))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty, blank and very long texts, ties, repeats, clashing names."""
    rows = [
        (1, None, "en", "a"), (2, "", None, None), (3, " \t\n ", "en", "b"), (4, LONG, "en", None),
        (5, LONG, "de", "c"), (6, "Same Text", "en", "a"), (7, "same text", None, "a"),
        (7, "same text", None, "a"), (8, BASE, "en", "a"), (9, BASE + " tail", "en", "a"),
        (None, "text without id", "en", "a"), (None, None, None, None), (10, "Ä ÄÖ ä \x00 <|endoftext|> ▁x", "de", "x"),
        (-5, "one", "en", "a"), (11, "one", "en", "a"), (12, "x" * 50_000, "en", "a"),
    ]
    return spark.createDataFrame([(*r, None, None, 5, "k", 3) for r in rows], ODD_DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], ODD_DOCS)


@pytest.fixture
def saved(spark, tmp_path):
    """Write a frame and give it back as a plain scan."""

    def save(df, name="t"):
        df.write.mode("overwrite").parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    return save
