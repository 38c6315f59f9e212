import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, digest string, key int"
LONG = "Loooong wörds and more. " * 6000
TEXTS = [
    "plain words here", "plain words here", "plain words here ", "", None, " \t\n ", "a", "two words", LONG, LONG + "x",
    "password=abcdefgh12 and again", "İstanbul ß Σας ½ '’s don't", "ab" * 4000, "<|endoftext|> and <|startoftext|>", "\x1c!\x1d!\x85 \xa0x", "漢字かな交じり文 \U0001f600\U0001f600",
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, a null id, clashing column names."""
    rows = [(i, t, "en" if i % 3 else None, f"src{i % 4}" if i % 5 else None, None if t is None else len(t), "r", "d", i) for i, t in enumerate(TEXTS)]
    rows += [(3, "", "en", "src1", 0, "r", "d", 3), (3, "", "en", "src1", 0, "r", "d", 3), (None, "no id", "de", "src2", 5, None, None, None), (900, "plain words here", None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")
