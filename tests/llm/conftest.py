import pytest

SCHEMA = "doc_id long, text string, file string, row long, digest string, n long, token long, length int, key string, label int, score double, content string, _file string, _row long, _row_ int, _metadata string"
EXTRA = ("f", 1, "d", 2, 3, 4, "k", 5, 0.5, "c", "g", 6, 7, "m")
LONG = " ".join(f"word{i % 997}x{i % 13}" for i in range(9000))
TEXTS = [
    (0, "The quick brown fox jumps over the lazy dog again and again."), (1, None), (2, ""), (3, "   \n\t "), (4, LONG), (5, "the QUICK brown fox jumps over the lazy dog again and again."),
    (6, "short one"), (7, "short one"), (7, "short one"), (8, "Éa ça 漢字 🙂 é ß İ don't 1234 <|endoftext|> x"), (None, "no number here at all"), (9, LONG + " end"), (10, "a" * 500),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows and columns whose names operators use themselves."""
    return spark.createDataFrame([(i, t, *EXTRA) for i, t in TEXTS], SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
