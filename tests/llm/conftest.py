import pytest
from pyspark.sql import functions as F

TEXTS = [
    "The quick brown fox jumps over the lazy dog.",
    "The  quick brown\tfox jumps over the lazy dog.",
    "",
    None,
    "   \n\t ",
    "one",
    "One",
    "Ça va très bien, merci! 日本語 🎉",
    "a" * 5000 + " " + "b" * 5000,
    "word " * 3000,
    "x y z\x1cw",
    "tail ends here\n",
    "don't stop 'quoted' it's 12 345.",
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows and columns with clashing names."""
    rows = [(i, t, "en" if i % 2 else None, ["a", "b", None][i % 3]) for i, t in enumerate(TEXTS)]
    rows += [rows[0], rows[0], (None, "no id", None, None), (None, None, None, None), (0, "same id, other text", "fr", "a")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    clash = ("size", "h", "name", "node", "bands", "score", "kept", "rank", "group", "target", "spans", "row_id", "lang_pred")
    return df.withColumns({"n_chars": F.length("text")} | {c: F.lit(f"clash {c}") for c in clash}).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
