import pytest

from postsieve.llm.common import prepare

# Cases every operator meets: NULLs in every column, empty and long texts, repeated rows.
LONG = "one two three four five six seven eight nine ten " * 4000


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    prepare(spark)


def frame(spark, rows, schema="doc_id long, text string, lang string, source string, n_chars long"):
    return spark.createDataFrame(rows, schema)


def odd_documents(spark):
    """Documents with everything odd in them, and columns whose names operators use."""
    rows = [
        (1, "Plain words in a line.\nAnother line of words.", "en", "s", 45, 7, "x"),
        (2, None, "en", "s", None, None, None),
        (3, "", None, None, 0, 7, "x"),
        (4, LONG, "en", "s", len(LONG), 7, "x"),
        (4, LONG, "en", "s", len(LONG), 7, "x"),
        (5, " \n\t\n", "fr", "s", 4, 7, "x"),
        (None, "no id here at all", "de", "s", 17, 7, "x"),
        (6, "ünïcödé 中文 🙂   tail", "de", "s", 20, 7, "x"),
    ]
    return frame(
        spark,
        rows,
        "doc_id long, text string, lang string, source string, n_chars long, score int, bucket string",
    )
