import pytest

#: doc_id, text, lang, source
ODD = [
    (1, None, None, None), (2, "", "en", "a"), (3, " \n\t ", "en", "a"), (4, "one", "en", "b"),
    (5, "the same words in the same order once more", "en", "a"),
    (5, "the same words in the same order once more", "en", "a"),
    (None, "a row without an id has words too", "en", None), (None, None, "fr", "b"),
    (6, "word " * 30_000, "en", "a"), (7, "été là où\x0bça " * 3, "fr", "b"),
    (8, "x" * 20_000, None, "c"), (9, "😀 中文 mixed   text", "und?", "c"),
]


def frame(spark, rows, extra=()):
    """documents from (doc_id, text, lang, source); ``extra`` names more columns, all of them 7."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(
        [(a, b, c, d, None if b is None else len(b)) for a, b, c, d in rows],
        "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return df.withColumns({c: F.lit(7) for c in extra}) if extra else df


CLASHING = ("fp", "text_key", "component_id", "_id", "_key", "found", "score", "ids", "n_tokens", "id", "of",
            "copies", "rows", "copy", "words", "_text", "size", "best", "guess", "root", "label", "rank")


@pytest.fixture(scope="session")
def odd(spark):
    return frame(spark, ODD, CLASHING)


@pytest.fixture(scope="session")
def nothing(spark):
    return frame(spark, [], CLASHING)
