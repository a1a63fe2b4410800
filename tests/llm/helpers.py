"""Rows with the awkward cases that every operator must take."""

from pyspark.sql import Row, SparkSession

LONG = "the quick onered thand of whering " * 4000
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, block int, label int, shard int"


def awkward(spark: SparkSession):
    """Nulls in every column, empty and white texts, a very long text, ties,
    repeated rows, and columns that clash with the operators' own names."""
    rows = [
        (1, "alpha beta gamma delta epsilon zeta eta theta", "en", "a", 10, "x", 1, 1, 7),
        (2, "alpha  beta gamma delta epsilon zeta eta theta", "en", "a", 10, "x", 1, 1, 7),
        (2, "alpha  beta gamma delta epsilon zeta eta theta", "en", "a", 10, "x", 1, 1, 7),
        (3, None, None, None, None, None, None, None, None),
        (4, "", "en", "b", 0, "y", 2, 0, 1),
        (5, " \n\t ", "en", "b", 4, "y", 2, 0, 1),
        (None, "no identifier here at all for anyone", "en", "b", 4, "y", 2, 0, 1),
        (6, LONG, "en", "c", len(LONG), "z", 3, 1, 2),
        (7, LONG + "end", "en", "c", len(LONG), "z", 3, 1, 2),
        (8, "two words", "de", "c", 9, "z", 3, 0, 2),
        (9, "ünïcödé 🙂 <|endoftext|> it's 12 ok   done  ", "de", "c", 9, "z", 3, 0, 2),
    ]
    return spark.createDataFrame([Row(*r) for r in rows], SCHEMA)


def empty(spark: SparkSession):
    return spark.createDataFrame([], SCHEMA)
