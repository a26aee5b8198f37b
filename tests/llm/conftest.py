import pytest
from pyspark.sql import functions as F

ODD = [
    (1, "The cat sat on the mat.\nThe cat sat on the mat.\n", "en", "a", 10),
    (2, "The cat sat on the mat.\nThe cat sat on the mat.\n", "en", "a", 10),
    (2, "The cat sat on the mat.\nThe cat sat on the mat.\n", "en", "a", 10),
    (3, None, "en", "b", None),
    (4, "", None, None, 0),
    (5, " \t\n\r\x0b\x0c ", "de", None, 7),
    (None, "ein Wort und noch ein Wort für alle Fälle", "de", "b", 1),
    (None, None, None, None, None),
    (6, "lang " * 60_000 + "ende", "de", "c", 1),
    (7, "é" * 300 + " 123 *** <|endoftext|>", "fr", "", 1),
    (8, " ".join(f"word{i} of the text" for i in range(40)), "en", "c", 1),
    (9, " ".join(f"Word{i} of The text" for i in range(40)), "en", "c", 1),
    (10, "12 34 !!", "en", "a", 1),
    (11, " ".join(f"solo{i} other{i * i}" for i in range(40)), "en", "a", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

#: Columns named like those that operators make.
CLASHING = (
    "size", "target", "copies", "text_hash", "kept", "score", "fp", "root", "_row", "_id", "_text", "bucket", "guest",
    "sequence_id", "offset", "piece", "held_out", "base", "p", "units", "_block", "draw", "_hash", "name", "component_id",
)


def clashing(df):
    return df.select("*", *[F.lit(c).alias(c) for c in CLASHING])


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with everything that may be odd, and columns of clashing names."""
    return clashing(spark.createDataFrame(ODD, SCHEMA).repartition(3))


@pytest.fixture(scope="session")
def none(spark):
    return clashing(spark.createDataFrame([], SCHEMA))


@pytest.fixture(scope="session")
def docs(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")
