"""Small hand-made tables with the awkward rows every operator must take."""

import zlib

from pyspark.sql import functions as F
from pyspark.sql import types as T

DOCUMENT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
LABEL = "doc_id long, quality int, toxic int"
ITEM = "item_id long, text string"


def words(seed: int, n: int) -> str:
    return " ".join(f"w{zlib.crc32(f'{seed}/{i}'.encode()) % 999983}" for i in range(n))


def awkward(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, clashing extra columns."""
    long_text = "\n".join(words(k, 200) for k in range(1000, 1400))
    rows = [
        (1, words(1, 120), "en", "a", 1), (2, words(1, 120), "en", "a", 1), (3, words(1, 119) + " changed", "en", None, 1),
        (4, None, "en", "a", None), (5, "", None, "b", 0), (6, " \t\n ", "en", "b", 4), (7, "one two", "en", "b", 7),
        (None, words(9, 60), "en", "a", 5), (None, words(9, 60), "en", "a", 5), (8, long_text, "en", "a", 9),
        (9, words(30, 80), "de", "c", 2), (9, words(30, 80), "de", "c", 2), (10, "ONE two", "en", "b", 7),
        (11, "é" * 400 + " " + words(44, 60), "fr", "c", 3), (12, "a" * 5000, "fr", "c", 3),
    ]
    df = spark.createDataFrame(rows, DOCUMENT)
    for name in ("score", "key", "rep", "size", "label", "block", "kept", "n", "sid", "shard", "component_id", "hash", "path"):
        df = df.withColumn(name, F.lit("x"))
    return df


def empty(spark):
    return spark.createDataFrame([], DOCUMENT)


def nothing(spark):
    """All columns null in every row."""
    return spark.createDataFrame([(None,) * 5] * 3, DOCUMENT)
