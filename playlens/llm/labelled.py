"""A bounded, reproducible sample of labelled documents for fitting a classifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; 0 where the id is null."""
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string").cast("binary")) % folds, F.lit(0)).cast("int")


def training_rows(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int,
                  per_class: int, max_words: int | None = None) -> DataFrame:
    """(doc_id, label, text): at most ``per_class`` documents of each class outside the held-out fold, of at most ``max_words`` words each.

    The documents with the smallest id hashes are taken, so the sample does not
    depend on partitions.  Labels other than 0 and 1 and unlabelled rows are
    left out; of repeated labels the largest counts, of repeated documents one.
    """
    rows = (labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels[label].cast("int").alias("label"))
            .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
            .filter(fold(F.col("doc_id"), folds) != held_out)
            .groupBy("doc_id").agg(F.max("label").alias("label"))
            .withColumn("_h", F.xxhash64("doc_id")))
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    if max_words is not None:       # before the cap, so that long texts do not use it up
        texts = texts.filter(F.size(F.split("text", r"[\x20\x09-\x0D]+")) <= max_words)
        rows = rows.join(texts.select("doc_id"), "doc_id", "left_semi")
    # a top-k per class: each task keeps its smallest, and only these are merged
    chosen = None
    for value in (0, 1):
        some = rows.filter(F.col("label") == value).orderBy("_h", "doc_id").limit(per_class)
        chosen = some if chosen is None else chosen.unionByName(some)
    out = texts.join(F.broadcast(chosen), "doc_id")     # at most 2 * per_class rows
    return out.groupBy("doc_id").agg(F.first("label").alias("label"), F.min("text").alias("text"), F.first("_h").alias("_h"))
