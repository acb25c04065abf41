"""Aggregations, unions and keep-first de-duplication.

All of them have a partial (map-side) phase (sort-based where ``min_by`` keeps
strings), so a hot key is combined inside each task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens import params
from playlens.functions.text import genre_array


def distinct_titles(titled: DataFrame, cols: tuple[str, ...] = ("kind", "title")) -> DataFrame:
    """Distinct titles."""
    return titled.select(*cols).distinct()


def title_views(titled: DataFrame, keys: tuple[str, ...] = ("kind", "title")) -> DataFrame:
    """Views per title."""
    return titled.groupBy(*keys).agg(F.count(F.lit(1)).alias("views"))


def keep_first(df: DataFrame, key: str | list[str], order: str | Column,
               values: list[str]) -> DataFrame:
    """One row per key: the values of the row with the smallest ``order`` (D3).

    ``min_by`` is an ordinary aggregate, so each task keeps one candidate per
    key before the shuffle; no group is ever materialised.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order_col = F.col(order) if isinstance(order, str) else order
    picked = df.groupBy(*keys).agg(
        F.min_by(F.struct(*[F.col(v) for v in values]), order_col).alias("_first"))
    return picked.select(*keys, *[F.col(f"_first.{v}").alias(v) for v in values])


def union_history(history: DataFrame, batch: DataFrame) -> DataFrame:
    """History then batch, by column name, on the columns both have."""
    cols = [c for c in history.columns if c in set(batch.columns)]
    return history.select(*cols).unionByName(batch.select(*cols))


def explode_genres(df: DataFrame, genres_col: str = "Genres", out: str = "genre") -> DataFrame:
    """One row per genre of a ``", "``-joined genre string (H8, H9)."""
    return df.select("*", F.explode(genre_array(genres_col)).alias(out))


def value_counts(df: DataFrame, col: str, name: str = "counts") -> DataFrame:
    """Rows per value of ``col``."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(name))


def merge_counts(old: DataFrame, new: DataFrame, key: str = "genre", value: str = "counts") -> DataFrame:
    """Sum counts per key over two count tables."""
    return (
        old.select(key, F.col(value).cast("bigint").alias(value))
        .unionByName(new.select(key, F.col(value).cast("bigint").alias(value)))
        .groupBy(key)
        .agg(F.sum(value).cast("bigint").alias(value))
    )


def sorted_genre_string(df: DataFrame, key: str, genre_col: str = "genre",
                        out: str = "genres") -> DataFrame:
    """Genres of each key as one sorted ``", "``-joined string."""
    return df.groupBy(key).agg(
        F.array_join(F.sort_array(F.collect_set(genre_col)), params.GENRE_SEPARATOR).alias(out))
