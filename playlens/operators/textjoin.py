"""Exact "text contains pattern" joins that scale past a broadcast.

A theta join on ``contains`` has no equality key, so Spark can only run it
as a nested loop.  That is fine while the pattern side is small and
broadcast (checked by the caller); beyond that we index by grams:

* every pattern is keyed by its first ``g = min(gram, len(pattern))`` characters;
* every text is exploded into its ``g``-grams at every position (only the
  lengths some pattern actually needs);
* an equi-join on ``(g, gram)`` yields each text that could hold the pattern
  at that position, and ``contains`` confirms it.

Every occurrence of a pattern starts at a position whose first ``g``
characters equal the pattern's key, so no match is lost and no candidate is
capped.  Texts are de-duplicated before exploding (log sentences repeat).

``rarest`` takes as a pattern's key its gram that the fewest texts hold, wherever
it stands in the pattern: a text that holds the pattern holds all its grams.
Gram counts come from the texts themselves, by an aggregate with a partial
phase, and a pattern with a gram that no text holds drops out at once.  Common
beginnings (all patterns and all texts starting alike) then cost nothing.  Its
grams are as long as the largest of :data:`LONG_GRAMS` that fits the pattern: short
ones (three digits of a number) are held by a fixed share of all texts, so their
candidates grow with texts x patterns.  They are compared by hash; ``contains`` confirms.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens import params
from playlens.operators.barrier import materialize

LONG_GRAMS = (16, 8, 4, 2, 1)


def row_count_at_most(df: DataFrame, limit: int) -> bool:
    """True when ``df`` has at most ``limit`` rows (reads at most limit+1 rows)."""
    return df.limit(limit + 1).count() <= limit


def broadcast_if_small(df: DataFrame, known_max: int | None = None,
                       limit: int = params.BROADCAST_ROW_LIMIT) -> DataFrame:
    """Mark ``df`` for broadcast when its size is bounded.

    ``known_max`` is a bound the caller proves by construction (for example
    the output of ``limit(k)``); otherwise the rows are counted, reading at
    most ``limit + 1`` of them.  Above the bound the frame is returned as is
    and Spark picks a shuffle join.
    """
    if known_max is not None and known_max <= limit:
        return F.broadcast(df)
    return F.broadcast(df) if row_count_at_most(df, limit) else df


def contains_matches(texts: DataFrame, text_col: str, patterns: DataFrame, pattern_col: str,
                     gram: int = 3, lower: bool = False, rarest: bool = False) -> DataFrame:
    """Distinct ``(text, pattern)`` pairs where ``text`` contains ``pattern``.

    ``rarest`` joins on each pattern's rarest long gram instead of its first ``gram`` characters.  ``lower`` compares case-insensitively (both sides lower-cased, the output
    keeps the original strings).  Null and empty patterns match nothing.
    """
    norm = (lambda c: F.lower(c)) if lower else (lambda c: c)
    hay = (texts.select(F.col(text_col).alias("_text")).filter(F.col("_text").isNotNull()).distinct()
           .withColumn("_tnorm", norm(F.col("_text"))))
    if rarest:
        hay = materialize(hay)      # read for the gram counts and for the join
    met = _met(hay, patterns, pattern_col, gram, norm, rarest)
    if met is None:
        return texts.sparkSession.createDataFrame([], f"`{text_col}` string, `{pattern_col}` string")
    return met.select(F.col("_text").alias(text_col), F.col("_pattern").alias(pattern_col)).distinct()


def first_containing(items: DataFrame, text_col: str, order_col: str, values: list[str], patterns: DataFrame,
                     pattern_col: str, gram: int = 3) -> DataFrame:
    """For each pattern the item of smallest ``order_col`` whose text contains it, whatever the case.

    The first item is chosen by an aggregate with a partial phase right behind
    the join, so a pattern that most texts contain costs one row per task, and
    no table of pairs is made.  The empty pattern is contained in every text.
    Output: ``pattern_col`` and the ``values`` columns, one row per pattern found.
    """
    chosen = F.min_by(F.struct(*values), F.col(order_col)).alias("_first")
    hay = items.filter(F.col(text_col).isNotNull()).withColumn("_tnorm", F.lower(text_col))
    empty = patterns.filter(F.length(pattern_col) == 0).select(pattern_col).distinct()
    found = empty.join(F.broadcast(hay.agg(chosen)), F.col("_first").isNotNull())
    met = _met(hay, patterns, pattern_col, gram, F.lower)
    if met is not None:
        found = found.unionByName(met.groupBy(F.col("_pattern").alias(pattern_col)).agg(chosen))
    return found.select(pattern_col, *[F.col(f"_first.{v}").alias(v) for v in values])


def _grams(text: str, g: int):
    """The distinct ``g``-grams of a text column."""
    return F.array_distinct(F.transform(
        F.filter(F.sequence(F.lit(1), F.greatest(F.length(text) - g + 1, F.lit(1))), lambda i: i + g - 1 <= F.length(text)),
        lambda i: F.substring(F.col(text), i, g)))


def _rarest_keys(pats: DataFrame, grams: DataFrame, lengths: list[int]) -> DataFrame:
    """``pats`` with their rarest gram as ``_key``; patterns with a gram that no text holds are left out."""
    counts = grams.groupBy("_g", "_key").agg(F.count(F.lit(1)).alias("_texts"))
    parts = None
    for g in lengths:
        one = pats.filter(F.col("_g") == g).withColumn("_key", F.explode(_grams("_pnorm", g))).withColumn("_key", F.xxhash64("_key"))
        parts = one if parts is None else parts.unionByName(one)
    rated = parts.join(counts, ["_g", "_key"], "left").withColumn("_texts", F.coalesce("_texts", F.lit(0)))
    return (rated.groupBy("_pattern", "_pnorm", "_g").agg(F.min_by("_key", F.struct("_texts", "_key")).alias("_key"), F.min("_texts").alias("_texts"))
            .filter("_texts > 0").drop("_texts"))


def _met(hay: DataFrame, patterns: DataFrame, pattern_col: str, gram: int, norm, rarest: bool = False) -> DataFrame | None:
    """Rows of ``hay`` (with ``_tnorm``) joined to the patterns they contain; None without patterns."""
    pats = (
        patterns.select(F.col(pattern_col).alias("_pattern"))
        .filter(F.col("_pattern").isNotNull() & (F.length("_pattern") > 0))
        .distinct()
        .withColumn("_pnorm", norm(F.col("_pattern")))
        .withColumn("_g", F.coalesce(*[F.when(F.length("_pnorm") >= g, F.lit(g)) for g in LONG_GRAMS]) if rarest
                    else F.least(F.length("_pnorm"), F.lit(gram)))
        .withColumn("_key", F.substring("_pnorm", 1, gram))
    )
    # One small job: which gram lengths are needed (at most ``gram`` values, or five long
    # ones) and how many patterns there are (decides the broadcast).
    per_length = {r[0]: r[1] for r in pats.groupBy("_g").count().collect()}
    if not per_length:
        return None
    grams = None
    for g in sorted(per_length):
        one = hay.withColumn("_g", F.lit(g)).withColumn("_key", F.explode(_grams("_tnorm", g)))
        if rarest:
            one = one.withColumn("_key", F.xxhash64("_key"))
        grams = one if grams is None else grams.unionByName(one)
    if rarest:
        pats = materialize(_rarest_keys(pats, grams, sorted(per_length)))
    pats = broadcast_if_small(pats, known_max=sum(per_length.values()))
    return grams.join(pats, ["_g", "_key"]).filter(F.col("_tnorm").contains(F.col("_pnorm")))
