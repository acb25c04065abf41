"""Catalogue lookups re-expressed as joins.

The original application resolved each title with one remote call per
title inside a driver loop.  Here every lookup is a join over whole tables:

* :func:`search_catalogue`  title -> first matching catalogue item
* :func:`english_titles`    item -> English title from the cache, with status
* :func:`item_genres`       item -> sorted genre array
* :func:`titles_by_genres`  chosen genres -> every catalogue item that has them
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens import params
from playlens.operators.aggregates import keep_first
from playlens.operators.barrier import materialize
from playlens.operators.textjoin import broadcast_if_small, first_containing

STATUS_OK = "ok"                    # item found, English title from the cache
STATUS_UNRESOLVED = "unresolved"    # provider id not in the cache: catalogue title kept
STATUS_NO_TMDB_ID = "no_tmdb_id"    # item has no provider id
STATUS_NO_ITEM = "no_item"          # no Series/Movie item matches the title
USABLE = [STATUS_OK, STATUS_UNRESOLVED]


def search_catalogue(terms: DataFrame, catalogue: DataFrame, term_col: str = "title",
                     item_types: list[str] | None = None) -> DataFrame:
    """First catalogue item for every distinct search term.

    A candidate is a Series/Movie item whose title contains the term,
    case-insensitively.  The first candidate is the exact (case-insensitive)
    title match if there is one, then the smallest ``item_id``; the empty term
    is contained in every title.  Terms are
    joined by equality first; only terms without an exact match go through
    the gram-indexed ``contains`` join.  Output: ``term_col, item_id,
    item_type, item_title, tmdb_id`` (item columns null when nothing matches).
    """
    types = item_types or params.SEARCH_ITEM_TYPES
    cands = catalogue.filter(F.col("type").isin(types)).select(
        "item_id", F.col("type").alias("item_type"), F.col("title").alias("item_title"), "tmdb_id")
    # The distinct terms are computed once: every later decision reads them.
    wanted = materialize(
        terms.select(F.col(term_col).alias("_term")).filter(F.col("_term").isNotNull()).distinct())

    # Search terms are few next to the catalogue: broadcast them when the
    # count (read from the checkpoint) allows, so the catalogue is not shuffled.
    exact = materialize(cands.withColumn("_norm", F.lower("item_title")).join(
        broadcast_if_small(wanted.withColumn("_tnorm", F.lower("_term"))),
        F.col("_tnorm") == F.col("_norm"),
    ).select("_term", F.lit(0).alias("_exact"), "item_id", "item_type", "item_title", "tmdb_id"))

    rest = wanted.join(exact.select("_term"), "_term", "left_anti")
    candidates = exact
    if not rest.isEmpty():
        fuzzy = first_containing(cands, "item_title", "item_id", ["item_id", "item_type", "item_title", "tmdb_id"],
                                 rest, "_term")
        candidates = exact.unionByName(fuzzy.withColumn("_exact", F.lit(1)).select(exact.columns))

    best = keep_first(candidates, "_term", F.struct("_exact", "item_id"),
                      ["item_id", "item_type", "item_title", "tmdb_id"])
    return wanted.join(best, "_term", "left").withColumnRenamed("_term", term_col)


def search_exact(terms: DataFrame, catalogue: DataFrame, term_col: str = "title",
                 item_types: list[str] | None = None, known_max: int | None = None) -> DataFrame:
    """:func:`search_catalogue` for terms that are catalogue titles themselves.

    Such a term always has an exact (case-insensitive) match, and an exact
    match always wins, so the contains search is never needed: one equi-join
    and a first-by-``item_id`` aggregate give the same answer.  ``known_max``
    bounds the number of terms (a top-k list) so they are broadcast.
    """
    types = item_types or params.SEARCH_ITEM_TYPES
    cands = catalogue.filter(F.col("type").isin(types)).select(
        "item_id", F.col("type").alias("item_type"), F.col("title").alias("item_title"), "tmdb_id")
    wanted = terms.select(F.col(term_col).alias("_term")).filter(F.col("_term").isNotNull()).distinct()
    exact = cands.join(broadcast_if_small(wanted, known_max),
                       F.lower(F.col("_term")) == F.lower(F.col("item_title")))
    best = keep_first(exact, "_term", "item_id", ["item_id", "item_type", "item_title", "tmdb_id"])
    return wanted.join(best, "_term", "left").withColumnRenamed("_term", term_col)


def english_lookup(cache: DataFrame) -> DataFrame:
    """The English-title cache, one title per key: ``tmdb_id`` (as string), and ``item_type`` if it has one.

    Movies and series number their ids separately, so a cache of both kinds
    carries ``item_type``.  Of several entries for a key the first wins: the
    smallest ``seq`` (place in the file) where the cache has one, then the
    smallest title.
    """
    keys = _cache_keys(cache)
    seq = F.col("seq").cast("bigint") if "seq" in cache.columns else F.lit(0).cast("bigint")
    keyed = cache.select(*[F.col(k).cast("string").alias(k) for k in keys], F.col("title").alias("en_title"),
                         seq.alias("_seq")).filter(F.col("tmdb_id").isNotNull())
    return keep_first(keyed, keys, F.struct("_seq", "en_title"), ["en_title"])


def _cache_keys(cache: DataFrame) -> list[str]:
    return ["item_type", "tmdb_id"] if "item_type" in cache.columns else ["tmdb_id"]


def english_titles(found: DataFrame, cache: DataFrame, known_max: int | None = None) -> DataFrame:
    """Add ``english_title`` and ``status`` to rows that carry an item.

    ``status``: ok (from the cache), unresolved (id not cached: the catalogue
    title stands in), no_tmdb_id, no_item.  Only cache entries of wanted ids
    are aggregated, broadcast up to the bound; ``known_max`` bounds the rows of ``found`` (a top-k list).
    Rows without an id are spread by item, so they never meet in one task.
    """
    keys = _cache_keys(cache)
    wanted = found.filter(F.col("tmdb_id").isNotNull()).select(*keys).distinct()
    if known_max is None:
        wanted = materialize(wanted)        # counted and joined
    wanted = broadcast_if_small(wanted, known_max)      # so that the cache is filtered before it is shuffled
    typed = cache.withColumn("tmdb_id", F.col("tmdb_id").cast("string"))
    lookup = english_lookup(typed.join(wanted, keys, "left_semi")).withColumnRenamed("tmdb_id", "_en_id")
    tmdb = F.col("tmdb_id")
    spread = F.coalesce(tmdb, F.concat(F.lit("none "), F.coalesce(F.col("item_id").cast("string"), F.col(found.columns[0]).cast("string"))))
    same = F.col("_spread") == F.col("_en_id")
    if len(keys) > 1:
        lookup = lookup.withColumnRenamed("item_type", "_en_type")
        same = same & (F.col("item_type") == F.col("_en_type"))
    joined = found.withColumn("_spread", spread).join(lookup, same, "left")
    status = (
        F.when(F.col("item_id").isNull(), F.lit(STATUS_NO_ITEM))
        .when(tmdb.isNull() | (tmdb == ""), F.lit(STATUS_NO_TMDB_ID))
        .when(F.col("en_title").isNull(), F.lit(STATUS_UNRESOLVED))
        .otherwise(F.lit(STATUS_OK))
    )
    title = F.when(status.isin(USABLE), F.coalesce(F.col("en_title"), F.col("item_title")))
    return joined.select(*found.columns, title.alias("english_title"), status.alias("status"))


def missing_english(items: DataFrame, cache: DataFrame) -> DataFrame:
    """Items whose provider id is not in the cache: the to-resolve table (C3 misses)."""
    keyed = items.filter(F.col("tmdb_id").isNotNull() & (F.col("tmdb_id") != ""))
    keys = [k for k in _cache_keys(cache) if k in items.columns]
    return keyed.join(english_lookup(cache).select(*keys).distinct(), keys, "left_anti")


def item_genres(genre_links: DataFrame) -> DataFrame:
    """``item_id -> genres``: sorted distinct genre array per item (at most one per genre)."""
    return genre_links.groupBy("item_id").agg(F.sort_array(F.collect_set("genre")).alias("genres"))


def with_genres(rows: DataFrame, genre_links: DataFrame, known_max: int | None = None) -> DataFrame:
    """Add ``genres`` (array, empty when the item has none) by ``item_id``.

    The genre links are semi-joined to the wanted items before grouping.
    """
    # Wanted items are computed once; up to the bound they are broadcast, so the
    # filter runs before the links are shuffled for anything.
    ids = materialize(rows.select("item_id").filter(F.col("item_id").isNotNull()).distinct())
    ids = broadcast_if_small(ids, known_max)
    g = item_genres(genre_links.join(ids, "item_id", "left_semi"))
    return rows.join(g, "item_id", "left").withColumn(
        "genres", F.coalesce(F.col("genres"), F.array().cast("array<string>")))


def genre_ids(names: DataFrame, lookup: DataFrame, name_col: str = "genre",
              known_max: int | None = None) -> DataFrame:
    """Genre lookup rows whose name is among ``names`` (C4, semi-join)."""
    wanted = names.select(F.col(name_col).alias("name"))
    return lookup.join(broadcast_if_small(wanted, known_max), "name", "left_semi")


def titles_by_genres(ids: DataFrame, lookup: DataFrame, genre_links: DataFrame,
                     catalogue: DataFrame, item_type: str, known_max: int | None = None) -> DataFrame:
    """Every catalogue item of ``item_type`` having one of the genre ids.

    ``ids`` holds a column ``id`` (a top-k list, so it is broadcast after a
    size check).  Output: ``genre_id, item_id, title``.
    """
    chosen = ids.select(F.col("id").alias("genre_id")).join(
        lookup.select(F.col("id").alias("genre_id"), F.col("name").alias("genre")), "genre_id")
    if known_max is not None and known_max <= params.FILTER_NAMES:
        # A few names: as a filter they reach the scan below the links' distinct.
        chosen = materialize(chosen)
        genre_links = genre_links.filter(F.col("genre").isin([r["genre"] for r in chosen.collect()]))
    chosen = broadcast_if_small(chosen, known_max)
    items = catalogue.filter(F.col("type") == item_type).select("item_id", "title")
    return genre_links.join(chosen, "genre").join(items, "item_id").select("genre_id", "item_id", "title")
