"""Recommendations for one user (P3 movies, P4 series).

Movies: the genres of the movies a user watched, counted; the three most
frequent genres; every catalogue movie scored by how many of those genres it
has; the three best, with English title and genres.

Series: the user's series titles resolved to genre baskets (first-wins
merge with earlier history), FP-Growth rules mined over the baskets, the
genres the rules predict counted, then the same tail with catalogue series.

Small decision inputs (search terms, wanted items, the top lists, FP-Growth
baskets) are materialised on the way; the facts stay in one lazy chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playlens import params
from playlens.functions.text import genre_array, genre_string
from playlens.operators import aggregates as agg
from playlens.operators import catalogue as cat
from playlens.operators import events as ev
from playlens.operators import rules
from playlens.operators.barrier import materialize


def user_titles(media: DataFrame, user_id: str, kind: str) -> DataFrame:
    """Distinct titles of one kind that one user watched."""
    titled = ev.with_kind(ev.user_history(media, user_id))
    return titled.filter(F.col("kind") == kind).select("title").distinct()


def resolve_titles(titles: DataFrame, catalogue: DataFrame, cache: DataFrame,
                   genre_links: DataFrame, catalogue_titles: bool = False,
                   known_max: int | None = None) -> DataFrame:
    """Search each title, attach English title, status and genres.

    Output: ``title, item_id, item_type, item_title, tmdb_id, english_title,
    status, genres`` (``genres`` a sorted array, empty when the item has none).
    ``catalogue_titles=True`` says the titles come from the catalogue itself,
    so the exact-match search gives the same first item without the
    contains fallback.  ``known_max`` bounds the number of titles (top-k).
    """
    if catalogue_titles:
        found = cat.search_exact(titles, catalogue, known_max=known_max)
    else:
        # read for the wanted ids, the wanted items and the rows themselves: the search runs once
        found = materialize(cat.search_catalogue(titles, catalogue))
    return cat.with_genres(cat.english_titles(found, cache, known_max), genre_links, known_max)


def usable(resolved: DataFrame) -> DataFrame:
    """Rows whose search gave an item with a provider id."""
    return resolved.filter(F.col("status").isin(cat.USABLE))


def genre_counts(resolved: DataFrame) -> DataFrame:
    """Genre frequency over resolved titles, one vote per title."""
    return agg.value_counts(resolved.select(F.explode("genres").alias("genre")), "genre")


def top_genres(counts: DataFrame, k: int = params.TOP_GENRES) -> DataFrame:
    """The ``k`` most frequent genres, ties by name: ``genre, counts, rank``."""
    top = counts.orderBy(F.col("counts").desc(), F.col("genre").asc()).limit(k)
    # At most k rows: a window without partitioning is bounded here.
    return top.withColumn(
        "rank", F.row_number().over(Window.orderBy(F.col("counts").desc(), F.col("genre").asc())))


def genre_hits(top: DataFrame, lookup: DataFrame, genre_links: DataFrame, catalogue: DataFrame,
               item_type: str, k: int = params.TOP_GENRES) -> DataFrame:
    """Catalogue titles of ``item_type`` scored by how many top genres they have."""
    ids = cat.genre_ids(top, lookup, known_max=k)
    found = cat.titles_by_genres(ids, lookup, genre_links, catalogue, item_type, known_max=k)
    return found.groupBy("title").agg(F.count(F.lit(1)).alias("hits"))


def top_titles(hits: DataFrame, k: int = params.TOP_TITLES) -> DataFrame:
    """The ``k`` titles with most hits, ties by title: ``title, hits, rank``."""
    order = [F.col("hits").desc(), F.col("title").asc()]
    top = hits.orderBy(*order).limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def recommend_details(top: DataFrame, catalogue: DataFrame, cache: DataFrame,
                      genre_links: DataFrame) -> DataFrame:
    """Winners re-joined to their item, English title and genres, rank kept.

    Output: ``rank, title, genres, hits`` where ``title`` is the English
    title (the catalogue title when the cache has none) and ``genres`` a
    sorted ``", "``-joined string.
    """
    top = materialize(top)          # k rows; the lookups below read them, not the chain
    details = resolve_titles(top.select("title"), catalogue, cache, genre_links, catalogue_titles=True,
                             known_max=params.TOP_TITLES)
    return top.join(details, "title", "left").select(
        "rank",
        F.coalesce(F.col("english_title"), F.col("title")).alias("title"),
        genre_string(F.coalesce(F.col("genres"), F.array().cast("array<string>"))).alias("genres"),
        "hits",
    )


def without_watched(hits: DataFrame, media: DataFrame, user_id: str, kind: str) -> DataFrame:
    """Drop titles the user already watched (optional; off by default as in the original)."""
    watched = user_titles(media, user_id, kind)
    return hits.join(watched, "title", "left_anti")


def recommend_movies(media: DataFrame, catalogue: DataFrame, cache: DataFrame,
                     genre_links: DataFrame, lookup: DataFrame,
                     user_id: str = params.DEFAULT_USER,
                     previous_counts: DataFrame | None = None,
                     exclude_watched: bool = False) -> DataFrame:
    """Top-3 movie recommendations for one user.

    ``previous_counts`` (``genre, counts``) is merged in first, the
    cumulative form of the genre counts kept across batches.
    ``exclude_watched`` leaves out movies the user has already seen.
    """
    resolved = usable(resolve_titles(user_titles(media, user_id, params.KIND_MOVIE),
                                     catalogue, cache, genre_links))
    counts = genre_counts(resolved)
    if previous_counts is not None:
        counts = agg.merge_counts(previous_counts, counts)
    top = top_genres(counts)
    hits = genre_hits(top, lookup, genre_links, catalogue, "Movie")
    if exclude_watched:
        hits = without_watched(hits, media, user_id, params.KIND_MOVIE)
    return recommend_details(top_titles(hits), catalogue, cache, genre_links)


def series_history(resolved: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Title -> genres, first wins: earlier history before this batch.

    ``resolved`` rows give ``Title`` = English title and ``Genres`` = joined
    genre string; ``history`` has the same two columns.
    """
    latest = usable(resolved).select(
        F.col("english_title").alias("Title"), genre_string("genres").alias("Genres"),
        F.lit(1).alias("_seq"))
    rows = latest
    if history is not None:
        rows = history.select("Title", "Genres", F.lit(0).alias("_seq")).unionByName(latest)
    return agg.keep_first(rows, "Title", F.struct("_seq", "Genres"), ["Genres"])


def series_baskets(history: DataFrame) -> DataFrame:
    """``Title, Genres, basket``: genre string -> distinct array, empty -> null (H8)."""
    return history.withColumn("basket", genre_array("Genres"))


def predicted_genre_counts(baskets: DataFrame, model=None) -> DataFrame:
    """Genres predicted by the rules, one vote per basket.

    FP-Growth reads its input several times, so the baskets are materialised first.
    """
    baskets = materialize(baskets)
    model = model or rules.fit_rules(baskets)
    predicted = rules.predict(model, baskets)
    return agg.value_counts(rules.predicted_genres(predicted), "genre")


def recommend_series(media: DataFrame, catalogue: DataFrame, cache: DataFrame,
                     genre_links: DataFrame, lookup: DataFrame,
                     user_id: str = params.DEFAULT_USER,
                     history: DataFrame | None = None,
                     exclude_watched: bool = False) -> DataFrame:
    """Top-3 series recommendations for one user from FP-Growth predictions.

    ``exclude_watched`` leaves out series the user has already seen.
    """
    resolved = resolve_titles(user_titles(media, user_id, params.KIND_SERIES),
                              catalogue, cache, genre_links)
    baskets = series_baskets(series_history(resolved, history))
    top = top_genres(predicted_genre_counts(baskets))
    hits = genre_hits(top, lookup, genre_links, catalogue, "Series")
    if exclude_watched:
        hits = without_watched(hits, media, user_id, params.KIND_SERIES)
    return recommend_details(top_titles(hits), catalogue, cache, genre_links)
