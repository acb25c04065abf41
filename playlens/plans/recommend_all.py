"""Recommendations for all users in one run (P3 and P4 without the fixed user).

The same answers as :mod:`playlens.plans.recommend` gives user by user, from one
pass over the log.  The product users x genres x titles is never made:

* titles are searched and resolved once each, whoever watched them;
* the top titles depend on a user's top genres alone, so users with the same
  genres share a *profile*, and the tail runs once per profile;
* a title's hits depend on its genres alone, so catalogue titles with the same
  genres share a *combination*, of which only the first ``k`` titles can win.

Profiles and combinations are bounded by the genre vocabulary, not by users
or titles.  Top-k steps filter a ``row_number``, which Spark runs as a
window group limit: every task keeps ``k`` rows of a key before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playlens import params
from playlens.functions.text import genre_string
from playlens.operators import aggregates as agg
from playlens.operators import events as ev
from playlens.operators import rules
from playlens.operators.barrier import materialize
from playlens.operators.textjoin import broadcast_if_small
from playlens.plans import recommend as rec


def top_of(df: DataFrame, keys: list[str], order: list, k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of each key, with their place."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col(rank) <= k)


def user_resolved(media: DataFrame, kind: str, catalogue: DataFrame, cache: DataFrame, genre_links: DataFrame) -> DataFrame:
    """Every user's distinct titles of one kind with item, English title, status and genres; usable ones only."""
    titles = materialize(ev.with_kind(media).filter((F.col("kind") == kind) & F.col("user_id").isNotNull())
                         .select("user_id", "title").distinct())
    resolved = materialize(rec.usable(rec.resolve_titles(titles.select("title").distinct(), catalogue, cache, genre_links)))
    return titles.join(broadcast_if_small(resolved), "title")


def top_genres(counts: DataFrame, lookup: DataFrame, k: int = params.TOP_GENRES) -> DataFrame:
    """``user_id, profile``: each user's ``k`` most frequent genres (ties by name) that the lookup knows, sorted."""
    top = top_of(counts, ["user_id"], [F.col("counts").desc(), F.col("genre").asc()], k)
    known = lookup.filter(F.col("id").isNotNull()).select(F.col("name").alias("genre")).distinct()
    return top.join(known, "genre", "left_semi").groupBy("user_id").agg(F.sort_array(F.collect_list("genre")).alias("profile"))


def genre_combinations(genre_links: DataFrame, catalogue: DataFrame, item_type: str, genres: DataFrame,
                       k: int = params.TOP_TITLES) -> DataFrame:
    """``combo, title``: the first ``k`` titles of every combination of (genre, items) among ``genres``."""
    items = catalogue.filter(F.col("type") == item_type).select("item_id", "title")
    links = genre_links.join(broadcast_if_small(genres), "genre", "left_semi").join(items, "item_id")
    per_title = links.groupBy("title", "genre").agg(F.count(F.lit(1)).alias("n"))
    combos = per_title.groupBy("title").agg(F.sort_array(F.collect_list(F.struct("genre", "n"))).alias("combo"))
    return top_of(combos, ["combo"], [F.col("title").asc()], k).select("combo", "title")


def profile_winners(profiles: DataFrame, genre_links: DataFrame, catalogue: DataFrame, cache: DataFrame, item_type: str,
                    k: int = params.TOP_TITLES) -> DataFrame:
    """``profile, rank, title, genres, hits``: the ``k`` best titles of every profile."""
    wanted = profiles.select("profile", F.explode("profile").alias("genre"))
    titles = materialize(genre_combinations(genre_links, catalogue, item_type, wanted.select("genre").distinct(), k))
    combos = titles.select("combo").distinct().select("combo", F.explode("combo").alias("_g")).select(
        "combo", F.col("_g.genre").alias("genre"), F.col("_g.n").alias("n"))
    hits = combos.join(broadcast_if_small(wanted), "genre").groupBy("profile", "combo").agg(F.sum("n").alias("hits"))
    best = materialize(top_of(hits.join(titles, "combo"), ["profile"], [F.col("hits").desc(), F.col("title").asc()], k)
                       .select("profile", "rank", "title", "hits"))
    details = rec.resolve_titles(best.select("title").distinct(), catalogue, cache, genre_links, catalogue_titles=True)
    return best.join(details, "title", "left").select(
        "profile", "rank", F.coalesce("english_title", "title").alias("title"),
        genre_string(F.coalesce(F.col("genres"), F.array().cast("array<string>"))).alias("genres"), "hits")


def recommend_profiles(counts: DataFrame, lookup: DataFrame, genre_links: DataFrame, catalogue: DataFrame, cache: DataFrame,
                       item_type: str) -> DataFrame:
    """From ``user_id, genre, counts`` to ``user_id, rank, title, genres, hits``."""
    users = materialize(top_genres(counts, lookup))
    winners = materialize(profile_winners(materialize(users.select("profile").distinct()), genre_links, catalogue, cache, item_type))
    return users.join(broadcast_if_small(winners), "profile").select("user_id", "rank", "title", "genres", "hits")


def recommend_movies_all(media: DataFrame, catalogue: DataFrame, cache: DataFrame, genre_links: DataFrame, lookup: DataFrame,
                         previous_counts: DataFrame | None = None) -> DataFrame:
    """Top-3 movies of every user (P3).  ``previous_counts`` (``user_id, genre, counts``) is added first."""
    resolved = user_resolved(media, params.KIND_MOVIE, catalogue, cache, genre_links)
    counts = resolved.select("user_id", F.explode("genres").alias("genre")).groupBy("user_id", "genre").agg(F.count(F.lit(1)).alias("counts"))
    if previous_counts is not None:
        counts = (previous_counts.select("user_id", "genre", F.col("counts").cast("bigint").alias("counts")).unionByName(counts)
                  .groupBy("user_id", "genre").agg(F.sum("counts").alias("counts")))
    return recommend_profiles(counts, lookup, genre_links, catalogue, cache, "Movie")


def series_history_all(resolved: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """``user_id, Title, Genres``: first wins per user, earlier history before this batch."""
    rows = resolved.select("user_id", F.col("english_title").alias("Title"), genre_string("genres").alias("Genres"), F.lit(1).alias("_seq"))
    if history is not None:
        rows = history.select("user_id", "Title", "Genres", F.lit(0).alias("_seq")).unionByName(rows)
    return agg.keep_first(rows, ["user_id", "Title"], F.struct("_seq", "Genres"), ["Genres"])


def predicted_genre_counts_all(baskets: DataFrame) -> DataFrame:
    """``user_id, genre, counts``: genres predicted by each user's own rules, one vote per basket."""
    baskets = materialize(baskets.select("user_id", "basket"))
    found = rules.group_rules(rules.group_itemsets(baskets, "user_id"), "user_id")
    predicted = rules.apply_rules(baskets, found, keys=["user_id"])
    return rules.predicted_genres(predicted, ["user_id"]).groupBy("user_id", "genre").agg(F.count(F.lit(1)).alias("counts"))


def recommend_series_all(media: DataFrame, catalogue: DataFrame, cache: DataFrame, genre_links: DataFrame, lookup: DataFrame,
                         history: DataFrame | None = None) -> DataFrame:
    """Top-3 series of every user from rules mined over that user's own baskets."""
    resolved = user_resolved(media, params.KIND_SERIES, catalogue, cache, genre_links)
    baskets = rec.series_baskets(series_history_all(resolved, history))
    return recommend_profiles(predicted_genre_counts_all(baskets), lookup, genre_links, catalogue, cache, "Series")
