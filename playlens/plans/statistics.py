"""View statistics (P1), their English titles (P2) and the chart table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens import params
from playlens.operators import aggregates as agg
from playlens.operators import events as ev
from playlens.operators.ranking import ordered_position


def ranked_views(titled: DataFrame) -> DataFrame:
    """``(kind, title, views, rank)``: views per title, ranked within each kind.

    Ties go by title, so the ranking is deterministic.
    """
    views = agg.title_views(titled)
    return ordered_position(views, ["kind"], [F.col("views").desc(), F.col("title").asc()])


def view_statistics(log: DataFrame, deny: DataFrame, as_of, time_range: str = "month",
                    deny_mode: str = "literal", deny_max: int | None = None) -> DataFrame:
    """Views per movie and per series in the range ending at ``as_of``.

    One ``groupBy(kind, title)`` serves both kinds, and names and counts come
    out of the same frame, so they cannot drift apart.
    """
    media = ev.in_time_range(ev.media_events(log, deny, deny_mode, deny_max), as_of, time_range)
    return ranked_views(ev.with_kind(media))


def chart_table(stats: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Rows of the two bar charts: ``panel, panel_title, position, label, views``.

    ``labels`` (``kind, title, label``) replaces titles by display names
    (for instance English titles); titles without a label keep their own.
    """
    rows = stats
    label = F.col("title")
    if labels is not None:
        rows = rows.join(labels.select("kind", "title", F.col("label").alias("_label")),
                         ["kind", "title"], "left")
        label = F.coalesce(F.col("_label"), F.col("title"))
    return rows.select(
        F.col("kind").alias("panel"),
        F.when(F.col("kind") == params.KIND_MOVIE, F.lit(params.CHART_TITLE_MOVIES))
        .otherwise(F.lit(params.CHART_TITLE_SERIES)).alias("panel_title"),
        F.col("rank").alias("position"),
        label.alias("label"),
        F.col("views"),
    )


def view_statistics_english(stats: DataFrame, catalogue: DataFrame, cache: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """Ranked statistics with the English title of each title's catalogue item.

    The search and the lookup join on the ranked frame itself, so a failed
    lookup leaves a null title in its own row instead of shifting names
    against counts.  ``found`` (``title, english_title, status``) gives the titles
    that were searched before.
    """
    from playlens.operators import catalogue as cat

    if found is None:
        found = cat.english_titles(cat.search_catalogue(stats.select("title"), catalogue), cache)
    return stats.join(found.select("title", "english_title", "status"), "title", "left").select(
        "kind", "title", "views", "rank", "english_title", "status")
