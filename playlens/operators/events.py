"""Operators on the activity log: flatten, filter, extract, split.

Every function takes and returns a DataFrame and works on batch and
streaming DataFrames alike (except where noted).  Log rows carry the columns
``id, date, user_id, type, name``; ``date`` is a UTC ``timestamp_ntz``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens import params
from playlens.functions.text import is_series_title, media_name, series_name
from playlens.functions.time import event_time, ntz_literal, range_start
from playlens.operators.textjoin import contains_matches, row_count_at_most

LOG_COLUMNS = ["id", "date", "user_id", "type", "name"]


# ---- B1-B3: flatten ---------------------------------------------------------------

def flatten_log(envelopes: DataFrame, keep_raw_date: bool = False) -> DataFrame:
    """Envelope rows (``Items`` array, ``TotalRecordCount``) -> one row per item.

    A null or empty ``Items`` array yields no row.  ``Date`` strings are parsed
    once here; a malformed date becomes null (see :func:`rejected_rows`).
    """
    items = envelopes.select(F.explode("Items").alias("item"))
    cols = [
        F.col("item.Id").alias("id"),
        event_time(F.col("item.Date")).alias("date"),
        F.col("item.UserId").alias("user_id"),
        F.col("item.Type").alias("type"),
        F.col("item.Name").alias("name"),
    ]
    if keep_raw_date:
        cols.append(F.col("item.Date").alias("date_raw"))
    return items.select(*cols)


def rejected_rows(flat: DataFrame) -> DataFrame:
    """Rows whose raw date did not parse (needs ``keep_raw_date=True``)."""
    return flat.filter(F.col("date").isNull() & F.col("date_raw").isNotNull())


def item_names(envelopes: DataFrame) -> DataFrame:
    """The ``Name`` of every item of every envelope, without exploding the struct."""
    return envelopes.select(F.explode(F.col("Items.Name")).alias("name"))


# ---- B5-B7: filters and extraction -------------------------------------------------

def filter_event_type(log: DataFrame, types: list[str] | None = None) -> DataFrame:
    return log.filter(F.col("type").isin(types or params.PLAYBACK_TYPES))


def filter_denylist(log: DataFrame, deny: DataFrame, pattern_col: str = "pattern",
                    text_col: str = "name", mode: str = "literal",
                    known_max: int | None = None, nested_pairs: int = params.NESTED_LOOP_PAIRS) -> DataFrame:
    """Drop log rows whose sentence contains any deny-list entry (C1, anti theta-join).

    ``mode="literal"`` matches entries as plain substrings; ``mode="regex"``
    treats them as unanchored regular expressions, like an alternation of all
    entries.  A null sentence is dropped too.  The plan follows the cost: a
    deny-list of a few hundred entries (``known_max``, a bound the caller proves, or
    counted), or rows x entries up to ``nested_pairs``, is broadcast to a nested-loop
    anti join (no shuffle of the log).  A larger literal list goes through the
    exact gram-indexed join, keyed by each entry's rarest gram; a larger list of
    regular expressions, or for a stream, is taken in blocks of bounded size,
    one anti join each.
    """
    pats = deny.select(F.col(pattern_col).alias("_deny")).filter(
        F.col("_deny").isNotNull() & (F.length("_deny") > 0))
    text = F.col(text_col)
    live = log.filter(text.isNotNull())
    cond = F.expr(f"`{text_col}` RLIKE _deny") if mode == "regex" else text.contains(F.col("_deny"))
    few, limit = params.NESTED_LOOP_PATTERNS, params.BROADCAST_ROW_LIMIT
    if (known_max is not None and known_max <= few) or row_count_at_most(pats, few):
        return live.join(F.broadcast(pats), cond, "left_anti")
    n = pats.count()
    by_block = mode == "regex" or log.isStreaming
    if n <= limit and (by_block or row_count_at_most(live, nested_pairs // n)):
        return live.join(F.broadcast(pats), cond, "left_anti")
    if by_block:
        n_blocks = -(-2 * n // limit)        # hash blocks of half the limit on average
        block = F.pmod(F.xxhash64("_deny"), F.lit(n_blocks))
        for b in range(n_blocks):
            live = live.join(F.broadcast(pats.filter(block == b)), cond, "left_anti")
        return live
    hits = contains_matches(live.select(text_col), text_col, pats, "_deny", rarest=True).select(text_col).distinct()
    return live.join(hits, text_col, "left_anti")


def denylist_hits(log: DataFrame, deny: DataFrame, pattern_col: str = "pattern", text_col: str = "name") -> DataFrame:
    """Rows of the log with each deny-list entry their sentence contains.

    A list of checked size is broadcast and the log is not shuffled; a larger
    one goes through the gram-indexed join on the distinct sentences.
    """
    pats = deny.select(F.col(pattern_col)).filter(F.length(pattern_col) > 0).distinct()
    if row_count_at_most(pats, params.BROADCAST_ROW_LIMIT):
        return log.join(F.broadcast(pats), F.col(text_col).contains(F.col(pattern_col)))
    return log.join(contains_matches(log.select(text_col), text_col, pats, pattern_col), text_col)


def with_media_name(log: DataFrame, pattern: str = params.MEDIA_NAME_PATTERN) -> DataFrame:
    """Add ``media_name`` (title from the sentence); drop rows without one."""
    return log.withColumn("media_name", media_name("name", pattern)).filter(
        (F.col("media_name") != "") & F.col("media_name").isNotNull())


def media_events(log: DataFrame, deny: DataFrame, mode: str = "literal",
                 deny_max: int | None = None) -> DataFrame:
    """Type filter -> deny-list -> title extraction: the cleaned playback stream."""
    return with_media_name(filter_denylist(filter_event_type(log), deny, mode=mode, known_max=deny_max))


# ---- B8-B12: selections -------------------------------------------------------------

def user_history(log: DataFrame, user_id: str = params.DEFAULT_USER) -> DataFrame:
    return log.filter(F.col("user_id") == F.lit(str(user_id)))


def in_time_range(log: DataFrame, as_of, time_range: str, time_col: str = "date") -> DataFrame:
    """Rows of the range that ends at ``as_of``: ``as_of - range <= time_col <= as_of``."""
    end = as_of if isinstance(as_of, Column) else ntz_literal(as_of)
    return log.filter((F.col(time_col) >= range_start(as_of, time_range)) & (F.col(time_col) <= end))


def pulled_since(log: DataFrame, as_of=None, overlap_days: int = params.PULL_OVERLAP_DAYS,
                 time_col: str = "date") -> DataFrame:
    """Incremental pull (A10): entries dated on or after ``as_of - overlap`` days.

    ``as_of=None`` is the first pull and takes everything.
    """
    if as_of is None:
        return log
    start = F.date_sub(F.to_date(ntz_literal(as_of)), overlap_days)
    return log.filter(F.to_date(F.col(time_col)) >= start)


def split_series(media: DataFrame, pattern: str = params.SERIES_NAME_PATTERN) -> DataFrame:
    """Series rows: ``media_name`` replaced by the part before the first dash."""
    return media.withColumn("media_name", series_name("media_name", pattern)).filter(
        F.col("media_name").isNotNull())


def split_movies(media: DataFrame, pattern: str = params.SERIES_NAME_PATTERN) -> DataFrame:
    """Movie rows: titles without the episode dash (null titles drop out)."""
    return media.filter(~is_series_title("media_name", pattern))


def with_kind(media: DataFrame, pattern: str = params.SERIES_NAME_PATTERN) -> DataFrame:
    """Both branches in one pass: ``kind`` (series/movie) and ``title``.

    Equivalent to the union of :func:`split_series` and :func:`split_movies`
    but reads the rows once.
    """
    series = is_series_title("media_name", pattern)
    return media.filter(F.col("media_name").isNotNull()).select(
        *media.columns,
        F.when(series, F.lit(params.KIND_SERIES)).otherwise(F.lit(params.KIND_MOVIE)).alias("kind"),
        F.when(series, series_name("media_name", pattern)).otherwise(F.col("media_name")).alias("title"),
    )


# ---- B9, D4, D9: high-water mark -----------------------------------------------------

def high_water_mark(log: DataFrame) -> DataFrame:
    """Newest id of a batch as a one-row frame (``max``, not the first row)."""
    return log.agg(F.max("id").alias("mark"))


def high_water_filter(log: DataFrame, mark: int | DataFrame | Column | None) -> DataFrame:
    """Rows with an id above the last processed one.

    ``mark`` may be a number, a one-row frame with column ``mark`` (read as a
    scalar subquery, so nothing passes through the driver) or None (first
    batch: keep everything).
    """
    if mark is None:
        return log
    if isinstance(mark, DataFrame):
        mark = mark.select(F.max("mark")).scalar()
    elif not isinstance(mark, Column):
        mark = F.lit(mark)
    # No mark yet (first batch): everything is new.
    return log.filter(mark.isNull() | (F.col("id") > mark))


def batch_counts(log: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows of a batch and rows left after filtering, as one row (one job, no join)."""
    tagged = (
        log.select(F.lit(1).alias("_b"), F.lit(0).alias("_k"))
        .unionByName(kept.select(F.lit(0).alias("_b"), F.lit(1).alias("_k")))
    )
    return tagged.agg(
        F.coalesce(F.sum("_b"), F.lit(0)).cast("bigint").alias("batch_rows"),
        F.coalesce(F.sum("_k"), F.lit(0)).cast("bigint").alias("kept_rows"),
    )
