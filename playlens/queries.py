"""The registered queries: one callable ``(spark, sf_dir) -> DataFrame`` each.

Every query reads the parquet tables of ``sf_dir`` through the derived
playback views, with the parameters of FIXTURES.md §3.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from playlens import params
from playlens.functions.time import ntz_literal, pull_start_date
from playlens.operators import aggregates as agg
from playlens.operators import catalogue as cat
from playlens.operators import events as ev
from playlens.operators import rules
from playlens.plans import recommend as rec
from playlens.plans import recommend_all as rec_all
from playlens.plans import statistics as st
from playlens.operators.barrier import materialize
from playlens.schemas import ENGLISH_TITLES, TITLE_GENRES
from playlens.session import scratch_path
from playlens.sources import csvio, envelope
from playlens.sources import tables as tb
from playlens.streaming import jobs, state
from playlens.streaming.runner import latest_version, replay_pulls

# ---- fixture parameters (FIXTURES.md §3) --------------------------------------------
AS_OF_MONTH = "2024-02-15 00:00:00"
AS_OF_WEEK = "2024-01-31 00:00:00"
AS_OF_HALF_YEAR = "2024-07-15 00:00:00"
AS_OF_PULL = "2024-01-20 00:00:00"
USER_ID = "1"
HISTORY_SPLIT = "2024-01-20 00:00:00"   # stored history before it, new batch from it
STATS_CSV = "kind string, title string, views bigint, rank int"
CATALOGUE_ITEM = "Id bigint, Name string, Type string, Genres array<string>, ProviderIds map<string,string>"

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(fn: QueryFn) -> QueryFn:
    QUERIES[fn.__name__] = fn
    return fn


class Views:
    """The derived views of one scale-factor directory, built once per query."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.t = tb.Tables(spark, sf_dir)
        self._cat = None

    @property
    def catalogue(self) -> DataFrame:
        if self._cat is None:
            self._cat = tb.catalogue(self.t)
        return self._cat

    @property
    def log(self) -> DataFrame:
        return tb.playback_log(self.t, self.catalogue)

    def log_of(self, user_id: str) -> DataFrame:
        return tb.playback_log(self.t, self.catalogue, int(user_id))

    @property
    def deny(self) -> DataFrame:
        return tb.denylist(self.spark)

    @property
    def genres(self) -> DataFrame:
        return tb.catalogue_genres(self.t)

    @property
    def genre_lookup(self) -> DataFrame:
        return tb.genre_lookup(self.t)

    @property
    def english(self) -> DataFrame:
        return tb.english_titles(self.t, self.catalogue)


# ---- statistics --------------------------------------------------------------------------

@query
def view_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = Views(spark, sf_dir)
    return st.view_statistics(v.log, v.deny, AS_OF_MONTH, "month", deny_max=len(tb.DENYLIST_PATTERNS))


# ---- helpers ------------------------------------------------------------------------------

def ts_text(col: str = "date", name: str | None = None):
    """Timestamps leave the queries as text, so every engine compares the same value."""
    return F.date_format(F.col(col), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(name or col)


def _media(v: Views, user_id: str | None = None) -> DataFrame:
    log = v.log if user_id is None else v.log_of(user_id)
    return ev.media_events(log, v.deny, deny_max=len(tb.DENYLIST_PATTERNS))


def _titled(v: Views) -> DataFrame:
    return ev.with_kind(_media(v))


def _first_pull(v: Views) -> DataFrame:
    """The pull before ``AS_OF_PULL``: everything dated before it."""
    return v.log.filter(F.col("date") < ntz_literal(AS_OF_PULL))


def _second_pull(v: Views) -> DataFrame:
    """The pull at ``AS_OF_PULL``: entries from two days before it on (overlapping)."""
    return ev.pulled_since(v.log, AS_OF_PULL)


# ---- log operators (B1-B12, A10, D4, D9) -----------------------------------------------------

@query
def filter_event_type(spark, sf_dir):
    v = Views(spark, sf_dir)
    return ev.filter_event_type(v.log).select("id", ts_text(), "user_id", "type", "name")


@query
def filter_denylist(spark, sf_dir):
    v = Views(spark, sf_dir)
    return ev.filter_denylist(ev.filter_event_type(v.log), v.deny,
                              known_max=len(tb.DENYLIST_PATTERNS)).select("id", "user_id", "name")


@query
def extract_media_name(spark, sf_dir):
    return _media(Views(spark, sf_dir)).select("id", "user_id", "media_name")


@query
def split_series(spark, sf_dir):
    return ev.split_series(_media(Views(spark, sf_dir))).select("id", "media_name")


@query
def split_movies(spark, sf_dir):
    return ev.split_movies(_media(Views(spark, sf_dir))).select("id", "media_name")


@query
def user_history(spark, sf_dir):
    media = _media(Views(spark, sf_dir), USER_ID)
    return ev.user_history(media, USER_ID).select("id", ts_text(), "media_name")


def _time_range(spark, sf_dir, as_of, rng):
    media = _media(Views(spark, sf_dir))
    return ev.in_time_range(media, as_of, rng).select("id", ts_text(), "media_name")


@query
def time_range_week(spark, sf_dir):
    return _time_range(spark, sf_dir, AS_OF_WEEK, "week")


@query
def time_range_month(spark, sf_dir):
    return _time_range(spark, sf_dir, AS_OF_MONTH, "month")


@query
def time_range_half_year(spark, sf_dir):
    return _time_range(spark, sf_dir, AS_OF_HALF_YEAR, "half_year")


@query
def incremental_pull(spark, sf_dir):
    v = Views(spark, sf_dir)
    return _second_pull(v).select("id", ts_text(), "name", pull_start_date(AS_OF_PULL).alias("pull_from"))


@query
def high_water_mark(spark, sf_dir):
    v = Views(spark, sf_dir)
    parts = []
    for n, pull in ((1, _first_pull(v)), (2, _second_pull(v))):
        parts.append(pull.agg(F.lit(n).alias("pull"), F.count(F.lit(1)).alias("rows"),
                              F.max("id").alias("mark")))
    return parts[0].unionByName(parts[1])


@query
def high_water_filter(spark, sf_dir):
    v = Views(spark, sf_dir)
    mark = ev.high_water_mark(_first_pull(v))
    return ev.high_water_filter(_second_pull(v), mark).select("id", "name")


@query
def batch_counts(spark, sf_dir):
    v = Views(spark, sf_dir)
    batch = _second_pull(v)
    kept = ev.high_water_filter(batch, ev.high_water_mark(_first_pull(v)))
    return ev.batch_counts(batch, kept)


# ---- statistics (D1, D2, F1, P1, P2, P6) ------------------------------------------------------

@query
def distinct_titles(spark, sf_dir):
    return agg.distinct_titles(_titled(Views(spark, sf_dir)))


def _month_stats(v: Views) -> DataFrame:
    return st.view_statistics(v.log, v.deny, AS_OF_MONTH, "month", deny_max=len(tb.DENYLIST_PATTERNS))


@query
def series_views(spark, sf_dir):
    stats = _month_stats(Views(spark, sf_dir))
    return stats.filter(F.col("kind") == params.KIND_SERIES).select("title", "views", "rank")


@query
def movie_views(spark, sf_dir):
    stats = _month_stats(Views(spark, sf_dir))
    return stats.filter(F.col("kind") == params.KIND_MOVIE).select("title", "views", "rank")


@query
def view_statistics_english(spark, sf_dir):
    v = Views(spark, sf_dir)
    return st.view_statistics_english(_month_stats(v), v.catalogue, v.english)


@query
def chart_table(spark, sf_dir):
    v = Views(spark, sf_dir)
    english = st.view_statistics_english(_month_stats(v), v.catalogue, v.english)
    labels = english.select("kind", "title", F.col("english_title").alias("label"))
    return st.chart_table(english, labels)


# ---- catalogue lookups (C2-C5) ---------------------------------------------------------------

def _searched(v: Views) -> DataFrame:
    terms = agg.distinct_titles(_titled(v))
    return terms.join(cat.search_catalogue(terms.select("title"), v.catalogue), "title")


@query
def search_catalogue(spark, sf_dir):
    return _searched(Views(spark, sf_dir)).select(
        "kind", "title", "item_id", "item_type", "item_title", "tmdb_id")


@query
def search_status(spark, sf_dir):
    v = Views(spark, sf_dir)
    return cat.english_titles(_searched(v), v.english).select("kind", "title", "status", "english_title")


@query
def english_title_lookup(spark, sf_dir):
    v = Views(spark, sf_dir)
    items = v.catalogue.filter(F.col("tmdb_id").isNotNull())
    lookup = cat.english_lookup(v.english)
    return items.join(lookup, "tmdb_id", "left").select(
        "item_id", "tmdb_id",
        F.coalesce(F.col("en_title"), F.col("title")).alias("title"),
        F.col("en_title").isNotNull().alias("cached"))


@query
def english_title_missing(spark, sf_dir):
    v = Views(spark, sf_dir)
    return cat.missing_english(v.catalogue, v.english).select("item_id", "tmdb_id", "type")


# ---- genres and the movie recommendation chain (D5, D8, D10, F2-F4, C4-C6, P3) --------------

@query
def genre_strings(spark, sf_dir):
    v = Views(spark, sf_dir)
    return agg.sorted_genre_string(v.genres, "item_id")


@query
def genres_exploded(spark, sf_dir):
    v = Views(spark, sf_dir)
    strings = agg.sorted_genre_string(v.genres, "item_id", out="Genres")
    return agg.explode_genres(strings, "Genres").select("item_id", "genre")


def _user_movies(v: Views) -> DataFrame:
    titles = rec.user_titles(_media(v, USER_ID), USER_ID, params.KIND_MOVIE)
    return rec.usable(rec.resolve_titles(titles, v.catalogue, v.english, v.genres))


def _movie_top_genres(v: Views) -> DataFrame:
    return rec.top_genres(rec.genre_counts(_user_movies(v)))


@query
def genre_counts_movies(spark, sf_dir):
    return rec.genre_counts(_user_movies(Views(spark, sf_dir)))


@query
def top3_genres(spark, sf_dir):
    return _movie_top_genres(Views(spark, sf_dir)).select("genre", "counts", "rank")


@query
def genre_ids(spark, sf_dir):
    v = Views(spark, sf_dir)
    return cat.genre_ids(_movie_top_genres(v), v.genre_lookup, known_max=params.TOP_GENRES)


@query
def titles_by_genre_movie(spark, sf_dir):
    v = Views(spark, sf_dir)
    ids = cat.genre_ids(_movie_top_genres(v), v.genre_lookup, known_max=params.TOP_GENRES)
    return cat.titles_by_genres(ids, v.genre_lookup, v.genres, v.catalogue, "Movie",
                                known_max=params.TOP_GENRES)


def _movie_hits(v: Views) -> DataFrame:
    return rec.genre_hits(_movie_top_genres(v), v.genre_lookup, v.genres, v.catalogue, "Movie")


@query
def genre_hit_counts(spark, sf_dir):
    return _movie_hits(Views(spark, sf_dir))


@query
def top3_titles(spark, sf_dir):
    return rec.top_titles(_movie_hits(Views(spark, sf_dir))).select("title", "hits", "rank")


@query
def recommend_details(spark, sf_dir):
    v = Views(spark, sf_dir)
    top = materialize(rec.top_titles(_movie_hits(v)))
    details = rec.resolve_titles(top.select("title"), v.catalogue, v.english, v.genres,
                                 catalogue_titles=True, known_max=params.TOP_TITLES)
    return top.join(details, "title", "left").select(
        "rank", "title", "item_id", "english_title", "status",
        F.array_join("genres", params.GENRE_SEPARATOR).alias("genres"))


@query
def recommend_movies(spark, sf_dir):
    v = Views(spark, sf_dir)
    return rec.recommend_movies(_media(v, USER_ID), v.catalogue, v.english, v.genres, v.genre_lookup, USER_ID)


# ---- FP-Growth over genre baskets (E1-E4) and the series chain (D6, J7, P4) -----------------

def _item_baskets(v: Views) -> DataFrame:
    """Every catalogue item's genres as a basket; items without genres get a null basket.

    Materialised once: FP-Growth reads its input several times and the
    prediction reads it again.
    """
    genres = cat.item_genres(v.genres)
    return materialize(v.catalogue.select("item_id").join(genres, "item_id", "left").select(
        "item_id", F.col("genres").alias("basket")))


def _item_model(v: Views, baskets: DataFrame | None = None):
    return rules.fit_rules(baskets if baskets is not None else _item_baskets(v))


def _set_text(col: str):
    return F.coalesce(F.array_join(F.sort_array(F.col(col)), params.GENRE_SEPARATOR), F.lit(""))


@query
def freq_itemsets(spark, sf_dir):
    items = rules.freq_itemsets(_item_model(Views(spark, sf_dir)))
    return items.select(_set_text("items").alias("items"), "freq")


@query
def association_rules(spark, sf_dir):
    r = rules.association_rules(_item_model(Views(spark, sf_dir)))
    return r.select(_set_text("antecedent").alias("antecedent"), "consequent",
                    F.round("confidence", 9).alias("confidence"), F.round("lift", 9).alias("lift"),
                    F.round("support", 9).alias("support"))


@query
def rule_predictions(spark, sf_dir):
    v = Views(spark, sf_dir)
    baskets = _item_baskets(v)
    predicted = rules.predict(_item_model(v, baskets), baskets)
    return predicted.select("item_id", _set_text("basket").alias("basket"),
                            _set_text("prediction").alias("prediction"))


@query
def predicted_genres(spark, sf_dir):
    v = Views(spark, sf_dir)
    baskets = _item_baskets(v)
    return rules.predicted_genres(rules.predict(_item_model(v, baskets), baskets), ["item_id"])


def _user_series_baskets(v: Views) -> DataFrame:
    titles = rec.user_titles(_media(v, USER_ID), USER_ID, params.KIND_SERIES)
    resolved = rec.resolve_titles(titles, v.catalogue, v.english, v.genres)
    return rec.series_baskets(rec.series_history(resolved))


def _series_top_genres(v: Views) -> DataFrame:
    return rec.top_genres(rec.predicted_genre_counts(_user_series_baskets(v)))


@query
def dedup_titles_user(spark, sf_dir):
    return _user_series_baskets(Views(spark, sf_dir)).select("Title", "Genres")


@query
def predicted_genre_counts(spark, sf_dir):
    return rec.predicted_genre_counts(_user_series_baskets(Views(spark, sf_dir)))


@query
def titles_by_genre_series(spark, sf_dir):
    v = Views(spark, sf_dir)
    ids = cat.genre_ids(_series_top_genres(v), v.genre_lookup, known_max=params.TOP_GENRES)
    return cat.titles_by_genres(ids, v.genre_lookup, v.genres, v.catalogue, "Series",
                                known_max=params.TOP_GENRES)


@query
def recommend_series(spark, sf_dir):
    v = Views(spark, sf_dir)
    return rec.recommend_series(_media(v, USER_ID), v.catalogue, v.english, v.genres, v.genre_lookup, USER_ID)


# ---- recommendations for all users (P3, P4) ---------------------------------------------------

@query
def recommend_movies_all_users(spark, sf_dir):
    v = Views(spark, sf_dir)
    return rec_all.recommend_movies_all(_media(v), v.catalogue, v.english, v.genres, v.genre_lookup)


@query
def recommend_series_all_users(spark, sf_dir):
    v = Views(spark, sf_dir)
    return rec_all.recommend_series_all(_media(v), v.catalogue, v.english, v.genres, v.genre_lookup)


# ---- sources and sinks (A1-A8, B1-B4, B15, D3, D7, G1-G3, H14-H16) ----------------------------

def _schema(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def _scratch(spark, name: str) -> str:
    return scratch_path(spark, name)


def _written_log(spark, v: Views) -> str:
    """The whole playback log written as envelope files (one pull); returns their folder."""
    root = _scratch(spark, "envelopes")
    return envelope.write_envelopes(envelope.pack_envelopes(v.log).drop("pull", "page"), root, 1)


@query
def pack_envelope(spark, sf_dir):
    v = Views(spark, sf_dir)
    root = _scratch(spark, "pulls")
    envelope.write_pulls(envelope.assign_pulls(v.log), root)
    docs = envelope.read_envelopes(spark, f"{root}/{envelope.FILE_PREFIX}_*").select(
        F.input_file_name().alias("file"), "TotalRecordCount", F.size("Items").alias("n"))
    return envelope.file_numbers(docs).groupBy("file_no").agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum("n").cast("bigint").alias("items"),
        F.sum("TotalRecordCount").cast("bigint").alias("total_record_count"))


@query
def flatten_log(spark, sf_dir):
    v = Views(spark, sf_dir)
    env = envelope.read_envelopes(spark, _written_log(spark, v))
    return ev.flatten_log(env).select("id", ts_text(), "user_id", "type", "name")


@query
def item_names(spark, sf_dir):
    v = Views(spark, sf_dir)
    return ev.item_names(envelope.read_envelopes(spark, _written_log(spark, v)))


@query
def provider_id(spark, sf_dir):
    """Catalogue items as JSON documents, parsed back; the provider id read from the map."""
    from playlens.functions.text import provider_id as pid
    v = Views(spark, sf_dir)
    ids = F.when(F.col("tmdb_id").isNotNull(), F.create_map(F.lit("Tmdb"), F.col("tmdb_id"))) \
        .otherwise(F.create_map().cast("map<string,string>"))
    docs = v.catalogue.select(F.to_json(F.struct(
        F.col("item_id").alias("Id"), F.col("title").alias("Name"), F.col("type").alias("Type"),
        ids.alias("ProviderIds"))).alias("json"))
    parsed = docs.select(F.from_json("json", CATALOGUE_ITEM).alias("item")).select("item.*")
    return parsed.select(F.col("Id").alias("item_id"), pid("ProviderIds").alias("tmdb"))


def _split_day(v: Views):
    """Media events before / from ``HISTORY_SPLIT``: stored history and new batch."""
    media = _media(v)
    cut = ntz_literal(HISTORY_SPLIT)
    return media.filter(F.col("date") < cut), media.filter(F.col("date") >= cut)


@query
def union_history(spark, sf_dir):
    v = Views(spark, sf_dir)
    old, new = _split_day(v)
    history = old.select("date", "media_name")          # the state keeps two columns
    merged = agg.union_history(history, new)
    return ev.in_time_range(merged, AS_OF_MONTH, "month").select(ts_text(), "media_name")


def _half_titles(v: Views, half: DataFrame, kind: str) -> DataFrame:
    titles = ev.with_kind(half).filter(F.col("kind") == kind).select("title").distinct()
    return rec.resolve_titles(titles, v.catalogue, v.english, v.genres)


@query
def dedup_titles(spark, sf_dir):
    v = Views(spark, sf_dir)
    old, new = _split_day(v)
    path = _scratch(spark, "series_genres")
    first = rec.series_history(_half_titles(v, old, params.KIND_SERIES))
    csvio.write_csv(first, path)
    history = csvio.read_or_empty(spark, path, TITLE_GENRES)
    return rec.series_history(_half_titles(v, new, params.KIND_SERIES), history)


@query
def merge_genre_counts(spark, sf_dir):
    v = Views(spark, sf_dir)
    old, new = _split_day(v)
    counts = [rec.genre_counts(rec.usable(_half_titles(v, h, params.KIND_MOVIE))) for h in (old, new)]
    return agg.merge_counts(counts[0], counts[1])


@query
def history_or_empty(spark, sf_dir):
    v = Views(spark, sf_dir)
    old, _ = _split_day(v)
    path = _scratch(spark, "series_genres")
    csvio.write_csv(rec.series_history(_half_titles(v, old, params.KIND_SERIES)), path)
    present = csvio.read_or_empty(spark, path, TITLE_GENRES)
    absent = csvio.read_or_empty(spark, _scratch(spark, "never_written"), TITLE_GENRES)
    return present.unionByName(absent)


@query
def csv_roundtrip(spark, sf_dir):
    v = Views(spark, sf_dir)
    path = _scratch(spark, "stats_csv")
    csvio.write_csv(_month_stats(v), path)
    return csvio.read_csv(spark, path, STATS_CSV)


@query
def denylist_scan(spark, sf_dir):
    v = Views(spark, sf_dir)
    path = _scratch(spark, "channels")
    csvio.write_csv(v.deny.select(F.col("pattern").alias("Channel Name")), path)
    deny = csvio.read_denylist(spark, path)
    playback = ev.filter_event_type(v.log)
    return ev.denylist_hits(playback, deny).groupBy("pattern").agg(F.count(F.lit(1)).alias("hits"))


@query
def title_cache_append(spark, sf_dir):
    v = Views(spark, sf_dir)
    path = _scratch(spark, "english_titles")
    csvio.write_csv(v.english, path)
    cache = csvio.read_csv(spark, path, ENGLISH_TITLES)
    searched = cat.english_titles(_searched(v), cache)
    # A miss would be resolved remotely; the catalogue title stands in for that answer.
    misses = searched.filter(F.col("status") == cat.STATUS_UNRESOLVED).select(
        "tmdb_id", F.col("item_title").alias("title"))
    csvio.append_new(cache, misses, "tmdb_id", path)
    return csvio.read_csv(spark, path, ENGLISH_TITLES)


@query
def title_cache_append_typed(spark, sf_dir):
    """Answers to misses, by item type and id, appended in three batches of which the second runs twice."""
    v = Views(spark, sf_dir)
    path = _scratch(spark, "typed_titles")
    schema = _schema("item_type string, tmdb_id string, title string")
    items = v.catalogue.select(F.col("type").alias("item_type"), (F.col("item_id") % 500).cast("string").alias("tmdb_id"), "title", "item_id")
    for batch in (0, 1, 1, 2):
        csvio.append_once(items.filter(F.col("item_id") % 3 <= batch).select(*schema.names), ["item_type", "tmdb_id"], path, batch, schema)
    return csvio.read_appended(spark, path, schema).select(*schema.names, F.col("batch_id").cast("int").alias("batch"))


# ---- streaming (J1-J8, P5) ------------------------------------------------------------------------

def _stream_setup(spark, sf_dir):
    v = Views(spark, sf_dir)
    root = _scratch(spark, "stream")
    return v, root, f"{root}/checkpoint"


@query
def stream_flatten(spark, sf_dir):
    v, root, ckpt = _stream_setup(spark, sf_dir)
    sink = f"{root}/media"
    replay_pulls(v.log, root, lambda src: jobs.run_available(
        jobs.media_stream(spark, src, v.deny).select("id", "user_id", "media_name"), ckpt, sink=sink))
    return spark.read.parquet(sink)


@query
def stream_dedup(spark, sf_dir):
    return _deduplicated(spark, sf_dir)


def _deduplicated(spark, sf_dir, **how) -> DataFrame:
    v, root, ckpt = _stream_setup(spark, sf_dir)
    replay_pulls(v.log, root, lambda src: jobs.run_available(
        jobs.media_stream(spark, src, v.deny), ckpt, process=jobs.DedupJob(root)), **how)
    return state.read_history(spark, root).select("id", "user_id", "media_name")


@query
def stream_dedup_out_of_order(spark, sf_dir):
    """The same pulls landed newest first."""
    return _deduplicated(spark, sf_dir, newest_first=True)


@query
def stream_flatten_multiline(spark, sf_dir):
    """Files of one pretty-printed document each."""
    v, root, ckpt = _stream_setup(spark, sf_dir)
    sink = f"{root}/media"
    replay_pulls(v.log, root, lambda src: jobs.run_available(
        jobs.media_stream(spark, src, v.deny, multi_line=True).select("id", "user_id", "media_name"), ckpt, sink=sink),
        multi_line=True)
    return spark.read.parquet(sink)


@query
def stream_rolling_stats(spark, sf_dir):
    v, root, ckpt = _stream_setup(spark, sf_dir)
    # Dedup inside the batch job: exact and even under a hot id (see dedup_against_history).
    job = jobs.RollingStatsJob(root, AS_OF_MONTH, dedup=True)
    replay_pulls(v.log, root, lambda src: jobs.run_available(
        jobs.media_stream(spark, src, v.deny), ckpt, process=job))
    return latest_version(spark, root, "stats")


def _genre_state(spark, sf_dir, totals: bool = False) -> str:
    v, root, ckpt = _stream_setup(spark, sf_dir)
    job = jobs.GenreStateJob(root, v.catalogue, v.english, v.genres, dedup=True)

    def run(src: str) -> None:
        jobs.run_available(jobs.media_stream(spark, src, v.deny), ckpt, process=job)
        if totals:
            jobs.run_genre_totals(spark, root)

    replay_pulls(v.log, root, run)
    return root


@query
def stream_genre_counts(spark, sf_dir):
    """Running counts in Spark's state store; every pull is a restart of both streams."""
    return jobs.genre_totals(spark, _genre_state(spark, sf_dir, totals=True))


@query
def stream_title_genres(spark, sf_dir):
    return state.read_first_wins(spark, _genre_state(spark, sf_dir), "title_genres", TITLE_GENRES).drop("bucket")


@query
def stream_daily_views(spark, sf_dir):
    v, root, ckpt = _stream_setup(spark, sf_dir)
    def store(batch: DataFrame, batch_id: int) -> None:
        jobs.store_batch(jobs.dedup_against_history(batch, root, batch_id), root, batch_id)

    replay_pulls(v.log, root, lambda src: jobs.run_available(
        jobs.media_stream(spark, src, v.deny), ckpt, process=store))
    return state.daily_counts(spark, root).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query
def stream_daily_views_watermarked(spark, sf_dir):
    """Days closed by the watermark; the third pull lands last, and its old events are late."""
    v, root, ckpt = _stream_setup(spark, sf_dir)
    sink = f"{root}/daily"
    replay_pulls(v.log, root, lambda src: jobs.run_available(
        jobs.daily_views(jobs.media_stream(spark, src, v.deny)), ckpt, sink=sink, no_data_batches=True, rocksdb=True),
        order=[1, 2, 4, 3])
    return spark.read.schema("day string, kind string, title string, views bigint").parquet(sink)


def spoiled_documents(env: DataFrame, source: str, pull: int) -> None:
    """Beside a pull's envelopes: every third page cut off in the middle, and every fifth with unreadable dates."""
    text = F.to_json(F.struct("Items", "TotalRecordCount"))
    cut = env.filter(F.col("page") % 3 == 0).select(F.substring(text, 1, 60).alias("value"))
    dated = env.filter(F.col("page") % 5 == 0).withColumn("Items", F.transform("Items", lambda i: i.withField("Date", F.concat(F.lit("on "), i["Date"]))))
    cut.unionByName(dated.select(text.alias("value"))).write.mode("append").text(f"{source}/{envelope.file_name(pull)}")


@query
def stream_reject_counts(spark, sf_dir):
    """Cut documents and unreadable dates, counted per batch."""
    v, root, ckpt = _stream_setup(spark, sf_dir)
    job = jobs.DeadLetterJob(root, v.deny, jobs.DedupJob(root))
    replay_pulls(v.log, root, lambda src: jobs.run_available(
        jobs.observed_envelopes(spark, src), ckpt, process=job), after_write=spoiled_documents)
    return jobs.reject_counts(spark, root)


@query
def stream_rolling_window(spark, sf_dir):
    """The statistics of every batch, each over the week that ends with the newest event seen by then."""
    v, root, ckpt = _stream_setup(spark, sf_dir)
    job = jobs.RollingStatsJob(root, None, "week", dedup=True, retain=40)
    replay_pulls(v.log, root, lambda src: jobs.run_available(
        jobs.media_stream(spark, src, v.deny), ckpt, process=job))
    return spark.read.parquet(f"{root}/stats").select(F.col("v").cast("int").alias("batch"), "kind", "title", "views", "rank")


def _driver_state(spark, sf_dir, **how) -> str:
    v, root, ckpt = _stream_setup(spark, sf_dir)
    job = jobs.PlaybackBatchJob(root, AS_OF_MONTH, v.catalogue, v.english, v.genres, v.genre_lookup, USER_ID)
    replay_pulls(v.log, root, lambda src: jobs.run_available(
        jobs.media_stream(spark, src, v.deny), ckpt, process=job), **how)
    return root


@query
def stream_statistics(spark, sf_dir):
    return latest_version(spark, _driver_state(spark, sf_dir), "stats")


@query
def stream_statistics_backlog(spark, sf_dir):
    """All overlapping pulls in one trigger, as after a restart."""
    return latest_version(spark, _driver_state(spark, sf_dir, at_once=True), "stats")


@query
def stream_chart_table(spark, sf_dir):
    return latest_version(spark, _driver_state(spark, sf_dir), "chart")


@query
def stream_movie_recommendations(spark, sf_dir):
    return latest_version(spark, _driver_state(spark, sf_dir), "movie_recommendations")


@query
def stream_series_recommendations(spark, sf_dir):
    return latest_version(spark, _driver_state(spark, sf_dir), "series_recommendations")


# ---- cases that the other inputs do not reach -----------------------------------------------

@query
def file_number_padding(spark, sf_dir):
    """Padded file numbers of pulls past 99."""
    from playlens.functions.text import padded_number
    v = Views(spark, sf_dir)
    numbers = v.log.select((F.col("id") % 1300).alias("pull")).distinct()
    return numbers.select("pull", padded_number("pull").alias("file_no"))


@query
def filter_denylist_regex(spark, sf_dir):
    v = Views(spark, sf_dir)
    return ev.filter_denylist(ev.filter_event_type(v.log), v.deny, mode="regex",
                              known_max=len(tb.DENYLIST_PATTERNS)).select("id", "user_id", "name")


@query
def filter_denylist_parts(spark, sf_dir):
    """A deny-list of one entry per part, beyond a nested loop from sf0.01 on."""
    v = Views(spark, sf_dir)
    even = F.col("p_partkey") - F.col("p_partkey") % 2
    deny = v.t.part.select(F.concat("p_name", F.lit(" "), even.cast("string"), F.lit(" ")).alias("pattern"))
    return ev.filter_denylist(ev.filter_event_type(v.log), deny).select("id", "user_id", "name")


@query
def time_range_mid_data(spark, sf_dir):
    """A week that ends inside the data."""
    return _time_range(spark, sf_dir, AS_OF_PULL, "week")


@query
def english_title_by_type(spark, sf_dir):
    """Movies and series with colliding ids, and several cache entries per id: the first wins."""
    v = Views(spark, sf_dir)
    items = v.catalogue.select("item_id", F.col("type").alias("item_type"), F.col("title").alias("item_title"),
                               (F.col("item_id") % 500).cast("string").alias("tmdb_id"))
    cache = items.filter(F.col("item_id") % 5 != 0).select(
        "item_type", "tmdb_id", F.concat(F.lit("EN "), "item_type", F.lit(" "), "item_title").alias("title"),
        F.col("item_id").alias("seq"))
    return cat.english_titles(items, cache).select("item_id", "item_type", "tmdb_id", "english_title", "status")


@query
def search_contains(spark, sf_dir):
    """Terms that are no titles: parts of every part name, one letter, and the empty term."""
    v = Views(spark, sf_dir)
    names = v.t.part.select(F.lower("p_name").alias("n"))
    terms = (names.select(F.substring("n", 2, 7).alias("title")).unionByName(names.select(F.substring("n", 1, 1).alias("title")))
             .unionByName(names.select(F.lit("").alias("title")).limit(1)).distinct())
    found = cat.search_catalogue(terms, v.catalogue)
    return found.select("title", "item_id", "item_type", "item_title", "tmdb_id")
