"""Streaming jobs over envelope files.

The stream is the envelope directory; each job is ``readStream`` ->
stateless chain (flatten, type filter, deny-list, title) -> an optional
stateful step -> ``writeStream`` with a checkpoint.  ``foreachBatch`` jobs
keep their state in the tables of :mod:`playlens.streaming.state`, keyed by
batch id, so a replayed micro-batch rewrites instead of double counting.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens import params
from playlens.functions.time import instant, ntz_literal, range_start
from playlens.operators import aggregates as agg
from playlens.operators import events as ev
from playlens.operators.barrier import materialize
from playlens.plans import recommend as rec
from playlens.plans import statistics as st
from playlens.operators.ranking import ordered_position
from playlens.schemas import TITLE_GENRES
from playlens.sources.envelope import CORRUPT, stream_envelopes
from playlens.streaming import state

DEDUP_DELAY = "3 days"      # longer than the pull overlap (2 days)
COUNTS_SCHEMA = "genre string, counts bigint"
MARK_SCHEMA = "mark bigint"
VERSIONED = ("mark", "stats", "chart", "genre_counts", "movie_recommendations", "series_recommendations")
STATS_SCHEMA = "kind string, title string, views bigint, rank int"
CHART_SCHEMA = "panel string, panel_title string, position int, label string, views bigint"
TITLE_BUCKETS = 8
RESOLVED_SCHEMA = ("title string, item_id bigint, item_type string, item_title string, tmdb_id string, english_title string, "
                   "status string, genres array<string>")
RECS_SCHEMA = "rank int, title string, genres string, hits bigint"


def media_stream(spark: SparkSession, source: str, deny: DataFrame,
                 max_files_per_trigger: int | None = None, multi_line: bool = False,
                 clean_source: str | None = None, archive_dir: str | None = None) -> DataFrame:
    """Envelope files -> media events ``id, date, user_id, type, name, media_name``.

    ``multi_line`` reads files that hold one document over many lines;
    ``clean_source`` (``archive`` with ``archive_dir``, or ``delete``) clears
    files that a committed batch has read.
    """
    env = stream_envelopes(spark, source, multi_line=multi_line, max_files_per_trigger=max_files_per_trigger,
                           clean_source=clean_source, archive_dir=archive_dir)
    return ev.media_events(ev.flatten_log(env), deny)


def with_event_time(df: DataFrame) -> DataFrame:
    """``event_time``: the instant whose UTC wall clock is ``date`` (watermarks need a ``timestamp``)."""
    return df.withColumn("event_time", instant("date"))


def dedup_stream(media: DataFrame, delay: str = DEDUP_DELAY) -> DataFrame:
    """J4 with Spark's own state: drop repeated ids, state bounded by a watermark.

    Right for pulls in event-time order only: events older than the watermark
    (newest event time minus ``delay``) are late and dropped (J8).  The jobs
    below use :func:`dedup_against_history`, which keeps every id once in any
    order of pulls.
    """
    return with_event_time(media).withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["id"])


STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
NO_DATA_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


def dedup_against_history(batch: DataFrame, root: str, batch_id: int | None = None) -> DataFrame:
    """Exact micro-batch dedup: every id once, in whatever order or grouping the pulls arrive.

    Inside the batch, ``dropDuplicates`` runs as an aggregate with a partial
    phase, so the copies of a hot id collapse in every task before the
    shuffle.  Ids already stored by earlier batches are removed with an
    anti join against the history.  A repeat is the same event, so only the
    days the batch itself spans are read (partition-pruned); undated events
    are looked up among undated ones.  Rows without an id cannot be repeats
    and all stay.  ``batch_id`` leaves out what a failed run of the same batch
    has already stored, so a replay gives the same rows.
    """
    spark = batch.sparkSession
    named = batch.filter(F.col("id").isNotNull()).dropDuplicates(["id"])
    span = batch.agg(F.min(F.to_date("date")), F.max(F.to_date("date"))).first()     # two scalars
    seen = state.read_history(spark, root)
    if batch_id is not None:
        seen = seen.filter(F.col("batch_id") < batch_id)
    days = F.col("day").isNull()
    if span[0] is not None:
        days = days | F.col("day").between(F.lit(span[0]), F.lit(span[1]))
    seen = seen.filter(days).select("id")
    return named.join(seen, "id", "left_anti").unionByName(batch.filter(F.col("id").isNull()))


@dataclass
class DedupJob:
    """foreachBatch: the batch's new media events, each id once, into the history."""

    root: str

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        state.append_history(history_rows(dedup_against_history(batch, self.root, batch_id)), self.root, batch_id)


def run_available(stream: DataFrame, checkpoint: str, process=None, sink: str | None = None,
                  output_mode: str = "append", sink_format: str = "parquet", no_data_batches: bool = False,
                  rocksdb: bool = False) -> list[dict]:
    """Process everything available now, then stop: ``foreachBatch(process)`` or a file sink.

    Batches without data (run only to move the watermark) are switched off
    unless asked for: state eviction then happens with the next data batch, and the batch jobs
    never recompute their outputs for an empty input.  ``rocksdb`` keeps the
    operators' state in RocksDB instead of on the heap.  Returns each batch's
    progress (its last 100), with the metrics set by ``observe`` and the rows dropped as late.
    """
    spark = stream.sparkSession
    previous = spark.conf.get(NO_DATA_BATCHES, "true")
    provider = spark.conf.get(STATE_PROVIDER, None)
    spark.conf.set(NO_DATA_BATCHES, str(no_data_batches).lower())
    if rocksdb:
        spark.conf.set(STATE_PROVIDER, ROCKSDB)
    try:
        writer = stream.writeStream.option("checkpointLocation", checkpoint).outputMode(output_mode)
        if process is not None:
            writer = writer.foreachBatch(process)
        else:
            writer = writer.format(sink_format).option("path", sink)
        query = writer.trigger(availableNow=True).start()
    finally:
        spark.conf.set(NO_DATA_BATCHES, previous)
        if rocksdb:
            spark.conf.unset(STATE_PROVIDER) if provider is None else spark.conf.set(STATE_PROVIDER, provider)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return [json.loads(p.json) for p in query.recentProgress]


def late_rows(progress: list[dict]) -> int:
    """Rows that arrived behind the watermark of their batch, as counted by the first stateful operator."""
    return sum(p["stateOperators"][-1]["numRowsDroppedByWatermark"] for p in progress if p.get("stateOperators"))


# ---- J3/J5: rolling statistics ------------------------------------------------------------------

def history_rows(media: DataFrame) -> DataFrame:
    return media.select("id", F.col("date").alias("ts"), "user_id", "media_name")


def rolling_statistics(spark: SparkSession, root: str, as_of, time_range: str = "month") -> DataFrame:
    """View statistics over the stored state in the range ending at ``as_of``.

    Whole days come from the daily partial counts, the two boundary days from
    raw history rows; nothing outside the range is read.
    """
    end = as_of if isinstance(as_of, Column) else ntz_literal(as_of)
    counts = state.range_counts(spark, root, range_start(as_of, time_range), end, ev.with_kind)
    return ordered_position(counts, ["kind"], [F.col("views").desc(), F.col("title").asc()])


def store_batch(media: DataFrame, root: str, batch_id: int) -> None:
    """History rows and daily partial counts of one micro-batch (both replay-safe).

    The counts are computed from the batch's own history partitions, read
    back with ``batch_id`` pruning, so the micro-batch is computed once.
    """
    state.append_history(history_rows(media), root, batch_id)
    written = state.read_history(media.sparkSession, root).filter(F.col("batch_id") == batch_id)
    state.append_daily_counts(ev.with_kind(written), root, batch_id)


def batch_as_of(as_of, spark: SparkSession, root: str):
    """The moment a batch's range ends: ``as_of`` itself, its value if it is a
    function, or (None) the newest event stored so far, so the range moves on."""
    if callable(as_of):
        return as_of()
    if as_of is not None:
        return as_of
    return state.newest_event(spark, root)


def retained_from(spark: SparkSession, as_of, time_range: str, retain: int):
    """The first day kept: the start of the range that ends at ``as_of``, less ``retain`` days."""
    return spark.range(1).select(F.date_sub(F.to_date(range_start(as_of, time_range)), retain)).first()[0]


@dataclass
class RollingStatsJob:
    """foreachBatch: append the batch to history, recompute and store the statistics.

    ``dedup=True`` removes repeated ids inside the job (skew-safe, exact).
    ``as_of`` is taken anew in every batch (see :func:`batch_as_of`).
    ``retain`` drops stored days before the range start less so many days.
    """

    root: str
    as_of: object = None
    time_range: str = "month"
    dedup: bool = False
    retain: int | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            if batch.isEmpty():
                return              # readers take the newest stats version there is
            fresh = dedup_against_history(batch, self.root, batch_id) if self.dedup else batch
            store_batch(fresh, self.root, batch_id)
        finally:
            batch.unpersist()
        as_of = batch_as_of(self.as_of, spark, self.root)
        stats = rolling_statistics(spark, self.root, as_of, self.time_range)
        state.write_version(stats, self.root, "stats", batch_id)
        if self.retain is not None:
            state.drop_days_before(spark, self.root, retained_from(spark, as_of, self.time_range, self.retain))


# ---- J6/J7: cumulative genre counts and first-wins title genres ---------------------------------

GENRE_VOTES = "genre_votes"


def run_genre_totals(spark: SparkSession, root: str) -> None:
    """The votes of all batches summed per genre in Spark's own state (RocksDB), update mode.

    The stream reads each batch's votes file once; its checkpoint carries the
    state over restarts, and :func:`genre_totals` reads it back.
    """
    votes = spark.readStream.schema(COUNTS_SCHEMA).parquet(f"{state.votes_path(root, GENRE_VOTES)}/*")
    run_available(votes.groupBy("genre").agg(F.sum("counts").alias("counts")), totals_checkpoint(root),
                  output_mode="update", sink_format="noop", rocksdb=True)


def totals_checkpoint(root: str) -> str:
    return f"{root.rstrip('/')}/genre_totals"


def genre_totals(spark: SparkSession, root: str) -> DataFrame:
    """``genre, counts`` as the state store holds them now."""
    stored = spark.read.format("statestore").load(totals_checkpoint(root))
    value = stored.schema["value"].dataType.names[0]
    return stored.select(F.col("key.genre").alias("genre"), F.col("value").getField(value).alias("counts"))


@dataclass
class GenreStateJob:
    """foreachBatch: per batch, genre votes of its movies for the running counts
    and series title -> genres upserted first-wins (J7)."""

    root: str
    catalogue: DataFrame
    cache: DataFrame
    genre_links: DataFrame
    user_id: str | None = None
    dedup: bool = False

    _static_ready: bool = False

    def _static(self) -> None:
        """The catalogue side is static: derive it once, not in every micro-batch."""
        if not self._static_ready:
            self.catalogue = materialize(self.catalogue)
            self.genre_links = materialize(self.genre_links)
            self._static_ready = True

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        self._static()
        if self.dedup:
            DedupJob(self.root)(batch, batch_id)
            batch = state.read_history(spark, self.root).filter(F.col("batch_id") == batch_id)
        rows = batch if self.user_id is None else ev.user_history(batch, self.user_id)
        # one catalogue search for the titles of both kinds
        titled = materialize(ev.with_kind(rows).select("kind", "title").distinct())
        resolved = materialize(rec.resolve_titles(titled.select("title"), self.catalogue, self.cache, self.genre_links).join(titled, "title"))
        movies = rec.usable(resolved.filter(F.col("kind") == params.KIND_MOVIE))
        state.write_votes(rec.genre_counts(movies), self.root, GENRE_VOTES, batch_id)
        series = resolved.filter(F.col("kind") == params.KIND_SERIES)
        state.append_first_wins(rec.series_history(series), self.root, "title_genres", "Title", batch_id)


def _schema(ddl: str):
    from pyspark.sql.types import StructType
    return StructType.fromDDL(ddl)


# ---- P5: the micro-batch driver -----------------------------------------------------------------

@dataclass
class PlaybackBatchJob:
    """The whole per-batch pipeline (P5): new events, statistics with English titles
    and chart, recommendations.

    New events are those whose id the history does not hold
    (:func:`dedup_against_history`), so pulls may overlap, arrive late or
    share a trigger.  ``by_mark=True`` filters by the high-water mark instead.
    The mark is state (version ``n-1`` read, ``n`` written): the maximum id,
    never the first row, and an empty batch keeps the old one.

    ``retain`` drops stored days before the range start less so many days;
    ``close_after`` rewrites days as one file set each when they are so many
    days older than the newest event (:func:`state.compact_days`).

    The catalogue is static while the job runs, so a title is searched once: new
    titles of a batch are resolved and kept in a first-wins table of the job,
    and batches without new titles search nothing.  A restarted job resolves anew.
    """

    root: str
    as_of: object
    catalogue: DataFrame
    cache: DataFrame
    genre_links: DataFrame
    lookup: DataFrame
    user_id: str = params.DEFAULT_USER
    time_range: str = "month"
    by_mark: bool = False
    keep_versions: int = 3
    retain: int | None = None
    close_after: int | None = None
    _static_ready: bool = False
    _titles: str = field(default_factory=lambda: f"resolved_titles/{uuid.uuid4().hex[:12]}")

    def _static(self) -> None:
        """Catalogue, genre links and lookup are static: derive them once per job."""
        if not self._static_ready:
            self.catalogue = materialize(self.catalogue)
            self.genre_links = materialize(self.genre_links)
            self.lookup = materialize(self.lookup)
            self.cache = materialize(self.cache)
            self._static_ready = True

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        self._static()
        old_mark = state.read_version(spark, self.root, "mark", batch_id - 1, _schema(MARK_SCHEMA))
        batch = batch.persist()     # its span and its rows are read: the files are parsed once
        try:
            # A checkpoint, not a cache: Spark drops a cached plan that reads the history once the history is written.
            fresh = materialize(ev.high_water_filter(batch, old_mark) if self.by_mark
                                else dedup_against_history(batch, self.root, batch_id))
        finally:
            batch.unpersist()
        try:
            new_mark = fresh.agg(F.max("id").alias("_m")).select(
                F.greatest(F.col("_m"), old_mark.select(F.max("mark")).scalar()).alias("mark"))
            state.write_version(new_mark, self.root, "mark", batch_id)
            if fresh.isEmpty():
                self._carry(spark, batch_id)
                return
            # statistics (P1 over the rolling history)
            store_batch(fresh, self.root, batch_id)
            as_of = batch_as_of(self.as_of, spark, self.root)
            state.write_version(rolling_statistics(spark, self.root, as_of, self.time_range), self.root, "stats", batch_id)
            stats = state.read_version(spark, self.root, "stats", batch_id, _schema(STATS_SCHEMA))
            self._tidy(spark, as_of, batch_id)
            # English titles and the chart of the same statistics
            titled = ev.with_kind(ev.user_history(fresh, self.user_id)).select("kind", "title").distinct()
            known = self._resolved(spark, stats.select("title").unionByName(titled.select("title")), batch_id)
            english = st.view_statistics_english(stats, self.catalogue, self.cache, known)
            labels = english.select("kind", "title", F.col("english_title").alias("label"))
            state.write_version(st.chart_table(english, labels), self.root, "chart", batch_id)
            # movie recommendations with running genre counts
            resolved = materialize(known.join(titled, "title"))
            movies = rec.usable(resolved.filter(F.col("kind") == params.KIND_MOVIE))
            if movies.isEmpty():
                # no new movie of the user: counts and recommendations stay as they were
                self._copy(spark, "genre_counts", COUNTS_SCHEMA, batch_id)
                self._copy(spark, "movie_recommendations", RECS_SCHEMA, batch_id)
            else:
                old_counts = state.read_version(spark, self.root, "genre_counts", batch_id - 1,
                                                _schema(COUNTS_SCHEMA))
                counts = agg.merge_counts(old_counts, rec.genre_counts(movies))
                state.write_version(counts, self.root, "genre_counts", batch_id)
                counts = state.read_version(spark, self.root, "genre_counts", batch_id,
                                            _schema(COUNTS_SCHEMA))
                top = rec.top_genres(counts)
                hits = rec.genre_hits(top, self.lookup, self.genre_links, self.catalogue, "Movie")
                movie_rec = rec.recommend_details(rec.top_titles(hits), self.catalogue, self.cache,
                                                  self.genre_links)
                state.write_version(movie_rec, self.root, "movie_recommendations", batch_id)
            # series recommendations from the first-wins title history
            series = resolved.filter(F.col("kind") == params.KIND_SERIES)
            if rec.usable(series).isEmpty():
                # no new series title: the history, its rules and the picks are unchanged
                self._copy(spark, "series_recommendations", RECS_SCHEMA, batch_id)
                return
            state.append_first_wins(rec.series_history(series), self.root, "title_genres", "Title", batch_id)
            titles = state.read_first_wins(spark, self.root, "title_genres", TITLE_GENRES, before=batch_id + 1)
            baskets = rec.series_baskets(titles)
            if baskets.filter(F.col("basket").isNotNull()).isEmpty():
                series_rec = spark.createDataFrame([], RECS_SCHEMA)
            else:
                top_s = rec.top_genres(rec.predicted_genre_counts(baskets))
                hits_s = rec.genre_hits(top_s, self.lookup, self.genre_links, self.catalogue, "Series")
                series_rec = rec.recommend_details(rec.top_titles(hits_s), self.catalogue, self.cache,
                                                   self.genre_links)
            state.write_version(series_rec, self.root, "series_recommendations", batch_id)
        finally:
            for name in VERSIONED:
                state.drop_old_versions(spark, self.root, name, self.keep_versions)

    def _resolved(self, spark: SparkSession, titles: DataFrame, batch_id: int) -> DataFrame:
        """The resolved rows of every title searched so far, those of ``titles`` among them."""
        schema = _schema(RESOLVED_SCHEMA)
        held = state.read_first_wins(spark, self.root, self._titles, schema, before=batch_id)
        new = materialize(titles.filter(F.col("title").isNotNull()).distinct().join(held.select("title"), "title", "left_anti"))
        if not new.isEmpty():
            rows = rec.resolve_titles(new, self.catalogue, self.cache, self.genre_links)
            state.append_first_wins(rows.select(*schema.names), self.root, self._titles, "title", batch_id, TITLE_BUCKETS)
        return state.read_first_wins(spark, self.root, self._titles, schema, before=batch_id + 1).drop("bucket")

    def _tidy(self, spark: SparkSession, as_of, batch_id: int) -> None:
        """Closed days become one file set each, days before the range go; batch ``batch_id`` itself stays open for a replay."""
        if self.close_after is not None and (newest := state.newest_event(spark, self.root)) is not None:
            state.compact_days(spark, self.root, (newest - dt.timedelta(days=self.close_after)).date(), batch_id - 1)
        if self.retain is not None:
            state.drop_days_before(spark, self.root, retained_from(spark, as_of, self.time_range, self.retain))

    def _copy(self, spark: SparkSession, name: str, schema: str, batch_id: int) -> None:
        """Version ``batch_id`` of ``name`` = version ``batch_id - 1`` (empty before the first)."""
        prev = state.read_version(spark, self.root, name, batch_id - 1, _schema(schema))
        state.write_version(prev, self.root, name, batch_id)

    def _carry(self, spark: SparkSession, batch_id: int) -> None:
        """An empty batch: every state table keeps its previous version."""
        for name, schema in (("stats", STATS_SCHEMA), ("chart", CHART_SCHEMA), ("genre_counts", COUNTS_SCHEMA),
                             ("movie_recommendations", RECS_SCHEMA), ("series_recommendations", RECS_SCHEMA)):
            self._copy(spark, name, schema, batch_id)


# ---- J8: daily views, watermarked tumbling window ---------------------------------------------

def daily_views(media: DataFrame, delay: str = DEDUP_DELAY) -> DataFrame:
    """Views per day and title, each id once: ``day, kind, title, views`` of days that have closed.

    Two stateful aggregates in one append-mode query.  The first keeps one row
    per id and day; as an aggregate it has a partial phase, so the copies of a
    hot id collapse in every task before they reach the state.  The second
    counts a day's ids.  A day is final, and its state gone, once the watermark
    (the newest event less ``delay``) has passed its end; events behind it are late.
    """
    titled = ev.with_kind(with_event_time(media).withWatermark("event_time", delay))
    ids = titled.groupBy(F.window("event_time", "1 day"), "id", "kind", "title").agg(F.count(F.lit(1)).alias("copies"))
    views = ids.groupBy("window", "kind", "title").agg(F.count(F.lit(1)).alias("views"))
    day = F.date_format(F.timestamp_add("MICROSECOND", F.unix_micros("window.start"), ntz_literal("1970-01-01 00:00:00")), "yyyy-MM-dd")
    return views.select(day.alias("day"), "kind", "title", "views")


# ---- dead letters: what the stream cannot read (A1, H15) ------------------------------------------

DEAD_LETTERS = "batch_id bigint, reason string, id bigint, payload string"
REASON_DOCUMENT, REASON_DATE = "document", "date"


def dead_letters(envelopes: DataFrame) -> DataFrame:
    """``reason, id, payload`` of documents that are no envelopes and items whose date does not parse.

    ``envelopes`` carries the corrupt-record column (``stream_envelopes(corrupt=True)``).
    """
    documents = envelopes.filter(F.col(CORRUPT).isNotNull()).select(
        F.lit(REASON_DOCUMENT).alias("reason"), F.lit(None).cast("bigint").alias("id"), F.col(CORRUPT).alias("payload"))
    dates = ev.rejected_rows(ev.flatten_log(envelopes, keep_raw_date=True)).select(
        F.lit(REASON_DATE).alias("reason"), "id", F.col("date_raw").alias("payload"))
    return documents.unionByName(dates)


def observed_envelopes(spark: SparkSession, source: str, name: str = "rejects", **options) -> DataFrame:
    """The envelope stream with its corrupt documents, counted in the stream by ``observe``.

    Each batch's progress holds, under ``name``: documents, corrupt documents,
    items and items with a malformed date.
    """
    env = stream_envelopes(spark, source, corrupt=True, **options)
    items = F.coalesce(F.size("Items"), F.lit(0))
    bad = F.coalesce(F.size(F.filter("Items", lambda i: i["Date"].isNotNull() & F.try_to_timestamp(i["Date"]).isNull())), F.lit(0))
    return env.observe(name, F.count(F.lit(1)).alias("documents"), F.count(CORRUPT).alias("corrupt_documents"),
                       F.sum(items).alias("items"), F.sum(bad).alias("malformed_dates"))


@dataclass
class DeadLetterJob:
    """foreachBatch over envelopes: rejected documents and items go to a table, the rest to ``then``.

    Each batch overwrites its own partition, so a replay stores them once.  ``then``
    gets the batch's cleaned media events.
    """

    root: str
    deny: DataFrame | None = None
    then: object = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            (dead_letters(batch).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(dead_letter_path(self.root)))
            if self.then is not None:
                self.then(ev.media_events(ev.flatten_log(batch), self.deny), batch_id)
        finally:
            batch.unpersist()


def dead_letter_path(root: str) -> str:
    return f"{root.rstrip('/')}/dead_letters"


def reject_counts(spark: SparkSession, root: str) -> DataFrame:
    """``batch, reason, rejects``: what each batch rejected."""
    rows = spark.read.schema(DEAD_LETTERS).parquet(dead_letter_path(root))
    return rows.groupBy(F.col("batch_id").cast("int").alias("batch"), "reason").agg(F.count(F.lit(1)).alias("rejects"))
