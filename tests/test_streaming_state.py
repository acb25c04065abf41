"""State of the streaming jobs: closed days, first-wins buckets, totals in the state store, late rows, dead letters."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from playlens.operators import events as ev
from playlens.plans import recommend as rec
from playlens.queries import Views, spoiled_documents
from playlens.schemas import TITLE_GENRES
from playlens.sources import csvio
from playlens.streaming import jobs, state
from playlens.streaming.runner import latest_version, replay_pulls


def _root():
    return tempfile.mkdtemp(prefix="run-")


def _media(spark, rows):
    df = spark.createDataFrame(rows, "id bigint, date string, user_id string, media_name string")
    return df.withColumn("date", F.col("date").cast("timestamp_ntz"))


def _files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def _views(spark, root, as_of="2024-01-31 00:00:00"):
    return sorted(tuple(r) for r in jobs.rolling_statistics(spark, root, as_of).collect())


def _batches(spark, root, n=6, days=4):
    for b in range(n):
        rows = [(b * 100 + i, f"2024-01-0{1 + i % days} 1{b}:00:00", "1", f"T{i % 5}") for i in range(20)]
        rows.append((None, "2024-01-01 09:00:00", "1", "N"))
        jobs.store_batch(_media(spark, rows), root, b)


# ---- closed days ----

def test_closed_days_hold_the_same_rows_in_few_files(spark, monkeypatch):
    monkeypatch.setattr(state, "CLOSED_FILES", 2)
    root = _root()
    _batches(spark, root)
    rows = sorted(map(str, state.read_history(spark, root).collect()))
    views, counts = _views(spark, root), sorted(map(str, state.daily_counts(spark, root).collect()))
    state.compact_days(spark, root, dt.date(2024, 1, 4), 4)
    assert sorted(map(str, state.read_history(spark, root).collect())) == rows
    assert _views(spark, root) == views and sorted(map(str, state.daily_counts(spark, root).collect())) == counts
    closed = _files(state.closed_path(state.history_path(root)))
    assert all(sum(f"day=2024-01-0{d}" in f for f in closed) <= 2 for d in (1, 2, 3)) and not any("day=2024-01-04" in f for f in closed)
    left = {(d, n) for d, n, _ in state._leaves(spark, state.history_path(root))}
    assert {n for d, n in left if d < "2024-01-04"} == {5} and {n for d, n in left if d == "2024-01-04"} == set(range(6))
    state.compact_days(spark, root, dt.date(2024, 1, 4), 4)         # again: nothing to do
    assert _files(state.closed_path(state.history_path(root))) == closed
    # a late row of a closed day, seen by readers, by dedup and by the next run
    late = _media(spark, [(7000, "2024-01-02 08:00:00", "1", "L"), (101, "2024-01-02 11:00:00", "1", "T1")])
    fresh = jobs.dedup_against_history(late, root, 6)
    assert [r["id"] for r in fresh.collect()] == [7000]
    jobs.store_batch(fresh, root, 6)
    state.compact_days(spark, root, dt.date(2024, 1, 4), 6)
    assert state.read_history(spark, root).count() == len(rows) + 1
    assert {n for d, n, _ in state._leaves(spark, state.closed_path(state.history_path(root))) if d == "2024-01-02"} == {6}


def test_a_compaction_that_stopped_before_its_deletes(spark, monkeypatch):
    root = _root()
    _batches(spark, root, n=3)
    rows, views = sorted(map(str, state.read_history(spark, root).collect())), _views(spark, root)
    with monkeypatch.context() as m:
        m.setattr(state, "_delete", lambda *a: None)
        state.compact_days(spark, root, dt.date(2024, 1, 3), 1)
        state.compact_days(spark, root, dt.date(2024, 1, 3), 2)     # two closed generations and all open folders
    assert sorted(map(str, state.read_history(spark, root).collect())) == rows and _views(spark, root) == views
    state.compact_days(spark, root, dt.date(2024, 1, 3), 2)         # the next run deletes what was left
    assert sorted(map(str, state.read_history(spark, root).collect())) == rows and _views(spark, root) == views
    assert {d for d, _, _ in state._leaves(spark, state.history_path(root))} == {"2024-01-03", "2024-01-04"}
    state.drop_days_before(spark, root, dt.date(2024, 1, 2))
    assert state.read_history(spark, root).filter("day < '2024-01-02'").count() == 0
    assert state.newest_event(spark, root) == dt.datetime(2024, 1, 4, 12)
    assert state.newest_event(spark, _root()) is None


def test_driver_closes_and_drops_days_searches_titles_once_and_gives_the_same_results(spark, monkeypatch):
    v = Views(spark, SF_SMALL)
    plain, tidy = _root(), _root()
    asked, resolve = {plain: [], tidy: []}, rec.resolve_titles

    def counting(titles, *args, **options):
        if not options.get("catalogue_titles"):
            asked[root] += [r["title"] for r in titles.collect()]
        return resolve(titles, *args, **options)
    monkeypatch.setattr(rec, "resolve_titles", counting)
    for root, options in ((plain, {}), (tidy, {"close_after": 3, "retain": 2})):
        job = jobs.PlaybackBatchJob(root, None, v.catalogue, v.english, v.genres, v.genre_lookup, "1", time_range="week", **options)
        replay_pulls(v.log, root, lambda src: jobs.run_available(jobs.media_stream(spark, src, v.deny), f"{root}/ckpt", process=job))
    for name in ("stats", "chart", "movie_recommendations", "series_recommendations"):
        assert sorted(map(str, latest_version(spark, tidy, name).collect())) == sorted(map(str, latest_version(spark, plain, name).collect()))
    assert all(titles and len(titles) == len(set(titles)) for titles in asked.values())
    newest = state.newest_event(spark, tidy)
    first = min(d for path in (state.history_path(tidy), state.closed_path(state.history_path(tidy))) for d, _, _ in state._leaves(spark, path))
    assert first >= str((newest - dt.timedelta(days=7 + 2)).date())
    assert state._leaves(spark, state.closed_path(state.history_path(tidy)))
    assert sorted(map(str, state.read_first_wins(spark, tidy, "title_genres", TITLE_GENRES).collect())) == \
        sorted(map(str, state.read_first_wins(spark, plain, "title_genres", TITLE_GENRES).collect()))


# ---- first-wins buckets ----

def test_first_wins_leaves_other_buckets_alone(spark):
    root = _root()
    schema = TITLE_GENRES
    first = spark.createDataFrame([(f"t{i}", "a") for i in range(40)] + [(None, "n")], schema)
    state.append_first_wins(first, root, "titles", "Title", 0, buckets=8)
    before = _files(state.first_wins_path(root, "titles"))
    again = spark.createDataFrame([("t1", "b"), ("new", "b"), (None, "m")], schema)
    for _ in range(2):      # the second run is a replay
        state.append_first_wins(again, root, "titles", "Title", 1, buckets=8)
    after = _files(state.first_wins_path(root, "titles"))
    assert before.items() <= after.items() and len(after) == len(before) + 1
    rows = {r["Title"]: r["Genres"] for r in state.read_first_wins(spark, root, "titles", schema).collect()}
    assert rows == {**{f"t{i}": "a" for i in range(40)}, None: "n", "new": "b"}
    assert state.read_first_wins(spark, root, "titles", schema, before=1).count() == 41
    plan = state.read_first_wins(spark, root, "titles", schema).filter("bucket in (1, 2)")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan
    state.append_first_wins(first.limit(0), root, "titles", "Title", 2)


# ---- totals in Spark's state store ----

def test_totals_over_restarts_and_a_replayed_batch(spark):
    root = _root()
    counts = lambda *rows: spark.createDataFrame(list(rows), jobs.COUNTS_SCHEMA)
    state.write_votes(counts(("a", 2), ("b", 1)), root, jobs.GENRE_VOTES, 0)
    jobs.run_genre_totals(spark, root)
    state.write_votes(counts(("a", 5)), root, jobs.GENRE_VOTES, 0)       # a replay: the first votes stay
    state.write_votes(counts(("a", 3), ("c", 7)), root, jobs.GENRE_VOTES, 1)
    jobs.run_genre_totals(spark, root)
    jobs.run_genre_totals(spark, root)
    assert sorted(tuple(r) for r in jobs.genre_totals(spark, root).collect()) == [("a", 5), ("b", 1), ("c", 7)]
    assert spark.conf.get(jobs.STATE_PROVIDER) != jobs.ROCKSDB      # the session keeps its own setting
    assert any(f.endswith(".zip") for _, _, names in os.walk(jobs.totals_checkpoint(root)) for f in names) or \
        any(f.endswith(".changelog") for _, _, names in os.walk(jobs.totals_checkpoint(root)) for f in names)


# ---- watermark ----

def test_late_rows_are_counted_and_copies_collapse(spark):
    v = Views(spark, SF_SMALL)
    root, progress = _root(), []
    replay_pulls(v.log, root, lambda src: progress.extend(jobs.run_available(
        jobs.daily_views(jobs.media_stream(spark, src, v.deny)), f"{root}/ckpt", sink=f"{root}/out", no_data_batches=True, rocksdb=True)), newest_first=True)
    media = ev.with_kind(ev.media_events(v.log, v.deny)).cache()
    stamp = media.agg(F.max("date")).first()[0] - dt.timedelta(days=3)
    end = F.to_date("date") + F.expr("INTERVAL 1 DAY")
    pulls = [p["numInputRows"] for p in progress if p["numInputRows"]]
    assert len(pulls) == 4
    want = {}
    lo, hi = v.log.agg(F.min("id"), F.max("id")).first()
    start = lo + (hi - lo + 1) / 4 * 3 - 0.1 * (hi - lo + 1) / 4         # the newest pull lands first; the others are late
    for r in media.filter((F.col("id") >= start) & (end.cast("timestamp_ntz") <= F.lit(stamp))).collect():
        key = (str(r["date"].date()), r["kind"], r["title"])
        want[key] = want.get(key, 0) + 1
    got = {(r["day"], r["kind"], r["title"]): r["views"] for r in spark.read.parquet(f"{root}/out").collect()}
    assert got == want
    assert jobs.late_rows(progress) >= media.filter(F.col("id") < start).count() * 0.9


def test_partial_aggregate_stands_before_the_state(spark):
    root = _root()
    os.makedirs(f"{root}/in")
    deny = spark.createDataFrame([("CCTV5+",)], "pattern string")
    with open(f"{root}/in/a.json", "w") as fh:
        for _ in range(50):
            fh.write('{"Items": [{"Id": 1, "Name": "u is playing T on tv", "Type": "VideoPlayback", "Date": "2024-01-01T10:00:00.0000000Z"}], "TotalRecordCount": 1}\n')
    with open(f"{root}/in/b.json", "w") as fh:
        fh.write('{"Items": [{"Id": 2, "Name": "u is playing T on tv", "Type": "VideoPlayback", "Date": "2024-01-09T10:00:00.0000000Z"}], "TotalRecordCount": 1}\n')
    progress = jobs.run_available(jobs.daily_views(jobs.media_stream(spark, f"{root}/in", deny)), f"{root}/ckpt", sink=f"{root}/out", no_data_batches=True)
    assert [tuple(r) for r in spark.read.parquet(f"{root}/out").collect()] == [("2024-01-01", "movie", "T", 1)]
    assert progress[0]["numInputRows"] == 51 and jobs.late_rows(progress) == 0


# ---- dead letters ----

def test_rejects_are_stored_once_and_observed(spark):
    v = Views(spark, SF_SMALL)
    root, progress = _root(), []
    job = jobs.DeadLetterJob(root, v.deny, jobs.DedupJob(root))
    replay_pulls(v.log, root, lambda src: progress.extend(jobs.run_available(
        jobs.observed_envelopes(spark, src), f"{root}/ckpt", process=job)), after_write=spoiled_documents)
    counts = {(r["batch"], r["reason"]): r["rejects"] for r in jobs.reject_counts(spark, root).collect()}
    seen = [p["observedMetrics"]["rejects"] for p in progress if p.get("observedMetrics")]
    assert [s["corrupt_documents"] for s in seen] == [counts.get((b, "document"), 0) for b in range(4)]
    assert [s["malformed_dates"] for s in seen] == [counts.get((b, "date"), 0) for b in range(4)]
    assert sum(counts.values()) > 0
    # events with an unreadable date are not lost: their well-dated copies are stored once
    ids = [r["id"] for r in state.read_history(spark, root).select("id").collect()]
    assert sorted(ids) == sorted(r["id"] for r in ev.media_events(v.log, v.deny).select("id").collect())


# ---- typed append ----

def test_a_replayed_append_adds_nothing(spark):
    path = f"{_root()}/titles"
    schema = spark.createDataFrame([], "item_type string, tmdb_id string, title string").schema
    rows = lambda *r: spark.createDataFrame(list(r), schema)
    csvio.append_once(rows(("Movie", "1", "M"), ("Series", "1", "S"), ("Movie", "1", "A")), ["item_type", "tmdb_id"], path, 0, schema)
    for _ in range(2):
        csvio.append_once(rows(("Movie", "1", "late"), ("Movie", "2", 'with, comma "quoted"')), ["item_type", "tmdb_id"], path, 1, schema)
    got = sorted(tuple(r) for r in csvio.read_appended(spark, path, schema).select(*schema.names).collect())
    assert got == [("Movie", "1", "A"), ("Movie", "2", 'with, comma "quoted"'), ("Series", "1", "S")]
