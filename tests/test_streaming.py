"""Streaming jobs: batch equivalence, replay safety, odd input files."""

import os
import tempfile

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import SF_SMALL
from playlens.functions.time import event_time, instant
from playlens.operators import events as ev
from playlens.queries import Views
from playlens.sources import envelope
from playlens.streaming import jobs, state
from playlens.streaming.runner import latest_version, replay_pulls


def _root():
    return tempfile.mkdtemp(prefix="run-")


def test_dedup_stream_equals_batch(spark):
    v = Views(spark, SF_SMALL)
    root = _root()
    sink, ckpt = f"{root}/out", f"{root}/ckpt"
    replay_pulls(v.log, root, lambda src: jobs.run_available(
        jobs.dedup_stream(jobs.media_stream(spark, src, v.deny)).select("id", "media_name"), ckpt, sink=sink))
    streamed = sorted(tuple(r) for r in spark.read.parquet(sink).collect())
    batch = sorted(tuple(r) for r in ev.media_events(v.log, v.deny).select("id", "media_name").collect())
    assert streamed == batch
    assert len({r[0] for r in streamed}) == len(streamed)


def test_history_replay_is_idempotent(spark):
    v = Views(spark, SF_SMALL)
    media = ev.media_events(v.log, v.deny)
    root = _root()
    rows = jobs.history_rows(media)
    state.append_history(rows, root, 0)
    first = state.read_history(spark, root).count()
    state.append_history(rows, root, 0)          # the same batch again
    assert state.read_history(spark, root).count() == first == media.count()
    pruned = state.read_history(spark, root, "2024-01-15 00:00:00")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "(day#" in plan
    assert pruned.count() == media.filter(F.col("date") >= F.lit("2024-01-15").cast("timestamp_ntz")).count()


def test_odd_files_in_the_stream(spark):
    root = _root()
    src = os.path.join(root, "in")
    os.makedirs(src)
    item = ('{"Id": %d, "Name": "u is playing T%d on tv", "Type": "VideoPlayback", '
            '"Date": "2024-01-0%dT10:00:00.0000000Z", "UserId": "1"}')
    files = {
        "a_empty_array.json": "[]",
        "b_empty_items.json": '{"Items": [], "TotalRecordCount": 0}',
        "c_two.json": '{"Items": [%s, %s], "TotalRecordCount": 2}' % (item % (2, 2, 2), item % (3, 3, 3)),
        "d_out_of_order.json": '{"Items": [%s], "TotalRecordCount": 1}' % (item % (1, 1, 1)),
    }
    for name, body in files.items():
        with open(os.path.join(src, name), "w") as fh:
            fh.write(body)
    deny = spark.createDataFrame([("CCTV5+",)], "pattern string")
    sink = f"{root}/out"
    jobs.run_available(jobs.dedup_stream(jobs.media_stream(spark, src, deny)).select("id", "media_name"),
                       f"{root}/ckpt", sink=sink)
    assert sorted(tuple(r) for r in spark.read.parquet(sink).collect()) == [(1, "T1"), (2, "T2"), (3, "T3")]


def test_batch_driver_state(spark):
    v = Views(spark, SF_SMALL)
    root = _root()
    job = jobs.PlaybackBatchJob(root, "2024-02-15 00:00:00", v.catalogue, v.english, v.genres,
                                v.genre_lookup, "1")
    replay_pulls(v.log, root, lambda src: jobs.run_available(
        jobs.media_stream(spark, src, v.deny), f"{root}/ckpt", process=job))
    mark = latest_version(spark, root, "mark").first()["mark"]
    assert mark == ev.media_events(v.log, v.deny).agg(F.max("id")).first()[0]
    recs = latest_version(spark, root, "movie_recommendations")
    assert [r["rank"] for r in recs.orderBy("rank").collect()] == [1, 2, 3]
    assert state.newest_version(spark, root, "stats") == 3
    assert sorted(os.listdir(f"{root}/stats")) == ["v=1", "v=2", "v=3"]      # the oldest is dropped


def test_envelope_roundtrip_and_numbering(spark):
    v = Views(spark, SF_SMALL)
    root = _root()
    paths = envelope.write_pulls(envelope.assign_pulls(v.log), root)
    assert [os.path.basename(p) for p in paths] == ["activity_01", "activity_02", "activity_03", "activity_04"]
    back = ev.flatten_log(envelope.read_envelopes(spark, f"{root}/activity_*"))
    assert back.select("id").distinct().count() == v.log.count()


def test_batch_dedup_with_a_hot_id(spark):
    root = _root()
    rows = [(7, "2024-01-02 10:00:00", "1", "u is playing A on tv", "A")] * 3000 + \
        [(i, "2024-01-02 11:00:00", "1", "u is playing B on tv", "B") for i in range(100, 110)]
    schema = "id bigint, date string, user_id string, name string, media_name string"
    first = spark.createDataFrame(rows, schema).withColumn("date", F.col("date").cast("timestamp_ntz"))
    fresh = jobs.dedup_against_history(first.repartition(8), root)
    assert sorted(r.id for r in fresh.collect()) == [7] + list(range(100, 110))
    jobs.store_batch(fresh, root, 0)
    again = jobs.dedup_against_history(first.filter("id >= 105").repartition(4), root)
    assert again.count() == 0


def _media(spark, rows):
    df = spark.createDataFrame(rows, "id bigint, date string, user_id string, media_name string")
    return df.withColumn("date", F.col("date").cast("timestamp_ntz"))


def test_dedup_with_null_ids_and_dates_in_any_order(spark):
    root = _root()
    late = _media(spark, [(5, "2024-01-20 10:00:00", "1", "E"), (6, None, "1", "F"), (None, "2024-01-20 10:00:00", "1", "N")])
    early = _media(spark, [(1, "2024-01-02 10:00:00", "1", "A"), (5, "2024-01-20 10:00:00", "1", "E"), (6, None, "1", "F"),
                           (None, "2024-01-02 10:00:00", "1", "N"), (1, "2024-01-02 10:00:00", "1", "A")])
    job = jobs.DedupJob(root)
    job(late, 0)
    job(early, 1)
    job(early, 1)               # a replay of the same batch adds nothing
    ids = sorted(str(r.id) for r in state.read_history(spark, root).collect())
    assert ids == ["1", "5", "6", "None", "None"]


def test_a_lost_state_version_raises(spark):
    root = _root()
    schema = jobs._schema(jobs.COUNTS_SCHEMA)
    assert state.read_version(spark, root, "genre_counts", -1, schema).count() == 0
    with pytest.raises(AnalysisException):
        state.read_version(spark, root, "genre_counts", 5, schema)


def test_window_end_and_retention(spark):
    root = _root()
    rows = [(i, f"2024-01-{i:02d} 12:00:00", "1", f"T{i}") for i in range(1, 29)]
    job = jobs.RollingStatsJob(root, lambda: "2024-01-20 12:00:00", "week", dedup=True, retain=0)
    job(_media(spark, rows), 0)
    stats = latest_version(spark, root, "stats")
    assert sorted(r.title for r in stats.collect()) == sorted(f"T{i}" for i in range(13, 21))
    assert state.read_history(spark, root).agg(F.min("id")).first()[0] == 13


def test_multi_line_documents_archive_and_unparsable(spark):
    root = _root()
    src, archive = os.path.join(root, "in"), os.path.join(root, "archive")
    os.makedirs(src)
    item = '{"Id": %d,\n "Name": "u is playing T%d on tv",\n "Type": "VideoPlayback",\n "Date": "2024-01-02T10:00:00.0Z"}'
    for n in range(3):
        with open(os.path.join(src, f"{n}.json"), "w") as fh:
            fh.write('{\n"Items": [\n%s\n],\n"TotalRecordCount": 1\n}' % (item % (n, n)))
    with open(os.path.join(src, "bad.json"), "w") as fh:
        fh.write("{ no json\n")
    deny = spark.createDataFrame([("CCTV5+",)], "pattern string")
    assert [os.path.basename(r.file) for r in envelope.unparsable(spark, src, multi_line=True).collect()] == ["bad.json"]
    for _ in range(2):          # files of a committed batch are archived when the next one starts
        jobs.run_available(jobs.media_stream(spark, src, deny, multi_line=True, clean_source="archive", archive_dir=archive)
                           .select("id", "media_name"), f"{root}/ckpt", sink=f"{root}/out")
        with open(os.path.join(src, "late.json"), "w") as fh:
            fh.write('{"Items": [%s], "TotalRecordCount": 1}' % (item % (9, 9)))
    assert sorted(r.id for r in spark.read.parquet(f"{root}/out").collect()) == [0, 1, 2, 9]


def test_event_time_in_the_repeated_autumn_hour(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame([("2024-11-03T08:30:00.1234567Z",), ("2024-11-03T09:30:00Z",), ("garbage",)], "d string")
        df = df.select(event_time("d").alias("date")).select(
            "date", F.date_format("date", "HH:mm").alias("t"), F.unix_micros(instant("date")).alias("us"))
        got = [(r.t, r.us) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == [("08:30", 1730622600123456), ("09:30", 1730626200000000), (None, None)]


def test_envelopes_of_null_and_repeated_ids_stay_bounded(spark):
    rows = [(None, f"n{i}") for i in range(25)] + [(7, f"r{i}") for i in range(23)] + [(8, "x")]
    log = spark.createDataFrame(rows, "id bigint, name string").selectExpr(
        "id", "timestamp_ntz'2024-01-02 10:00:00' as date", "'1' as user_id", "'VideoPlayback' as type", "name")
    docs = envelope.pack_envelopes(log, page_size=10).collect()
    assert max(d.TotalRecordCount for d in docs) < 25 and sum(d.TotalRecordCount for d in docs) == 49
    assert sorted(i.Name for d in docs for i in d.Items) == sorted(n for _, n in rows)
