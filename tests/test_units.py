"""Hand-written rows for the edge cases of the log, titles, dates and baskets."""

import datetime as dt

from pyspark.sql import functions as F

from playlens.functions.text import genre_array, media_name
from playlens.functions.time import event_time, range_start
from playlens.operators import events as ev


def _titles(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "name string")
    media = ev.with_media_name(df.withColumn("id", F.monotonically_increasing_id()))
    return {r["name"]: (r["kind"], r["title"]) for r in ev.with_kind(media).collect()}


def test_title_extraction_cases(spark):
    got = _titles(spark, [
        "u is playing Spider-Man on Chrome",
        "u is playing Man on Fire on Chrome",
        "u is playing Show - S1, Ep2 on TV",
        "nothing",
        None,
        "displaying A on B",
        "u is playing -Lead on TV",
    ])
    assert got["u is playing Spider-Man on Chrome"] == ("series", "Spider")
    assert got["u is playing Man on Fire on Chrome"] == ("movie", "Man")
    assert got["u is playing Show - S1, Ep2 on TV"] == ("series", "Show")
    assert got["displaying A on B"] == ("movie", "A")
    # a leading dash gives the empty series name, which is kept
    assert got["u is playing -Lead on TV"] == ("series", "")
    assert "nothing" not in got and None not in got


def test_empty_title_dropped(spark):
    df = spark.createDataFrame([("user_1 is playing  on device",)], "name string")
    assert df.select(media_name("name").alias("m")).first()["m"] == ""
    assert ev.with_media_name(df).count() == 0


def test_split_branches_partition_titles(spark):
    df = spark.createDataFrame([("a - S1, Ep1",), ("b",), ("c-d",)], "media_name string")
    series = {r[0] for r in ev.split_series(df).collect()}
    movies = {r[0] for r in ev.split_movies(df).collect()}
    assert series == {"a", "c"} and movies == {"b"}


def test_event_time_parsing(spark):
    df = spark.createDataFrame([("2024-04-20T12:34:56.1234567Z",), ("garbage",), (None,)], "d string")
    rows = df.select(event_time("d").alias("t")).collect()
    assert rows[0]["t"] == dt.datetime(2024, 4, 20, 12, 34, 56, 123456)
    assert rows[1]["t"] is None and rows[2]["t"] is None


def test_event_time_independent_of_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        df = spark.createDataFrame([("2024-04-20T12:34:56Z",)], "d string")
        assert df.select(event_time("d").alias("t")).first()["t"] == dt.datetime(2024, 4, 20, 12, 34, 56)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_rejected_dates_are_reported(spark):
    env = spark.createDataFrame(
        [([(1, "u is playing A on B", None, "VideoPlayback", "garbage", "1", None, None)], 1)],
        "Items array<struct<Id:bigint,Name:string,ShortOverview:string,Type:string,Date:string,"
        "UserId:string,UserPrimaryImageTag:string,Severity:string>>, TotalRecordCount int")
    flat = ev.flatten_log(env, keep_raw_date=True)
    assert flat.count() == 1
    assert ev.rejected_rows(flat).count() == 1


def test_month_arithmetic(spark):
    row = spark.range(1).select(range_start("2024-03-31 00:00:00", "month").alias("s")).first()
    assert row["s"] == dt.datetime(2024, 2, 29)
    row = spark.range(1).select(range_start("2024-03-31 00:00:00", "unknown").alias("s")).first()
    assert row["s"] == dt.datetime(2024, 3, 31)


def test_genre_baskets(spark):
    df = spark.createDataFrame([("a, a",), ("",), (None,), ("x, y",)], "g string")
    got = [r["b"] for r in df.select(genre_array("g").alias("b")).collect()]
    assert got == [["a"], None, None, ["x", "y"]]


def test_event_time_instant_independent_of_session_zone(spark):
    from playlens.streaming.jobs import with_event_time
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Los_Angeles", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5),)], "date timestamp_ntz")
            epoch = with_event_time(df).select(F.unix_micros("event_time").alias("u")).first()["u"]
            assert epoch == int(dt.datetime(2024, 1, 2, 3, 4, 5, tzinfo=dt.timezone.utc).timestamp() * 1e6)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_small_helpers(spark):
    import tempfile

    from playlens.functions.text import padded_number, provider_id
    from playlens.schemas import TITLE_GENRES
    from playlens.sources import csvio, envelope

    assert envelope.file_name(1) == "activity_01" and envelope.file_name(123) == "activity_123"
    row = spark.range(1).select(
        padded_number(F.lit(7)).alias("p"),
        provider_id(F.create_map(F.lit("Tmdb"), F.lit("42"))).alias("hit"),
        provider_id(F.create_map(F.lit("Imdb"), F.lit("x"))).alias("miss")).first()
    assert (row["p"], row["hit"], row["miss"]) == ("07", "42", "")
    missing = tempfile.mkdtemp(prefix="run-") + "/never_written"
    empty = csvio.read_or_empty(spark, missing, TITLE_GENRES)
    assert empty.count() == 0 and empty.columns == ["Title", "Genres"]
    log = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 19))],
                                "id bigint, date timestamp_ntz")
    assert ev.pulled_since(log, None).count() == 2            # the first pull takes everything
    assert [r.id for r in ev.pulled_since(log, "2024-01-20 00:00:00").collect()] == [2]
