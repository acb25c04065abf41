"""Plan checks: no Python UDFs, pushdown to the scan, broadcasts where bounded."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from playlens.queries import Views
from playlens.operators import events as ev
from playlens.sources import tables as tb

def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["view_statistics", "recommend_movies", "search_catalogue",
                                  "denylist_scan", "genre_strings"])
def test_no_python_udfs(spark, name):
    plan = _plan(entry.queries()[name](spark, SF_SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas"):
        assert node not in plan


def test_scan_pruning_and_broadcast(spark):
    v = Views(spark, SF_SMALL)
    media = ev.media_events(v.log, v.deny, deny_max=2).select("id", "media_name")
    plan = _plan(media)
    # only the needed event columns are read (ts and props are not)
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string,value:double>" in plan
    # the item-range bound reaches the orders scan
    assert "GreaterThanOrEqual(o_orderkey,-199)" in plan
    # the bounded catalogue slice and the deny-list are broadcast, the events are not shuffled
    assert "BroadcastHashJoin" in plan and "BroadcastNestedLoopJoin" in plan


def test_filter_pushdown_to_parquet(spark):
    v = Views(spark, SF_SMALL)
    plan = _plan(v.t.events.filter("event_type = 'view'").select("event_id"))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,view)]" in plan


def test_catalogue_join_side_is_bounded(spark):
    v = Views(spark, SF_SMALL)
    plan = _plan(tb.catalogue(v.t))
    assert "PushedFilters: [IsNotNull(p_partkey), GreaterThanOrEqual(p_partkey,-199), LessThanOrEqual(p_partkey,199)]" in plan


def test_user_filter_reaches_the_scan(spark):
    from playlens.queries import _media
    plan = _plan(_media(Views(spark, SF_SMALL), "1"))
    assert "EqualTo(user_id,1)" in plan


def test_genre_filter_runs_below_the_distinct(spark):
    from playlens.operators import catalogue as cat
    v = Views(spark, SF_SMALL)
    ids = v.genre_lookup.limit(2)
    plan = _plan(cat.titles_by_genres(ids, v.genre_lookup, v.genres, v.catalogue, "Movie", known_max=2))
    assert "PushedFilters: [In(p_type, [" in plan or "EqualTo(p_type" in plan


def test_frames_before_the_checkpoints_hold_no_python(spark):
    from playlens.operators import catalogue as cat
    v = Views(spark, SF_SMALL)
    frames = [ev.with_kind(ev.media_events(v.log, v.deny)), v.genres, cat.item_genres(v.genres), cat.english_lookup(v.english)]
    for df in frames:
        plan = _plan(df)
        for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas"):
            assert node not in plan
