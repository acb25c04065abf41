"""Operators checked against brute force on small inputs."""

import itertools
import random

from pyspark.sql import functions as F

from playlens.operators import aggregates as agg
from playlens.operators import catalogue as cat
from playlens.operators import events as ev
from playlens.operators import rules
from playlens.operators.ranking import ordered_position
from playlens.operators.textjoin import contains_matches


def test_contains_matches_equals_brute_force(spark):
    rnd = random.Random(7)
    alphabet = "abcAB +"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 12))) for _ in range(300)]
    pats = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 5))) for _ in range(40)] + ["", None]
    tdf = spark.createDataFrame([(t,) for t in texts], "text string")
    pdf = spark.createDataFrame([(p,) for p in pats], "pattern string")
    for lower in (False, True):
        got = {(r[0], r[1]) for r in contains_matches(tdf, "text", pdf, "pattern", lower=lower).collect()}
        norm = (lambda s: s.lower()) if lower else (lambda s: s)
        want = {(t, p) for t in set(texts) for p in set(pats) if p and norm(p) in norm(t)}
        assert got == want


def test_denylist_literal_and_regex(spark):
    log = spark.createDataFrame(
        [(1, "u is playing CCTV5+ on d"), (2, "u is playing CCTV55 on d"), (3, "u on HD box"),
         (4, "u is playing X on d"), (5, None)], "id bigint, name string")
    deny = spark.createDataFrame([("CCTV5+",), ("HD",)], "pattern string")
    lit = {r.id for r in ev.filter_denylist(log, deny).collect()}
    rx = {r.id for r in ev.filter_denylist(log, deny, mode="regex").collect()}
    assert lit == {2, 4}          # literal: "CCTV55" is not "CCTV5+"
    assert rx == {4}              # regex: "CCTV5+" means CCTV then fives


def test_denylist_gram_path_matches_broadcast_path(spark, monkeypatch):
    from playlens import params
    log = spark.createDataFrame([(i, f"user_{i} is playing t{i % 13} on {'HD box' if i % 5 == 0 else 'tv'}")
                                 for i in range(200)], "id bigint, name string")
    deny = spark.createDataFrame([("HD",), ("t1",), ("zz",)], "pattern string")
    small = {r.id for r in ev.filter_denylist(log, deny).collect()}
    monkeypatch.setattr(params, "BROADCAST_ROW_LIMIT", 1)
    big = {r.id for r in ev.filter_denylist(log, deny).collect()}
    assert small == big
    assert small == {i for i in range(200) if i % 5 != 0 and not f"t{i % 13}".startswith("t1")}


def test_regex_denylist_in_blocks(spark, monkeypatch):
    from playlens import params
    log = spark.createDataFrame([(i, f"user_{i} is playing t{i % 13} on tv") for i in range(100)], "id bigint, name string")
    deny = spark.createDataFrame([("t1[0-2]? ",), ("user_7",), ("zz+",), ("t5 on",)], "pattern string")
    small = {r.id for r in ev.filter_denylist(log, deny, mode="regex").collect()}
    monkeypatch.setattr(params, "BROADCAST_ROW_LIMIT", 1)
    assert {r.id for r in ev.filter_denylist(log, deny, mode="regex").collect()} == small
    assert small and all(i % 13 not in (1, 5, 10, 11, 12) and not str(i).startswith("7") for i in small)


def test_search_of_empty_and_single_letter_terms(spark):
    catalogue = spark.createDataFrame([(3, "Movie", "Beta", "1"), (2, "Series", "Alpha", "2"), (9, "Episode", "Z", "3")],
                                      "item_id bigint, type string, title string, tmdb_id string")
    terms = spark.createDataFrame([("",), ("b",), ("A",), ("z",)], "title string")
    got = {r.title: r.item_id for r in cat.search_catalogue(terms, catalogue).collect()}
    assert got == {"": 2, "b": 3, "A": 2, "z": None}


def test_english_titles_by_type_first_entry(spark):
    found = spark.createDataFrame([(1, "Movie", "Alpha", "550"), (2, "Series", "Beta", "550"), (3, "Movie", "C", None)],
                                  "item_id bigint, item_type string, item_title string, tmdb_id string")
    cache = spark.createDataFrame([("Movie", "550", "EN Z", 1), ("Movie", "550", "EN A", 2), ("Series", "550", "EN Beta", 3)],
                                  "item_type string, tmdb_id string, title string, seq int")
    got = {r.item_id: (r.english_title, r.status) for r in cat.english_titles(found, cache).collect()}
    assert got == {1: ("EN Z", "ok"), 2: ("EN Beta", "ok"), 3: (None, "no_tmdb_id")}
    missing = cat.missing_english(found, cache.filter("item_type = 'Movie'"))
    assert [r.item_id for r in missing.collect()] == [2]


def test_ordered_position_matches_row_number(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice("ab"), f"t{i}", rnd.randint(1, 5)) for i in range(500)]
    df = spark.createDataFrame(rows, "kind string, title string, views bigint").repartition(7)
    got = {(r.kind, r.title): r.rank for r in
           ordered_position(df, ["kind"], [F.col("views").desc(), F.col("title")]).collect()}
    want = {}
    for k in "ab":
        ranked = sorted((r for r in rows if r[0] == k), key=lambda r: (-r[2], r[1]))
        want.update({(k, r[1]): i + 1 for i, r in enumerate(ranked)})
    assert got == want


def test_keep_first_and_merge_counts(spark):
    df = spark.createDataFrame([("x", 2, "late"), ("x", 1, "early"), ("y", 5, "only")],
                               "k string, seq int, v string")
    assert {r.k: r.v for r in agg.keep_first(df, "k", "seq", ["v"]).collect()} == {"x": "early", "y": "only"}
    old = spark.createDataFrame([("a", 2), ("b", 1)], "genre string, counts bigint")
    new = spark.createDataFrame([("a", 3), ("c", 4)], "genre string, counts bigint")
    assert {r.genre: r.counts for r in agg.merge_counts(old, new).collect()} == {"a": 5, "b": 1, "c": 4}


def test_high_water_mark_and_filter(spark):
    log = spark.createDataFrame([(3,), (1,), (7,)], "id bigint")
    mark = ev.high_water_mark(log)
    assert mark.first()["mark"] == 7          # max, not the first row
    later = spark.createDataFrame([(5,), (8,), (9,)], "id bigint")
    assert sorted(r.id for r in ev.high_water_filter(later, mark).collect()) == [8, 9]
    assert ev.high_water_filter(later, None).count() == 3
    empty_mark = ev.high_water_mark(spark.createDataFrame([], "id bigint"))
    assert ev.high_water_filter(later, empty_mark).count() == 3
    assert ev.batch_counts(later, ev.high_water_filter(later, mark)).first().asDict() == \
        {"batch_rows": 3, "kept_rows": 2}


def test_search_prefers_exact_then_smallest_id(spark):
    catalogue = spark.createDataFrame(
        [(1, "Movie", "Alpha Two", "601"), (2, "Series", "alpha", None), (3, "Movie", "Big Alpha", "603"),
         (4, "Episode", "Gamma", "604"), (5, "Movie", "Gamma Ray", "605")],
        "item_id bigint, type string, title string, tmdb_id string")
    terms = spark.createDataFrame([("Alpha",), ("lph",), ("Gamma",), ("none",)], "title string")
    got = {r.title: r.item_id for r in cat.search_catalogue(terms, catalogue).collect()}
    # exact (case-insensitive) beats contains; Episode items are never returned
    assert got == {"Alpha": 2, "lph": 1, "Gamma": 5, "none": None}
    cache = spark.createDataFrame([("601", "EN Alpha Two")], "tmdb_id string, title string")
    status = {r.title: (r.status, r.english_title) for r in
              cat.english_titles(cat.search_catalogue(terms, catalogue), cache).collect()}
    assert status == {"Alpha": ("no_tmdb_id", None), "lph": ("ok", "EN Alpha Two"),
                      "Gamma": ("unresolved", "Gamma Ray"), "none": ("no_item", None)}


def _brute_rules(baskets, min_support, min_conf):
    real = [set(b) for b in baskets if b is not None]
    n = len(real)
    items = sorted(set().union(*real)) if real else []
    import math
    min_count = math.ceil(min_support * n)
    freq = {}
    for size in range(1, len(items) + 1):
        for combo in itertools.combinations(items, size):
            c = sum(1 for b in real if set(combo) <= b)
            if c >= min_count:
                freq[frozenset(combo)] = c
    out = {}
    for s, c in freq.items():
        if len(s) < 2:
            continue
        for y in s:
            ante = s - {y}
            conf = c / freq[ante]
            if conf >= min_conf:
                out[(tuple(sorted(ante)), y)] = round(conf, 9)
    return freq, out


def test_fp_growth_matches_brute_force(spark):
    rnd = random.Random(11)
    genres = list("ABCDE")
    baskets = [sorted(rnd.sample(genres, rnd.randint(1, 4))) for _ in range(60)] + [None]
    df = spark.createDataFrame([(b,) for b in baskets], "basket array<string>")
    model = rules.fit_rules(df)
    freq, want = _brute_rules(baskets, 0.1, 0.2)
    got_freq = {frozenset(r["items"]): r["freq"] for r in rules.freq_itemsets(model).collect()}
    assert got_freq == freq
    got = {(tuple(r["antecedent"]), r["consequent"]): round(r["confidence"], 9)
           for r in rules.association_rules(model).collect()}
    assert got == want
    pred = rules.predict(model, df).collect()
    for r in pred:
        b = r["basket"]
        if b is None:
            assert r["prediction"] == []
            continue
        exp = sorted({y for (a, y) in want if set(a) <= set(b) and y not in b})
        assert r["prediction"] == exp


def test_recommend_movies_can_leave_out_watched_titles(spark):
    from conftest import SF_SMALL
    from playlens.plans import recommend as rec
    from playlens.queries import Views
    v = Views(spark, SF_SMALL)
    media = ev.media_events(v.log, v.deny)
    watched = {r.title for r in rec.user_titles(media, "1", "movie").collect()}
    base = rec.recommend_movies(media, v.catalogue, v.english, v.genres, v.genre_lookup, "1")
    fresh = rec.recommend_movies(media, v.catalogue, v.english, v.genres, v.genre_lookup, "1",
                                 exclude_watched=True)
    assert base.count() == 3 and fresh.count() == 3
    details = rec.resolve_titles(spark.createDataFrame([(t,) for t in watched], "title string"),
                                 v.catalogue, v.english, v.genres)
    watched_en = {r.english_title for r in details.collect()} | watched
    assert not ({r.title for r in fresh.collect()} & watched_en)


def test_rarest_gram_join_equals_plain_contains(spark):
    from playlens.operators.textjoin import contains_matches
    texts = [f"user is playing common beginning {i} on tv" for i in range(60)] + ["ab", "", None, "AbC abc", "a"]
    patterns = [f"common beginning {i} " for i in range(0, 60, 7)] + ["common", "b", "ab", "zzz", "nothing of this kind", "", None, "user is playing common beginning 5", "bc a"]
    t = spark.createDataFrame([(x,) for x in texts], "t string")
    p = spark.createDataFrame([(x,) for x in patterns], "p string")
    want = sorted({(x, y) for x in texts if x for y in patterns if y and y in x})
    for rarest in (False, True):
        assert sorted(tuple(r) for r in contains_matches(t, "t", p, "p", rarest=rarest).collect()) == want
    lowered = sorted({(x, y) for x in texts if x for y in patterns if y and y.lower() in x.lower()})
    assert sorted(tuple(r) for r in contains_matches(t, "t", p, "p", lower=True, rarest=True).collect()) == lowered


def test_large_denylist_has_no_nested_loop(spark):
    from playlens import params
    log = spark.createDataFrame([(i, f"u is playing T{i} on tv") for i in range(300)] + [(999, None)], "id long, name string")
    deny = spark.createDataFrame([(f" T{i} ",) for i in range(0, 1400, 2)], "pattern string")
    assert deny.count() > params.NESTED_LOOP_PATTERNS
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    small, large = ev.filter_denylist(log, deny), ev.filter_denylist(log, deny, nested_pairs=0)
    assert "BroadcastNestedLoopJoin" in plan(small) and "NestedLoop" not in plan(large) and "Cartesian" not in plan(large)
    want = sorted(i for i in range(300) if i % 2)
    assert sorted(r["id"] for r in small.collect()) == sorted(r["id"] for r in large.collect()) == want


def test_long_numbers_of_other_texts_keep_no_pattern(spark, monkeypatch):
    """Digits that many texts hold in other numbers make no candidates: such patterns drop out before the join."""
    from playlens.operators import textjoin
    kept = []
    monkeypatch.setattr(textjoin, "materialize", lambda df: kept.append(df) or df)
    t = spark.createDataFrame([(f"user_{1000 + i} is playing hot bolt {i % 20} on tv",) for i in range(400)], "t string")
    p = spark.createDataFrame([(f"hot bolt {n} ",) for n in (7, *range(1000, 1400, 2))], "p string")
    got = textjoin.contains_matches(t, "t", p, "p", rarest=True)
    assert {r["p"] for r in got.collect()} == {"hot bolt 7 "} and got.count() == 20
    assert [r["_pattern"] for r in kept[1].collect()] == ["hot bolt 7 "]


def test_title_cache_is_filtered_before_its_shuffle(spark):
    """The wanted ids are broadcast to the cache, whatever Spark knows of their size."""
    from playlens.operators import catalogue as cat
    found = spark.createDataFrame([("a", 1, "Movie", "a", "11"), ("b", 2, "Movie", "b", None), ("c", 3, "Movie", "c", "13")],
                                  "title string, item_id long, item_type string, item_title string, tmdb_id string")
    cache = spark.createDataFrame([("11", "EN a"), ("12", "EN x")], "tmdb_id string, title string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = cat.english_titles(found, cache)
        assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()
        assert {(r.title, r.english_title, r.status) for r in got.collect()} == {("a", "EN a", "ok"), ("b", None, "no_tmdb_id"), ("c", "c", "unresolved")}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
