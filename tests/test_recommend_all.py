"""Recommendations of all users at once, rules by join, itemsets of many groups."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from playlens import params
from playlens.operators import events as ev
from playlens.operators import rules
from playlens.plans import recommend as rec
from playlens.plans import recommend_all as rec_all
from playlens.queries import Views, recommend_movies_all_users, recommend_series_all_users


def _baskets(spark, seed=3):
    rng = random.Random(seed)
    genres = [f"g{i}" for i in range(9)]
    rows = []
    for user in range(6):
        for t in range(rng.randrange(1, 40)):
            rows.append((str(user), f"t{t}", sorted(rng.sample(genres[:3 + user], rng.randrange(1, 4)))))
    rows += [("0", "none", None), ("7", "none", None), ("8", "one", ["g1"])]
    return spark.createDataFrame(rows, "user_id string, title string, basket array<string>")


def test_group_itemsets_equal_fp_growth_of_each_group(spark):
    baskets = _baskets(spark).cache()
    sets = rules.group_itemsets(baskets, "user_id").cache()
    found = rules.group_rules(sets, "user_id").cache()
    for user in [str(u) for u in range(6)] + ["8"]:
        model = rules.fit_rules(baskets.filter(F.col("user_id") == user))
        want = sorted((tuple(r["items"]), r["freq"]) for r in rules.freq_itemsets(model).collect())
        mine = sets.filter(F.col("user_id") == user)
        assert sorted((tuple(r["items"]), r["freq"]) for r in mine.collect()) == want
        want = sorted((tuple(r["antecedent"]), r["consequent"]) for r in rules.association_rules(model).collect())
        mine = found.filter(F.col("user_id") == user)
        assert sorted((tuple(r["antecedent"]), r["consequent"]) for r in mine.collect()) == want
        for r in mine.collect():
            assert r["anchor"] in r["antecedent"]


def test_rules_by_join_equal_the_models_own_prediction(spark):
    baskets = _baskets(spark).filter("user_id = '5' or basket is null").unionByName(
        spark.createDataFrame([("x", "e", []), ("x", "dup", ["g1", "g1"]), ("x", "new", ["zz"])], "user_id string, title string, basket array<string>"))
    baskets = baskets.unionByName(baskets)
    model = rules.fit_rules(baskets.filter(F.size("basket") > 0))
    want = model.transform(baskets).withColumn("prediction", F.sort_array("prediction"))
    assert sorted(map(str, rules.predict(model, baskets).collect())) == sorted(map(str, want.collect()))


def test_no_groups(spark):
    none = _baskets(spark).filter("basket is null")
    assert rules.group_itemsets(none, "user_id").count() == 0
    assert [r["prediction"] for r in rules.apply_rules(none, rules.group_rules(rules.group_itemsets(none, "user_id"), "user_id"), keys=["user_id"]).collect()] == [[], []]


@pytest.mark.parametrize("kind", ["movies", "series"])
def test_every_user_gets_the_rows_of_a_run_of_its_own(spark, kind):
    v = Views(spark, SF_SMALL)
    media = ev.media_events(v.log, v.deny).cache()
    everyone = (recommend_movies_all_users if kind == "movies" else recommend_series_all_users)(spark, SF_SMALL).collect()
    alone = rec.recommend_movies if kind == "movies" else rec.recommend_series
    for user in ("1", "2", "3"):
        want = sorted(tuple(r) for r in alone(media, v.catalogue, v.english, v.genres, v.genre_lookup, user).collect())
        assert sorted(tuple(r)[1:] for r in everyone if r["user_id"] == user) == want


def test_earlier_state_counts(spark):
    v = Views(spark, SF_SMALL)
    media = ev.media_events(v.log, v.deny).filter("user_id in ('1', '2')").cache()
    genre = v.genre_lookup.select(F.min("name")).first()[0]
    before = spark.createDataFrame([("1", genre, 1000), ("99", genre, 1)], "user_id string, genre string, counts long")
    got = rec_all.recommend_movies_all(media, v.catalogue, v.english, v.genres, v.genre_lookup, before).collect()
    want = rec.recommend_movies(media, v.catalogue, v.english, v.genres, v.genre_lookup, "1", before.filter("user_id = '1'").drop("user_id"))
    assert sorted(tuple(r)[1:] for r in got if r["user_id"] == "1") == sorted(tuple(r) for r in want.collect())
    assert {r["user_id"] for r in got} == {"1", "2", "99"} and all(genre in r["genres"] for r in got if r["user_id"] == "99")
    history = spark.createDataFrame([("1", "EN old", genre), ("1", "EN x", None)], "user_id string, Title string, Genres string")
    got = rec_all.recommend_series_all(media, v.catalogue, v.english, v.genres, v.genre_lookup, history).collect()
    want = rec.recommend_series(media, v.catalogue, v.english, v.genres, v.genre_lookup, "1", history.drop("user_id"))
    assert sorted(tuple(r)[1:] for r in got if r["user_id"] == "1") == sorted(tuple(r) for r in want.collect())


def test_titles_that_several_items_share_add_their_hits(spark):
    items = spark.createDataFrame([(1, "Movie", "A", "1"), (2, "Movie", "A", "2"), (3, "Movie", "B", "3"), (4, "Movie", "C", None), (5, "Series", "D", "5")],
                                  "item_id long, type string, title string, tmdb_id string")
    links = spark.createDataFrame([(1, "x"), (2, "x"), (3, "x"), (3, "y"), (4, "y"), (5, "x")], "item_id long, genre string")
    profiles = spark.createDataFrame([(["x"],), (["x", "y"],), (["y"],)], "profile array<string>")
    cache = spark.createDataFrame([("3", "EN B")], "tmdb_id string, title string")
    got = sorted((tuple(r["profile"]), r["rank"], r["title"], r["hits"]) for r in rec_all.profile_winners(profiles, links, items, cache, "Movie").collect())
    assert got == [(("x",), 1, "A", 2), (("x",), 2, "EN B", 1), (("x", "y"), 1, "A", 2), (("x", "y"), 2, "EN B", 2), (("x", "y"), 3, "C", 1),
                   (("y",), 1, "EN B", 1), (("y",), 2, "C", 1)]


def test_top_k_is_limited_before_the_shuffle(spark):
    rows = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = rec_all.top_of(rows, ["k"], [F.col("id").asc()], params.TOP_TITLES)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Python" not in plan
