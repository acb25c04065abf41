import re

import pytest

from cases import awkward, empty, nothing, words
from playlens.llm import near_dedup as nd

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text, size=5):
    w = WORD.findall(lowered(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)])


def brute(rows, num=85, den=100):
    """doc_id -> (set size, component) from all pairs that share a shingle."""
    sets = {d: shingles(t) for d, t in rows}
    by = {}
    for d, s in sets.items():
        for x in s:
            by.setdefault(x, []).append(d)
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d
    pairs = {(a, b) for ds in by.values() for a in ds for b in ds if a < b}
    for a, b in pairs:
        shared = len(sets[a] & sets[b])
        if den * shared >= num * (len(sets[a]) + len(sets[b]) - shared):
            ra, rb = root(a), root(b)
            parent[max(ra, rb)] = min(ra, rb)
    return {d: (len(sets[d]), root(d)) for d in sets}


def test_matches_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    got = nd.near_duplicate_groups(docs).collect()
    assert len(got) == len(want)
    for r in got:
        assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
        assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_small_blocks_give_the_same_groups(spark, monkeypatch):
    base = words(5, 150).split()
    rows = [(i, " ".join(base[:i % 5 * 2] + ["x%d" % i] + base[i % 5 * 2 + 1:])) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    for size in (512, 8):
        monkeypatch.setattr(nd, "BLOCK_DOCS", size)
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in nd.near_duplicate_groups(docs).collect()}
        assert got == want


def test_awkward_rows(spark):
    got = nd.near_duplicate_groups(awkward(spark)).collect()
    assert len(got) == 15
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by[2]["component_id"] == 1 and by[3]["component_id"] == 1 and not by[3]["kept"]
    for d in (4, 5, 6):
        assert (by[d]["n_shingles"], by[d]["component_id"], by[d]["kept"]) == (0, d, True)
    assert by[7]["n_shingles"] == 1 and by[10]["component_id"] == 7
    assert [r["kept"] for r in got if r["doc_id"] == 9] == [True, True]
    assert all(r["component_id"] is None and not r["kept"] for r in got if r["doc_id"] is None)


def test_empty_tables(spark):
    assert nd.near_duplicate_groups(empty(spark)).count() == 0
    assert nd.near_duplicate_groups(nothing(spark)).count() == 3


def test_one_of_each_group_keeps_columns(spark):
    docs = awkward(spark)
    out = nd.one_of_each_group(docs)
    assert out.columns == docs.columns
    ids = sorted(str(r["doc_id"]) for r in out.collect())
    assert ids == sorted(["1", "4", "5", "6", "7", "8", "9", "11", "12", "None", "None"])


@pytest.mark.parametrize("hashes", [48, 192])
def test_pruning_bound(hashes):
    limits = nd.min_matches(0.85, hashes)
    assert limits == sorted(limits) and 0 < limits[0] <= nd.BATCH and limits[-1] < 0.85 * hashes


def test_a_member_repeated_many_times_stands_once_in_its_cell(spark):
    base = words(5, 120).split()
    rows = [(i, " ".join(base[:i] + ["x%d" % i] + base[i + 1:])) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    many = docs.filter("doc_id = 3").crossJoin(spark.range(20000).select("id")).drop("id")
    out = nd.near_duplicate_groups(docs.unionByName(many))
    want = brute(rows)
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]): r["count"] for r in out.groupBy("doc_id", "n_shingles", "component_id").count().collect()}
    assert got == {(d, n, c): 20001 if d == 3 else 1 for d, (n, c) in want.items()}
