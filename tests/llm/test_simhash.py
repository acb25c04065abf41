import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from cases import awkward, empty, nothing, words
from playlens.llm import simhash as sh
from playlens.llm.textblocks import blocks

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fingerprint(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    spans = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in spans]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, radius=4):
    """Sorted (doc_id, fingerprint, component) from all pairs of fingerprints."""
    fps = [(d, fingerprint(t)) for d, t in rows]
    distinct = {f: min(d for d, g in fps if g == f and d is not None) for f in {f for d, f in fps if d is not None}}
    names = sorted(distinct, key=distinct.get)
    values = np.array(names, dtype=np.uint64)
    parent = list(range(len(names)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(names)):
        for j in np.flatnonzero(np.bitwise_count(values[:i] ^ values[i]) <= radius):
            a, b = root(i), root(int(j))
            parent[max(a, b)] = min(a, b)
    component = {f: distinct[names[root(i)]] for i, f in enumerate(names)}
    return sorted(((d, format(f, "016x"), component[f] if d is not None else None) for d, f in fps), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def near_texts(n):
    base = words(5, 400).split()
    return [(i, " ".join(base[:i % 9 * 3] + [f"x{i % 97}"] + base[i % 9 * 3 + 1:])) for i in range(n)]


def test_whole_table_matches_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert got(sh.simhash_groups(docs)) == brute([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])


@pytest.mark.parametrize("key_rows,cell_rows", [(4096, 16384), (4, 16384), (4096, 16), (8, 8)])
def test_keys_and_cells_do_not_change_the_groups(spark, key_rows, cell_rows):
    rows = near_texts(150) + [(1000 + i, words(i, 60)) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(sh.simhash_groups(docs, key_rows=key_rows, cell_rows=cell_rows)) == brute(rows)


def test_awkward_rows(spark):
    docs = awkward(spark).withColumn("fp", F.lit("x")).withColumn("t", F.lit("x")).withColumn("other", F.lit("x"))
    out = sh.simhash_groups(docs)
    assert got(out) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    by = {r["doc_id"]: r for r in out.collect()}
    assert by[4]["fingerprint"] == "0" * 16 and by[5]["component_id"] == by[6]["component_id"] == 4
    assert by[None]["component_id"] is None


def test_empty_and_null_tables(spark):
    assert sh.simhash_groups(empty(spark)).count() == 0
    assert got(sh.simhash_groups(nothing(spark))) == [(None, "0" * 16, None)] * 3


def test_many_copies_share_one_row(spark):
    docs = spark.range(20000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, F.lit("one two three four five")).otherwise(F.concat(F.lit("w"), "id")).alias("text"))
    rows = sh.simhash_groups(docs).groupBy("component_id").count().orderBy(F.col("count").desc()).limit(1).collect()
    assert tuple(rows[0]) == (1, 13333)


def test_hash_is_xxh64(spark):
    rng = np.random.default_rng(3)
    spans = [rng.bytes(int(n)) for n in rng.integers(0, 200, 500)]
    data = np.frombuffer(b"".join(spans) + b"\0" * 8, np.uint8)
    edge = np.cumsum([0] + [len(s) for s in spans])
    assert [int(h) for h in sh.xxh64(data, edge[:-1], edge[1:])] == [xxhash.xxh64_intdigest(s, 42) for s in spans]
    texts = ["abc", "é" * 30, "a b c d"]
    raw = [t.encode() for t in texts]
    edge = np.cumsum([0] + [len(s) for s in raw])
    mine = sh.xxh64(np.frombuffer(b"".join(raw) + b"\0" * 8, np.uint8), edge[:-1], edge[1:]).view(np.int64).tolist()
    assert mine == [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(F.xxhash64("t")).collect()]


def test_slices_of_long_texts_add_up(monkeypatch):
    texts = [words(1, 500), "", words(2, 3), words(3, 90)]
    batch = pa.RecordBatch.from_pydict({"text": texts})
    want = [fingerprint(t) for t in texts]
    for size in (1 << 15, 64, 7):
        monkeypatch.setattr(sh, "SLICE", size)
        assert [int(x) for b in blocks(batch) for x in sh.fingerprints(b)] == want


@pytest.mark.parametrize("radius", [0, 1, 4, 7])
def test_bit_sliced_distances_are_exact(radius):
    rng = np.random.default_rng(7)
    values = rng.integers(0, 1 << 63, 700, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 10), replace=False)) for _ in range(400)], dtype=np.uint64)
    values[200:600] = values[0] ^ flips
    q, m = sh.near(values[:250], sh.planes_of(values), radius)
    want = np.argwhere(np.bitwise_count(values[:250, None] ^ values[None, :]) <= radius)
    assert sorted((int(a), int(b)) for a, b in zip(q, m) if b < 700) == [tuple(map(int, x)) for x in want]


def test_tables_miss_no_pair():
    rng = np.random.default_rng(11)
    for n in (10, 5000, 10 ** 6, 10 ** 9, 10 ** 11):
        masks = sh.tables(n)
        for _ in range(300):
            flip = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
            assert any(not flip & m for m in masks)
        assert len(masks) <= 70
