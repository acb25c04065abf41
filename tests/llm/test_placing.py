import hashlib
import math
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from cases import awkward, empty, nothing
from playlens.llm import licenses as lc
from playlens.llm import mixing as mx
from playlens.llm import sharding as sh


def test_sharding_matches_brute_force(spark):
    docs = awkward(spark)
    rows = docs.collect()
    got = sh.shard_documents(docs).collect()
    assert len(got) == len(rows)

    def score(key, j):
        u = (int(hashlib.md5(f"{key}/{j}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        return -math.log(u)
    for r in got:
        key = "null" if r["doc_id"] is None else r["doc_id"]
        best = min(range(16), key=lambda j: score(key, j))
        assert r["shard"] == best and r["grown_shard"] == (16 if score(key, 16) < score(key, best) else best)
    want = Counter((r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    for j in {r["shard"] for r in got}:
        assert sorted(r["slot"] for r in got if r["shard"] == j) == list(range(sum(r["shard"] == j for r in got)))


def test_sharding_weights_growth_and_parts(spark, monkeypatch):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    monkeypatch.setattr(sh, "PART_ROWS", 100)
    got = sh.shard_documents(docs, shards=((0, 1.0), (1, 2.0), (2, 1.0)), new_weight=1.0).collect()
    share = Counter(r["shard"] for r in got)
    assert abs(share[1] / 6000 - 0.5) < 0.03
    moved = [r for r in got if r["shard"] != r["grown_shard"]]
    assert {r["grown_shard"] for r in moved} == {3} and abs(len(moved) / 6000 - 0.2) < 0.03
    for j in share:
        assert sorted(r["slot"] for r in got if r["shard"] == j) == list(range(share[j]))
    assert sh.shard_documents(empty(spark)).count() == 0
    assert sh.shard_documents(nothing(spark)).count() == 3


def water_fill(sizes):
    """The capped targets by repeated resharing."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(names)}
    left, open_, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > 2 * sizes[s]}
        if not over:
            return target | {s: left * weight[s] / total for s in open_}
        for s in over:
            target[s] = 2.0 * sizes[s]
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


def check_mix(rows, got):
    words = re.compile(r"[^\x20\x09-\x0D]+")
    sizes = Counter()
    for r in rows:
        sizes[r["source"]] += len(words.findall(r["text"] or ""))
    target = water_fill(sizes)
    assert len(got) == len(rows)
    for s in sizes:
        own = [r for r in got if r["source"] == s]
        assert all(r["source_size"] == sizes[s] and abs(r["target"] - target[s]) <= 1e-6 * max(1, target[s]) for r in own)
        assert all(0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"] for r in own)
    return sizes, target


def test_mixing_reaches_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = mx.mix_documents(docs).collect()
    sizes, target = check_mix(docs.collect(), got)
    for s in sizes:
        taken = sum(r["taken"] for r in got if r["source"] == s)
        assert abs(taken - target[s]) <= 0.01 * target[s]
        # rates solve the dual: an exponential tilt that meets the target
        rated = [(r["rate"], r["size"]) for r in got if r["source"] == s and r["size"]]
        assert abs(sum(x * n for x, n in rated) - target[s]) <= 1e-6 * target[s]
        slopes = {round(math.log(x) / n, 9) for x, n in rated if x < 2}
        assert len(slopes) <= 1 or max(slopes) - min(slopes) < 1e-7
    again = sorted((r["doc_id"], r["copies"]) for r in mx.mix_documents(docs.repartition(7)).collect())
    assert again == sorted((r["doc_id"], r["copies"]) for r in got)


def test_mixing_awkward(spark, monkeypatch):
    docs = awkward(spark)
    got = mx.mix_documents(docs).collect()
    check_mix(docs.collect(), got)
    out = mx.mixed_documents(docs)
    assert out.columns == docs.columns and out.count() == sum(r["copies"] for r in got)
    assert mx.mix_documents(empty(spark)).count() == 0
    assert mx.mixed_documents(empty(spark)).count() == 0
    assert [r["taken"] for r in mx.mix_documents(nothing(spark)).collect()] == [0] * 3
    monkeypatch.setattr(mx, "PART_DOCS", 3)
    same = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"),
                                   F.when(F.col("id") < 100, "a").otherwise("b").alias("source"))
    check_mix(same.collect(), mx.mix_documents(same).collect())


def license_rows(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, path string, text string")


def test_license_inheritance(spark):
    rows = [
        (1, "r/LICENSE", "Released under the MIT License."), (2, "r/a/x.txt", "plain words"),
        (3, "r/a/b/LICENSE.md", "Licensed under the Apache License, Version 2.0.\nmore"), (4, "r/a/b/c/y.txt", "plain"),
        (5, "r/a/z.txt", "some text\nLicensed under CC BY-NC 4.0.\nsome text"), (6, "s/w.txt", None), (7, None, "All rights reserved."),
        (8, "r/a/b/v.txt", ""), (9, "top.txt", "nothing"), (10, "r/a/b/c/y.txt", "plain"), (11, "rr/q.txt", "x")]
    got = {r["doc_id"]: r for r in lc.scan_licenses(license_rows(spark, rows)).collect()}
    assert len(got) == 11
    want = {1: "MIT", 2: "MIT", 3: "Apache-2.0", 4: "Apache-2.0", 5: "CC-BY-NC-4.0", 6: None, 7: "all-rights-reserved",
            8: "Apache-2.0", 9: None, 10: "Apache-2.0", 11: None}
    assert {d: r["license"] for d, r in got.items()} == want
    assert got[5]["line_no"] == 1 and got[5]["inherited_license"] == "MIT" and got[2]["license_dir"] == "r"
    assert got[4]["license_dir"] == "r/a/b" and got[6]["own_license"] is None


def test_license_prefilter_loses_nothing(spark):
    """Every line of the documents, weighed in plain Python."""
    files = lc.document_paths(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    rows = files.collect()
    vocabulary = {t for _, w in lc.TEMPLATES for t in lc.terms_of(w)}
    df = Counter(t for r in rows for t in set(lc.terms_of(r["text"])) & vocabulary)
    weights = lc.Weights(lc.TEMPLATES, len(rows), df)
    want = {}
    for r in rows:
        best = (0, 0, 0)
        for n, line in enumerate(r["text"].split("\n")):
            w = {t: c * weights.idf.get(t, weights.unseen) for t, c in Counter(lc.terms_of(line)).items()}
            norm = math.sqrt(sum(x * x for x in w.values())) or 1
            for k, (v, size) in enumerate(zip(weights.vectors, weights.norms)):
                best = max(best, (round(sum(w.get(t, 0) * x for t, x in v.items()) / norm / size, lc.DIGITS), -k, -n))
        if best[0] >= lc.THRESHOLD:
            want[r["doc_id"]] = lc.TEMPLATES[-best[1]][0], -best[2]
    got = {r["doc_id"]: (r["own_license"], r["line_no"]) for r in lc.scan_licenses(files).collect() if r["own_license"]}
    assert got == want and want


def test_license_awkward(spark):
    assert lc.scan_licenses(lc.document_paths(awkward(spark))).count() == 15
    assert lc.scan_licenses(lc.document_paths(empty(spark))).count() == 0
    assert lc.scan_licenses(lc.document_paths(nothing(spark))).count() == 3
