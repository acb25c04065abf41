"""MinHash near-duplicate groups with sequential Bayesian verification.

1. Every text becomes its set of distinct word-shingle hashes, a MinHash
   signature and band keys (one numpy pass per block of texts).  Texts with
   equal sets collapse to one representative before anything is compared.
2. Representatives that share a band key are chained into candidate clusters:
   each band bucket gives one edge per member to its smallest member, never
   all pairs.
3. A cluster is compared in cells.  Its members are dealt to blocks of bounded
   size, and a cell holds two blocks, so a cluster of any size is spread over
   many tasks.  In a cell only pairs that share a band are looked at.  Their
   signatures are compared in batches; after each batch a pair is dropped when
   the posterior probability that its similarity reaches the threshold falls
   below ``miss``.  Survivors are verified on the full sets, strongest first,
   and a pair already joined by verified links is skipped.  A cell returns at
   most one link per member.  A cluster of ``m`` different texts has about
   ``(m / 512)**2 / 2`` cells; copies cost none.
4. Connected components of the verified links, spread back over the copies.

A pair at similarity ``t`` shares no band with probability
``(1 - t**rows)**bands`` (3e-7 at 0.85 with 32 bands of 6) and is pruned with
probability ``miss`` per batch at most.

Nulls and texts without words give an empty set: a group of their own, linked
with nothing.  A null ``doc_id`` cannot be linked or grouped: such a row keeps
a null component and is not kept.  Repeated rows of one ``doc_id`` all come
back, each judged by its own text.  Very long texts are hashed whole.  An empty table
gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import bounded, connected_components, shingle_sql, written
from playlens.llm.textblocks import blocks, fmix64

SHINGLE_WORDS = 5
BANDS, ROWS = 32, 6
BATCH = 16
MISS = 1e-5
BLOCK_DOCS, BLOCK_SHINGLES = 512, 1 << 20


def min_matches(threshold: float, hashes: int, batch: int = BATCH, miss: float = MISS) -> list[int]:
    """Fewest matches after each batch at which P(similarity >= threshold) is still >= ``miss``.

    The prior of the similarity is uniform, so the posterior after ``m`` matches of
    ``n`` is Beta(m + 1, n - m + 1); its upper tail is the binomial sum
    P(Bin(n + 1, threshold) <= m).
    """
    out = []
    for n in range(batch, hashes + 1, batch):
        tail, m = 0.0, -1
        while m < n:
            term = math.comb(n + 1, m + 1) * threshold ** (m + 1) * (1 - threshold) ** (n - m)
            if tail + term >= miss:
                break
            tail, m = tail + term, m + 1
        out.append(m + 1)
    return out


def _hash_family(hashes: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = fmix64(np.arange(1, 2 * hashes + 1, dtype=np.uint64))
    return (seeds[:hashes] | np.uint64(1)).astype(np.uint32), seeds[hashes:].astype(np.uint32)


def _signatures(values: np.ndarray, first: np.ndarray, hashes: int) -> np.ndarray:
    """Low 16 bits of each mixed minimum; texts without shingles get zeros."""
    mult, add = _hash_family(hashes)
    x = (values >> np.uint64(32)).astype(np.uint32)
    out = np.zeros((len(first) - 1, hashes), dtype=np.uint32)
    full = np.flatnonzero(np.diff(first) > 0)
    if len(full):
        at = first[full]
        for i in range(hashes):
            y = x * mult[i]
            y += add[i]
            y ^= y >> np.uint32(15)
            y *= np.uint32(0x2C1B3C6D)
            out[full, i] = np.minimum.reduceat(y, at)
        out = (out * np.uint32(0x85EBCA6B)) >> np.uint32(16)
    return out.astype(np.uint16)


def _band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.empty((len(sig), bands), dtype=np.int64)
    for b in range(bands):
        h = np.full(len(sig), np.uint64(b + 1))
        for r in range(rows):
            h = h * np.uint64(0xD6E8FEB86659FD93) + sig[:, b * rows + r] + np.uint64(1)
        keys[:, b] = fmix64(h).view(np.int64)
    return keys


def _set_hashes(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that name each set, whatever the order of its members."""
    out, mixed = [], values + np.uint64(0x1234567)
    for _ in range(2):
        mixed = fmix64(mixed)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
        out.append((sums[first[1:]] - sums[first[:-1]]).view(np.int64))
    return out[0], out[1]


def _set_rows(shingle_words: int, hashes: int):
    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for block in blocks(batch):
                values, first = block.distinct(*block.shingles(shingle_words, True))
                sig = _signatures(values, first, hashes)
                hi, lo = _set_hashes(values, first)
                yield pa.RecordBatch.from_arrays([
                    ids.slice(block.lo, block.n).cast(pa.int64()),
                    pa.array(np.diff(first)),
                    pa.array(hi), pa.array(lo),
                    pa.array([s.tobytes() for s in sig], pa.binary()),
                ], ["doc_id", "n_shingles", "set_hi", "set_lo", "sig"])
    return run


def _bands(bands: int, rows: int):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(batch.num_rows, -1)
            keys = _band_keys(sig, bands, rows)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(batch.column(0).to_numpy(zero_copy_only=False), bands)), pa.array(keys.ravel()),
            ], ["rep", "band"])
    return run


def _full_sets(shingle_words: int):
    def run(batches):
        for batch in batches:
            for block in blocks(batch):
                values, first = block.distinct(*block.shingles(shingle_words, True))
                hi, lo = _set_hashes(values, first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(block.lo, block.n), pa.array(hi), pa.array(lo),
                     pa.array([values[first[i]:first[i + 1]].tobytes() for i in range(block.n)], pa.binary())],
                    ["rep", "set_hi", "set_lo", "shingles"])
    return run


def _compare(sets, sig, keys, ids, left, right, num, den, limits):
    """Links found between ``left`` and ``right`` members (positions); a member once at most per join."""
    parent = np.arange(len(ids))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    same_side = left is right
    found_x, found_y, found_m = [], [], []
    for p, x in enumerate(left):
        others = right[p + 1:] if same_side else right
        others = others[(den * np.minimum(sizes[others], sizes[x]) >= num * np.maximum(sizes[others], sizes[x]))
                        & (sizes[others] > 0)]
        if sizes[x] == 0 or not len(others):
            continue
        others = others[(keys[others] == keys[x]).any(axis=1)]
        matches = np.zeros(len(others), dtype=np.int64)
        for k, least in enumerate(limits):
            if not len(others):
                break
            cut = slice(k * BATCH, (k + 1) * BATCH)
            matches += (sig[others, cut] == sig[x, cut]).sum(axis=1)
            stay = matches >= least
            others, matches = others[stay], matches[stay]
        found_x.append(np.full(len(others), x))
        found_y.append(others)
        found_m.append(matches)
    if not found_x:
        return []
    xs, ys, ms = np.concatenate(found_x), np.concatenate(found_y), np.concatenate(found_m)
    links = []
    for at in np.argsort(-ms, kind="stable"):
        x, y = xs[at], ys[at]
        rx, ry = root(x), root(y)
        if rx == ry:
            continue
        small, large = (sets[x], sets[y]) if sizes[x] < sizes[y] else (sets[y], sets[x])
        place = np.searchsorted(large, small)
        place[place == len(large)] = 0
        shared = int((large[place] == small).sum())
        if den * shared >= num * (sizes[x] + sizes[y] - shared):
            parent[max(rx, ry)] = min(rx, ry)
            links.append((int(ids[x]), int(ids[y])))
    return links


def _cells(num: int, den: int, bands: int, rows: int):
    def run(key, table):
        ids = table.column("rep").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        block = table.column("block").to_numpy()[order]
        i, j = key[1].as_py(), key[2].as_py()
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint16).reshape(len(ids), -1)[order]
        raw = table.column("shingles").to_pylist()
        sets = [np.frombuffer(raw[k], np.uint64) for k in order]
        keys = _band_keys(sig, bands, rows)
        limits = min_matches(num / den, bands * rows)
        left = np.flatnonzero(block == i)
        right = left if i == j else np.flatnonzero(block == j)
        links = _compare(sets, sig, keys, ids, left, right, num, den, limits)
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()),
                         "b": pa.array([y for _, y in links], pa.int64())})
    return run


def near_duplicate_groups(docs: DataFrame, num: int = 85, den: int = 100, shingle_words: int = SHINGLE_WORDS,
                          bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of documents linked at similarity >= num/den."""
    base = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    sets = written(base.mapInArrow(_set_rows(shingle_words, bands * rows),
                                   "doc_id long, n_shingles long, set_hi long, set_lo long, sig binary"), "sets")
    key = ["n_shingles", "set_hi", "set_lo"]
    full = sets.filter("n_shingles > 0 and doc_id is not null")
    ids = full.groupBy(*key).agg(F.min("doc_id").alias("rep"))
    # one row of each representative, with the number of rows that repeat it
    reps = written(full.join(ids, key).filter("doc_id = rep").groupBy("rep", *key).agg(F.first("sig").alias("sig"), F.count(F.lit(1)).alias("rows")), "reps")
    repeated = not reps.filter("rows > 1").isEmpty()
    reps = reps.drop("rows")
    buckets = reps.select("rep", "sig").mapInArrow(_bands(bands, rows), "rep long, band long")
    least = buckets.groupBy("band").agg(F.min("rep").alias("low"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    stars = buckets.join(least, "band").filter("rep > low").select(F.col("rep").alias("a"), F.col("low").alias("b"))
    clusters = written(connected_components(stars).withColumnRenamed("node", "rep"), "clusters")
    members = clusters.join(reps, "rep")
    width = members.groupBy("component").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_DOCS), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).alias("n_blocks"))
    texts = (base.join(clusters.select(F.col("rep").alias("doc_id")), "doc_id")
             .select(F.col("doc_id").alias("rep"), "text")
             .mapInArrow(_full_sets(shingle_words), "rep long, set_hi long, set_lo long, shingles binary"))
    if repeated:        # a cell holds a document once, however often its row is repeated
        texts = texts.dropDuplicates(["rep", "set_hi", "set_lo"])
    dealt = (members.join(width, "component").join(texts, ["rep", "set_hi", "set_lo"])
             .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("n_blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks").cast("int") - 1)))
             .select("rep", "sig", "shingles", "block", "component",
                     F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")))
    links = dealt.groupBy("component", "i", "j").applyInArrow(_cells(num, den, bands, rows), "a long, b long")
    groups = connected_components(links).select(F.col("node").alias("rep"), "component")
    labelled = ids.join(groups, "rep", "left").select(*key, F.coalesce("component", "rep").alias("component_id"))
    out = sets.drop("sig").join(labelled, key, "left")
    component = F.when(F.col("n_shingles") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component_id"))).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def one_of_each_group(docs: DataFrame, **options) -> DataFrame:
    """``docs``, all columns, with one document of every near-duplicate group.

    A document goes when none of its rows is kept; rows without ``doc_id`` stay.
    Equal rows of one id become one.
    """
    groups = written(near_duplicate_groups(docs, **options), "groups")
    per_id = groups.filter("doc_id is not null").groupBy("doc_id").agg(F.max("kept").alias("k"), F.count(F.lit(1)).alias("n"))
    gone = written(per_id.filter("not k").select(F.col("doc_id").alias("_gone")), "gone")
    out = docs.join(bounded(gone), docs["doc_id"].cast("long") == gone["_gone"], "left_anti")
    repeated = per_id.filter("k and n > 1").select(F.col("doc_id").alias("_again"))
    if repeated.isEmpty():
        return out
    again = out["doc_id"].cast("long") == repeated["_again"]
    return out.join(repeated, again, "left_anti").unionByName(out.join(repeated, again, "left_semi").distinct())


ORACLE_SQL = f"""
WITH RECURSIVE sh AS MATERIALIZED {shingle_sql("documents", "doc_id", SHINGLE_WORDS, True)},
sizes AS (SELECT id, count(*) AS n FROM sh GROUP BY id),
pairs AS (SELECT a.id AS a, b.id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.id <> b.id GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM pairs JOIN sizes x ON a = x.id JOIN sizes y ON b = y.id
  WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a, min(b) AS low FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id,
  doc_id = least(doc_id, coalesce(low, doc_id)) AS kept
FROM documents LEFT JOIN sizes ON doc_id = id LEFT JOIN least ON doc_id = a"""
