"""Benchmark decontamination: size-partitioned MinHash containment search.

A test item is found in a document when the document holds at least
``num/den`` of the item's distinct word shingles.  A long document hides a
short item from MinHash (their Jaccard similarity is tiny), so items are
partitioned by size and every partition looks at windows of its own size: items
of up to ``s`` shingles (``s`` = 16, 32, 64, ...) are searched in windows of
``2 * s`` shingles at steps of ``s``.  Any passage of ``s`` shingles lies in one
window, and with more than ``s / 2`` shingles its similarity to the window is
0.19 or more at containment 0.8, so that no one of :data:`HASHES` minima agrees
with probability 1.4e-6 at most.  Window minima are built once at 16 shingles
and joined upwards.  Items of up to :data:`TINY` shingles are looked up
shingle by shingle.  Every candidate is verified exactly on full shingle sets.

Documents are only read, never shuffled.  The items are the query set: they
reach the tasks in blocks of about :data:`ITEM_SHINGLES` shingles, one pass
over the documents per block.  With several blocks each pass is written before
the next block is read, so the driver holds one block (and no item is larger
than what one task can hold).

Items of fewer than five words (null or empty ones too) have no shingle and
match nothing, as do such documents.  A document without ``doc_id`` gives its
rows with a null id.  Repeated documents and items give their rows again.  Very
long texts are read whole.  Empty tables give no rows (``clean_documents``: an empty
benchmark keeps all).  Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import shingle_sql, written
from playlens.llm.textblocks import blocks, fmix64

SHINGLE_WORDS = 5
NUM, DEN = 80, 100
HASHES, BASE, TINY = 64, 16, 8
ITEM_SHINGLES = 1_000_000
PROBE_BITS = 18

SCHEMA = "doc_id long, item_id long, n_shingles long, n_shared long"


def _families() -> tuple[np.ndarray, np.ndarray]:
    seeds = fmix64(np.arange(101, 101 + 2 * HASHES, dtype=np.uint64))
    return (seeds[:HASHES] | np.uint64(1)).astype(np.uint32), seeds[HASHES:].astype(np.uint32)


def _hashed(x: np.ndarray, mult: np.uint32, add: np.uint32) -> np.ndarray:
    y = x * mult
    y += add
    y ^= y >> np.uint32(15)
    return y


def _item_sets(shingle_words: int):
    def run(batches):
        for batch in batches:
            for block in blocks(batch):
                values, first = block.distinct(*block.shingles(shingle_words, False))
                yield pa.RecordBatch.from_arrays(
                    [pc.cast(batch.column(0).slice(block.lo, block.n), pa.int64()), pa.array(np.diff(first)),
                     pa.array([values[first[i]:first[i + 1]].tobytes() for i in range(block.n)], pa.binary())],
                    ["item_id", "n", "shingles"])
    return run


class Probe:
    """One block of items, partitioned by size, ready to be looked up."""

    def __init__(self, ids: list, sets: list[np.ndarray]):
        self.ids, self.sets = ids, sets
        mult, add = _families()
        sizes = np.array([len(s) for s in sets])
        self.tiny = None
        small = np.flatnonzero((sizes > 0) & (sizes <= TINY))
        if len(small):
            values = np.concatenate([sets[i] for i in small])
            order = np.argsort(values, kind="stable")
            self.tiny = values[order], np.repeat(small, sizes[small])[order]
        self.levels: dict[int, list] = {}
        level = np.array([max(0, math.ceil(math.log2(max(n, 1) / BASE))) for n in sizes])
        for k in sorted(set(level[sizes > TINY].tolist())):
            own = np.flatnonzero((level == k) & (sizes > TINY))
            tables = []
            for i in range(HASHES):
                minima = np.array([_hashed((sets[j] >> np.uint64(32)).astype(np.uint32), mult[i], add[i]).min() for j in own])
                order = np.argsort(minima, kind="stable")
                flags = np.zeros(1 << PROBE_BITS, dtype=bool)
                flags[minima & np.uint32((1 << PROBE_BITS) - 1)] = True
                tables.append((flags, minima[order], own[order]))
            self.levels[k] = tables


def _expand(values, sorted_values, owners):
    """(position in values, owner) for every equal pair."""
    lo, hi = np.searchsorted(sorted_values, values, "left"), np.searchsorted(sorted_values, values, "right")
    n = hi - lo
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
    return np.repeat(np.arange(len(values)), n), owners[at]


def _candidates(probe: Probe, values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Distinct (text, item) pairs worth an exact look, as rows."""
    found = []
    counts = np.diff(first)
    text_of = np.repeat(np.arange(len(counts)), counts)
    if probe.tiny is not None:
        at, item = _expand(values, *probe.tiny)
        found.append(np.stack([text_of[at], item], axis=1))
    if probe.levels:
        mult, add = _families()
        x = (values >> np.uint64(32)).astype(np.uint32)
        n = -(-counts // BASE)
        starts = np.repeat(first[:-1], n) + BASE * (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
        minima = np.empty((HASHES, len(starts)), np.uint32)
        for i in range(HASHES):
            minima[i] = np.minimum.reduceat(_hashed(x, mult[i], add[i]), starts)
        mask = np.uint32((1 << PROBE_BITS) - 1)
        for k in range(max(probe.levels) + 1):
            if k:
                half, n = n, -(-n // 2)
                begin = np.cumsum(half) - half
                starts = np.repeat(begin, n) + 2 * (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
                minima = np.minimum.reduceat(minima, starts, axis=1)
            if k not in probe.levels:
                continue
            own = np.repeat(np.arange(len(n)), n)
            joined = minima.copy()
            pair = own[1:] == own[:-1]
            joined[:, :-1] = np.where(pair, np.minimum(minima[:, :-1], minima[:, 1:]), minima[:, :-1])
            for i, (flags, sorted_minima, items) in enumerate(probe.levels[k]):
                hit = np.flatnonzero(flags[joined[i] & mask])
                if len(hit):
                    at, item = _expand(joined[i][hit], sorted_minima, items)
                    found.append(np.stack([own[hit[at]], item], axis=1))
    return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)


def _hits(probe: Probe, block, shingle_words: int, num: int, den: int):
    """(text, item, shared) of every text of a block that holds an item, verified on full sets."""
    values, first = block.shingles(shingle_words, False)
    if not len(values):
        return
    known, known_text = {}, -1
    for text, item in _candidates(probe, values, first):
        if text != known_text:
            known, known_text = np.unique(values[first[text]:first[text + 1]]), text
        own = probe.sets[item]
        place = np.searchsorted(known, own)
        place[place == len(known)] = 0
        shared = int((known[place] == own).sum())
        if den * shared >= num * len(own):
            yield text, item, shared


def _search(probe: Probe, shingle_words: int, num: int, den: int):
    def run(batches):
        for batch in batches:
            ids = pc.cast(batch.column(0), pa.int64()).to_pylist()
            rows = [(ids[block.lo + text], probe.ids[item], len(probe.sets[item]), shared)
                    for block in blocks(batch) for text, item, shared in _hits(probe, block, shingle_words, num, den)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[c] for r in rows], pa.int64()) for c in range(4)],
                ["doc_id", "item_id", "n_shingles", "n_shared"])
    return run


def _without(probe: Probe, shingle_words: int, num: int, den: int):
    """The rows of each batch, all columns, that hold no item."""
    def run(batches):
        for batch in batches:
            keep = np.ones(batch.num_rows, dtype=bool)
            for block in blocks(batch):
                for text, _, _ in _hits(probe, block, shingle_words, num, den):
                    keep[block.lo + text] = False
            yield batch.filter(pa.array(keep))
    return run


def _probes(items: DataFrame, shingle_words: int):
    """(number of blocks, one Probe per block of items); a block is read when the one before is done with."""
    sets = written(items.select(items["item_id"].cast("long").alias("item_id"), items["text"])
                   .mapInArrow(_item_sets(shingle_words), "item_id long, n long, shingles binary").filter("n > 0"), "items")
    total = sets.agg(F.sum("n")).first()[0] or 0
    n_blocks = -(-total // ITEM_SHINGLES)
    sets = sets.withColumn("_b", F.pmod(F.xxhash64("item_id", "shingles"), F.lit(max(n_blocks, 1))))

    def read(b: int) -> Probe:
        block = sets.filter(F.col("_b") == b).select("item_id", "shingles").orderBy("item_id").collect()
        return Probe([r["item_id"] for r in block], [np.frombuffer(r["shingles"], np.uint64) for r in block])
    return n_blocks, (read(b) for b in range(n_blocks))


def contaminated(docs: DataFrame, items: DataFrame, num: int = NUM, den: int = DEN,
                 shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_shared, containment) of every document that holds an item."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    n_blocks, probes = _probes(items, shingle_words)
    out = None
    for probe in probes:
        hits = rows.mapInArrow(_search(probe, shingle_words, num, den), SCHEMA)
        if n_blocks > 1:        # written before the next block is read
            hits = written(hits, "hits")
        out = hits if out is None else out.unionByName(hits)
    if out is None:
        out = docs.sparkSession.createDataFrame([], SCHEMA)
    return out.withColumn("containment", F.col("n_shared") / F.col("n_shingles"))


def clean_documents(docs: DataFrame, items: DataFrame, num: int = NUM, den: int = DEN, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no item.

    Each row is judged by its own text in the map that verifies it: null and
    shared ids take no other row along, and nothing is joined.
    """
    n_blocks, probes = _probes(items, shingle_words)
    for probe in probes:
        docs = docs.mapInArrow(_without(probe, shingle_words, num, den), docs.schema)
        if n_blocks > 1:
            docs = written(docs, "clean")
    return docs


ORACLE_SQL = f"""
WITH item AS MATERIALIZED {shingle_sql("benchmark", "item_id", SHINGLE_WORDS, False)},
doc AS MATERIALIZED {shingle_sql("documents", "doc_id", SHINGLE_WORDS, False)},
sizes AS (SELECT id, count(*) AS n FROM item GROUP BY id),
hits AS (SELECT doc.id AS doc_id, item.id AS item_id, count(*) AS shared FROM item JOIN doc USING (s) GROUP BY ALL)
SELECT doc_id, item_id, n AS n_shingles, shared AS n_shared, shared / n AS containment
FROM hits JOIN sizes ON item_id = id WHERE {DEN} * shared >= {NUM} * n"""
