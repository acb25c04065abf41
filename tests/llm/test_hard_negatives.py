import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from playlens.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """Sorted result rows from all pairs, in whole numbers."""
    clean = {}
    for vec_id, v, label in rows:
        if vec_id is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        clean[vec_id] = (label, [math.floor(256 * float(np.float32(x))) for x in v])
    out = []
    for a, (label, v) in clean.items():
        if a % 100:
            continue
        score = {b: sum(x * y for x, y in zip(v, w)) for b, (_, w) in clean.items() if b != a}
        order = sorted(score, key=lambda b: (-score[b], b))
        for p in [b for b in order if clean[b][0] == label][:5]:
            fits = [b for b in order if clean[b][0] != label and 30 * score[p] <= 100 * score[b] <= 90 * score[p]]
            out += [(a, p, r + 1, b, score[p], score[b]) for r, b in enumerate(fits[:10])]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def clustered(n, width=8, labels=10, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, width))
    which = rng.integers(0, 6, n)
    return [(int(i), [float(x) for x in centres[which[i]] + rng.normal(size=width) * 0.1], int(rng.integers(0, labels))) for i in range(n)]


@pytest.fixture
def small(monkeypatch):
    for name, value in (("SPLIT_ROWS", 40), ("PAGE_ROWS", 64), ("ANCHORS", 4), ("LEAF", 8), ("WAYS", 4)):
        monkeypatch.setattr(hn, name, value)


def test_whole_table_matches_brute_force(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    assert got(hn.mine_hard_negatives(table)) == brute([tuple(r) for r in table.select("vec_id", "embedding", "label").collect()])


def test_small_nodes_and_pages_give_the_same(spark, small):
    rows = clustered(900)
    assert got(hn.mine_hard_negatives(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_awkward_rows(spark, small):
    rows = clustered(300, width=4) + [
        (300, None, 1), (400, [1.0, 2.0, 3.0, 4.0], None), (None, [1.0] * 4, 1), (500, [float("nan")] * 4, 1), (600, [float("inf")] * 4, 1),
        (601, [1.0, None, 1.0, 1.0], 1), (700, [], 2), (701, [0.0] * 4, 2), (800, [1.0, 1.0], 3), (801, [1.0] * 6, 3), (900, [-3.0] * 4, 4), (901, [3.0] * 4, 4)]
    rows += [(1000 + i, [2.0] * 4, i % 10) for i in range(120)]     # one very common vector, in ties
    rows += rows[:5]
    table = spark.createDataFrame(rows, SCHEMA)
    for name in ("score", "page", "vector", "part", "anchor_id"):
        table = table.withColumn(name, F.lit("x"))
    width = [(i, v and (v + [0.0] * 6)[:6], lab) if v is None or None not in v else (i, v, lab) for i, v, lab in rows]
    assert got(hn.mine_hard_negatives(table)) == brute(width)


def test_empty_and_null_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert hn.mine_hard_negatives(none).count() == 0
    assert hn.mine_hard_negatives(spark.createDataFrame([(None, None, None)] * 3, SCHEMA)).count() == 0
    assert hn.mine_hard_negatives(spark.createDataFrame([(100, [1.0], 1)], SCHEMA)).count() == 0
    assert hn.mine_hard_negatives(none).columns == hn.mine_hard_negatives(spark.createDataFrame([(100, [1.0], 1)], SCHEMA)).columns


def test_scores_that_do_not_fit_raise(spark):
    with pytest.raises(Exception, match="63 bits"):
        hn.mine_hard_negatives(spark.createDataFrame([(100, [3e30], 1), (101, [3e30], 1)], SCHEMA)).collect()
    assert hn.inner(np.array([[1 << 30]]), np.array([[1 << 30]]))[0, 0] == 1 << 60


def test_siblings_are_eliminated_and_nothing_is_missed():
    rows = clustered(6000, width=6, seed=5)
    x = np.floor(256 * np.array([r[1] for r in rows])).astype(np.int64)
    ids, labels = np.arange(len(x)), np.array([r[2] for r in rows])
    top = float((x * x).sum(1).max())
    q = x[:60]
    score = q @ x.T
    for same in (True, False):
        least, most = (np.full(60, hn.LEAST + 1), np.full(60, 1 << 62)) if same else (score.max(1) * 3 // 10, score.max(1) * 9 // 10)
        find = hn.Search(q, ids[:60], labels[:60], least, most, same, 5, top)
        find.tree(np.arange(60), x, ids, labels)
        for i in range(60):
            fits = (labels == labels[i]) == same
            fits &= (ids != i) & (score[i] >= least[i]) & (score[i] <= most[i])
            want = sorted(np.flatnonzero(fits), key=lambda b: (-score[i, b], b))[:5]
            assert find.ids[i][find.scores[i] != hn.LEAST].tolist() == want
        assert find.scored < 0.5 * score.size
