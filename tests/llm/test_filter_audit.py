import re
from fractions import Fraction
from itertools import permutations
from math import factorial

import pytest
from pyspark.sql import functions as F

from cases import LABEL, awkward, empty, nothing
from playlens.llm import filter_audit as fa

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, labels):
    """{(part, order, step): counts} by applying the filters to the rows one after the other."""
    first, marks = {}, {}
    for r in rows:
        if r["doc_id"] is not None:
            t = r["text"] or ""
            first[t] = min(first.get(t, r["doc_id"]), r["doc_id"])
    for d, quality, toxic in labels:
        if d is not None:
            g, t = marks.get(d, (False, False))
            marks[d] = (g or quality == 1, t or toxic == 1)
    docs = []
    for r in rows:
        t = r["text"] or ""
        w = WORD.findall(t)
        fails = set()
        if len(w) < 100:
            fails.add("A")
        if 100 * len(set(w)) < 80 * len(w):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 10 * len(t):
            fails.add("C")
        if re.search(r"[#$%&*|]", t):
            fails.add("D")
        if r["doc_id"] is not None and t in first and r["doc_id"] > first[t]:
            fails.add("E")
        docs.append((r["lang"] or "", fails, *marks.get(r["doc_id"], (False, False))))
    out, shapley = {}, {}
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        for order in permutations("ABCDE"):
            left = own
            for k, f in enumerate(order):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[part, f] = shapley.get((part, f), 0) + len(gone)
                out[part, "".join(order), k + 1] = (
                    len(left), len(gone), sum(f in d[1] for d in own) - len(gone), sum(d[1] == {f} for d in own),
                    sum(d[2] for d in gone), sum(d[3] for d in gone))
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def as_dict(df):
    rows = df.collect()
    out = {tuple(r[:3]): tuple(r[3:]) for r in rows}
    assert len(out) == len(rows)
    return out


def label_rows(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 1, None), (9, None, 1), (None, 1, 1), (77, 1, 1), (8, 1, 1)], LABEL)


def test_awkward_rows_match_brute_force(spark):
    docs, labels = awkward(spark).withColumn("bits", F.lit("x")).withColumn("A", F.lit("x")).withColumn("first", F.lit("x")), label_rows(spark)
    docs = docs.unionByName(docs.limit(3).withColumn("text", F.lit("LOUD #1 " * 60)).withColumn("doc_id", F.col("doc_id") + 100))
    docs = docs.unionByName(docs.limit(2).withColumn("lang", F.lit(None).cast("string")))
    want = brute(docs.collect(), [tuple(r) for r in labels.collect()])
    assert as_dict(fa.audit_documents(docs, labels)) == want


def test_whole_table_matches_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    want = brute(docs.collect(), [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()])
    assert as_dict(fa.audit_documents(docs, labels)) == want


def test_empty_and_null_tables(spark):
    none = spark.createDataFrame([], LABEL)
    assert fa.audit_documents(empty(spark), none).count() == 0
    got = as_dict(fa.audit_documents(nothing(spark), none))
    assert len(got) == 600 and got["", "ABCDE", 1] == (0, 3, 0, 3, 0, 0, 360)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 6])
def test_least_squares_gives_shapley(n):
    got = fa.shapley_coefficients(n)
    for i in range(n):
        want = [Fraction(0)] * (1 << n)
        for s in range(1 << n):
            if s >> i & 1:
                share = Fraction(factorial(s.bit_count() - 1) * factorial(n - s.bit_count()), factorial(n))
                want[s] += share
                want[s ^ 1 << i] -= share
        assert [x - y for x, y in zip(got[i], want)][1:] == [0] * ((1 << n) - 1)


def test_other_filters_and_marks(spark):
    rows = spark.createDataFrame([("a", 1, None, True), ("a", 5, True, False), (None, 9, False, None)], "p string, x int, y boolean, m boolean")
    got = as_dict(fa.audit(rows, F.col("p"), {"X": F.col("x") > 3, "Y": F.col("y")}, {"m": F.col("m")}))
    assert got["a", "XY", 1] == (1, 1, 0, 0, 0, 1) and got["a", "XY", 2] == (1, 0, 1, 0, 0, 1)
    assert got["", "YX", 2] == (0, 1, 0, 1, 0, 2)
    with pytest.raises(ValueError):
        fa.audit(rows, F.col("p"), {"long": F.col("y")}, {})


def test_join_spread_by_broadcast_and_shuffle(spark):
    from playlens.llm.common import join_spread
    rows = spark.createDataFrame([(k % 7 if k % 3 else 0, k) for k in range(200)] + [(None, -1)], "key long, v long")
    table = rows.filter("key < 5").groupBy("key").count().withColumnRenamed("count", "n")
    want = sorted(map(str, rows.join(table, "key", "left").collect()))
    for limit, hot in ((100, 10), (2, 30), (0, 1000)):
        assert sorted(map(str, join_spread(rows, table, "key", limit=limit, hot=hot).collect())) == want
