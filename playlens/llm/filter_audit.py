"""Filter interaction audit: what each filter removes, in every order, and its Shapley share.

1. Every row gets one bit per failed filter.  The bits, a part (here the
   language) and marks (good, toxic) are counted: at most ``2**n`` groups a
   part for ``n`` filters, so all later steps work on tiny tables.
2. For every part the removals of all ``2**n`` coalitions of filters are
   tabulated: a coalition removes the rows that fail any of its filters.
3. The Shapley values are the solution of a constrained least squares problem:
   additive shares that fit the coalition removals best under the Shapley
   kernel ``(n-1) / (C(n,s) * s * (n-s))`` and add up to what all filters remove
   together.  Its normal equations are solved exactly, in rationals, once for
   all parts (the unknowns are linear in the removals), and the solution is
   applied to each part's table in whole numbers.
4. A step of an order counts differences of coalition removals: the rows
   removed here are those of the coalition after the step less those before.

``production_flags`` sets the five filters of the query.  Filter E needs the
smallest ``doc_id`` of each text in the whole table: texts are named by their
SHA-256, the smallest ids are aggregated (partially before the shuffle), and only
texts held twice or more are joined back, the frequent ones by broadcast and
the others by a shuffle, so no text's copies meet in one task.

Nulls: a null text is empty (it fails A alone, and E if a smaller id is empty
too); a null part is the empty string; a row without ``doc_id`` never fails E,
has no marks and is counted; a null flag or mark is false.  Very long texts are
read whole.  Rows repeating one id are counted each, and none fails E by the
other.  Several labels of an id: a mark holds if any of them has it.  An empty
table gives no rows.  Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from fractions import Fraction
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import WORD, join_spread, written

MIN_WORDS = 100
DISTINCT_PER_CENT = 80
CAPITALS_PER_CENT = 10
SYMBOLS = r"[#$%&*|]"
MAX_FILTERS = 6


def solve(matrix: list[list[Fraction]], right: list[list[Fraction]]) -> list[list[Fraction]]:
    """X of ``matrix @ X = right`` by elimination in rationals; the matrix is square and regular."""
    n = len(matrix)
    rows = [list(matrix[i]) + list(right[i]) for i in range(n)]
    for c in range(n):
        pivot = next(r for r in range(c, n) if rows[r][c])
        rows[c], rows[pivot] = rows[pivot], rows[c]
        rows[c] = [x / rows[c][c] for x in rows[c]]
        for r in range(n):
            if r != c and rows[r][c]:
                factor = rows[r][c]
                rows[r] = [x - factor * y for x, y in zip(rows[r], rows[c])]
    return [row[n:] for row in rows]


def shapley_coefficients(n: int) -> list[list[Fraction]]:
    """For each of ``n`` filters the weight of every coalition's removal in its Shapley value.

    Least squares over the coalitions that are neither empty nor whole, with the
    Shapley kernel as weights and the shares bound to the whole coalition's
    removal by a Lagrange multiplier.
    """
    whole = (1 << n) - 1
    matrix = [[Fraction(0)] * (n + 1) for _ in range(n + 1)]
    right = [[Fraction(0)] * (1 << n) for _ in range(n + 1)]
    for coalition in range(1, whole):
        s = coalition.bit_count()
        weight = Fraction(n - 1, math.comb(n, s) * s * (n - s))
        members = [i for i in range(n) if coalition >> i & 1]
        for i in members:
            right[i][coalition] += weight
            for j in members:
                matrix[i][j] += weight
    for i in range(n):
        matrix[i][n] = matrix[n][i] = Fraction(1)
    right[n][whole] = Fraction(1)
    if n == 1:
        return [[Fraction(0), Fraction(1)]]
    return solve(matrix, right)[:n]


def _dot(values: Column, weights: list[int]) -> Column:
    terms = F.zip_with(values, F.array(*[F.lit(w).cast("long") for w in weights]), lambda v, w: v * w)
    return F.aggregate(terms, F.lit(0).cast("long"), lambda total, x: total + x)


def audit(rows: DataFrame, part: Column, failed: Mapping[str, Column], marks: Mapping[str, Column],
          count: Column | None = None) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, <mark>_lost..., shapley).

    ``failed`` gives each filter's one-letter name and failure condition; ``count`` how
    many documents a row stands for.  One row per part, order and step.
    ``shapley`` is the filter's removals summed over all orders.
    """
    names = list(failed)
    n = len(names)
    if not 1 <= n <= MAX_FILTERS or any(len(name) != 1 for name in names):
        raise ValueError(f"1 to {MAX_FILTERS} filters with names of one letter")
    bits = sum((F.when(F.coalesce(c, F.lit(False)), F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(failed.values())), F.lit(0))
    weight = F.lit(1).cast("long") if count is None else count.cast("long")
    counted = rows.select(F.coalesce(part.cast("string"), F.lit("")).alias("part"), bits.alias("bits"), weight.alias("all"),
                          *[F.when(F.coalesce(c, F.lit(False)), weight).otherwise(F.lit(0)).alias(f"mark_{m}") for m, c in marks.items()])
    measures = ["all", *[f"mark_{m}" for m in marks]]
    tally = counted.groupBy("part", "bits").agg(*[F.sum(m).alias(m) for m in measures])
    removals = tally.groupBy("part").agg(F.sum("all").alias("total"), *[
        F.array(*[F.sum(F.when(F.col("bits").bitwiseAND(s) != 0, F.col(m)).otherwise(F.lit(0))) for s in range(1 << n)]).alias(m)
        for m in measures])
    orders = math.factorial(n)
    shares = []
    for row in shapley_coefficients(n):
        scaled = [x * orders for x in row]
        if any(x.denominator != 1 for x in scaled):
            raise ArithmeticError("a share summed over all orders is no whole number")
        shares.append(_dot(F.col("all"), [int(x) for x in scaled]))
    steps = (removals.withColumn("shares", F.array(*shares))
             .withColumn("filter_order", F.explode(F.array(*[F.lit("".join(p)) for p in permutations(names)])))
             .select("*", F.posexplode(F.split("filter_order", "")).alias("place", "letter"))
             .withColumn("at", F.array_position(F.array(*[F.lit(x) for x in names]), F.col("letter")).cast("int")))
    before = sum((F.when((F.locate(x, "filter_order") > 0) & (F.locate(x, "filter_order") <= F.col("place")), F.lit(1 << i)).otherwise(F.lit(0))
                  for i, x in enumerate(names)), F.lit(0))
    steps = steps.withColumn("before", before).withColumn("own", F.expr("shiftleft(1, at - 1)"))
    value = lambda m, coalition: F.element_at(F.col(m), coalition + 1)
    after, whole = F.col("before") + F.col("own"), F.lit((1 << n) - 1)
    here = lambda m: value(m, after) - value(m, F.col("before"))
    return steps.select(
        "part", "filter_order", (F.col("place") + 1).cast("int").alias("step"),
        (F.col("total") - value("all", after)).alias("kept"), here("all").alias("removed"),
        (value("all", F.col("own")) - here("all")).alias("redundant"),
        (value("all", whole) - value("all", whole - F.col("own"))).alias("unique_fails"),
        *[here(f"mark_{m}").alias(f"{m}_lost") for m in marks],
        F.element_at("shares", F.col("at")).alias("shapley"))


def production_flags(docs: DataFrame) -> DataFrame:
    """(doc_id, part, A, B, C, D, E) of every row of ``docs``."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = (docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["lang"].cast("string").alias("part"), text.alias("text"))
            .withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
            .withColumn("n_words", F.size("words").cast("long"))
            .select("doc_id", "part", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("name"),
                    (F.col("n_words") < MIN_WORDS).alias("A"),
                    (100 * F.size(F.array_distinct("words")).cast("long") < DISTINCT_PER_CENT * F.col("n_words")).alias("B"),
                    (100 * F.regexp_count("text", F.lit("[A-Z]")).cast("long") > CAPITALS_PER_CENT * F.length("text")).alias("C"),
                    F.col("text").rlike(SYMBOLS).alias("D")))
    rows = written(rows, "flags")
    held = written(rows.groupBy("name").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "texts")
    return join_spread(rows, held, "name").select(
        "doc_id", "part", "A", "B", "C", "D", F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).alias("E"))


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters over ``docs``, by language, with good and toxic documents lost."""
    flags = production_flags(docs)
    letters = ["A", "B", "C", "D", "E"]
    groups = flags.groupBy("doc_id", "part", *letters).agg(F.count(F.lit(1)).alias("n"))
    marks = (labels.select(labels["doc_id"].cast("long").alias("doc_id"), (labels["quality"] == 1).alias("good"), (labels["toxic"] == 1).alias("toxic"))
             .filter("doc_id is not null and (good or toxic)")
             .groupBy("doc_id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic")))
    rows = groups.join(marks, "doc_id", "left")
    return audit(rows, F.col("part"), {x: F.col(x) for x in letters}, {m: F.col(m) for m in ("good", "toxic")}, F.col("n"))


_FAILS = "((bits >> (ascii(f.letter) - 65)) & 1) = 1"
ORACLE_SQL = f"""
WITH docs AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
  regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
flags AS (SELECT doc_id, part, (len(w) < {MIN_WORDS})::INT + 2 * (100 * len(list_distinct(w)) < {DISTINCT_PER_CENT} * len(w))::INT
  + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {CAPITALS_PER_CENT} * length(t))::INT
  + 8 * regexp_matches(t, '{SYMBOLS}')::INT + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS bits FROM docs),
tally AS (SELECT part, bits, count(*) AS n,
  count(*) FILTER (doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL)) AS good,
  count(*) FILTER (doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL)) AS toxic FROM flags GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT filter_order, i::INT AS step, filter_order[i] AS letter,
  coalesce(list_sum([1 << (ascii(filter_order[j]) - 65) FOR j IN range(1, i)]), 0)::INT AS before FROM orders, range(1, 6) r(i)),
counts AS (SELECT part, filter_order, step, letter,
  coalesce(sum(n) FILTER ((bits & before) = 0 AND NOT {_FAILS}), 0)::BIGINT AS kept,
  coalesce(sum(n) FILTER ((bits & before) = 0 AND {_FAILS}), 0)::BIGINT AS removed,
  coalesce(sum(n) FILTER ((bits & before) <> 0 AND {_FAILS}), 0)::BIGINT AS redundant,
  coalesce(sum(n) FILTER (bits = 1 << (ascii(f.letter) - 65)), 0)::BIGINT AS unique_fails,
  coalesce(sum(good) FILTER ((bits & before) = 0 AND {_FAILS}), 0)::BIGINT AS good_lost,
  coalesce(sum(toxic) FILTER ((bits & before) = 0 AND {_FAILS}), 0)::BIGINT AS toxic_lost
  FROM tally, steps f GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM counts"""
