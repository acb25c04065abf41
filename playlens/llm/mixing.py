"""Mixing sources to target weights by entropy balancing.

Document rates stay as close to 1 (in relative entropy) as the token targets
allow: with ``x`` the size over its source's mean size, the optimum is the
exponential tilt ``rate = min(cap, exp(lam * x))`` with one dual variable
``lam`` per source.  The convex dual is solved by Newton steps inside a
bracket, all sources at once, one distributed aggregation per step over the
counts of (source, size); a source whose target is its cap takes every
document at the cap.

Rates become whole copies by systematic rounding: along the sizes of a source
the running sum of rates is rounded, so every prefix is within one copy of its
rate.  What the rounding leaves of a source's target is then made up with
copies of its smallest documents.  Inside a (source, size) cell the copies go
round in hash order; a cell is cut into parts of about :data:`PART_DOCS`
documents, so no task holds a source or a size.

Null or wordless texts have size 0 and rate 1.  A null source is a source of
its own, after all others.  Very long texts count by their words.  An empty table
gives no rows.  Repeated rows of one document share its copies
evenly.  Other columns are ignored.  Reruns give the same copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playlens.llm.common import WORD, bounded, written

WEIGHTS = (5.0, 2.0, 1.0)
TOTAL_SHARE = 1.5
CAP = 2
TOLERANCE = 1e-9
STEPS = 80
PART_DOCS = 20_000


def targets(units: DataFrame, weights=WEIGHTS, share: float = TOTAL_SHARE, cap: int = CAP) -> DataFrame:
    """(source, sid, source_size, n_docs, target): weighted shares of the total, capped, excess reshared.

    One row per source; the shares come from prefix sums over the sources in
    the order in which they would reach their cap.
    """
    src = units.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    src = src.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    table = F.array(*[F.lit(float(w)) for w in weights])
    src = src.withColumn("_w", F.element_at(table, (F.col("sid") % len(weights) + 1).cast("int")))
    limit = F.lit(float(cap)) * F.col("source_size")
    ratio = limit / F.col("_w")
    order = Window.orderBy("_ratio", "sid")
    every = Window.partitionBy()
    src = (src.withColumn("_ratio", ratio)
           .withColumn("_total", F.sum("source_size").over(every) * F.lit(share))
           .withColumn("_capped", F.coalesce(F.sum(limit).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
           .withColumn("_left", F.sum("_w").over(order.rowsBetween(0, Window.unboundedFollowing)))
           .withColumn("_level", (F.col("_total") - F.col("_capped")) / F.col("_left"))
           .withColumn("_pos", F.row_number().over(order)))
    fits = F.when(F.col("_level") <= F.col("_ratio"), F.col("_pos"))
    level = F.min_by(F.col("_level"), fits).over(every)
    return src.select("source", "sid", "source_size", "n_docs",
                      F.least(limit, F.coalesce(level, F.col("_ratio")) * F.col("_w")).alias("target"))


def _solve(hist: DataFrame, sources: DataFrame, cap: int) -> DataFrame:
    """(sid, lam, scale, full) with the dual variables at their optimum."""
    start = sources.select(
        "sid", "target", (F.col("source_size") / F.col("n_docs")).alias("scale"),
        (F.col("target") >= cap * F.col("source_size") * (1 - 1e-12)).alias("full"),
        F.lit(0.0).alias("lam"), F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"))
    state = written(start, "dual")
    active = state.filter("not full and target > 0")
    x = F.col("size") / F.col("scale")
    tilt = F.exp(F.least(F.col("lam") * x, F.lit(50.0)))
    for _ in range(STEPS):
        moments = (hist.filter("size > 0").join(active, "sid").groupBy("sid").agg(
            F.sum(F.col("n") * F.least(tilt, F.lit(float(cap))) * F.col("size")).alias("_f"),
            F.sum(F.when(tilt < cap, F.col("n") * tilt * F.col("size") * x).otherwise(0.0)).alias("_h")))
        gap = F.col("_f") - F.col("target")
        lo, hi = F.when(gap <= 0, F.col("lam")).otherwise(F.col("lo")), F.when(gap >= 0, F.col("lam")).otherwise(F.col("hi"))
        middle = F.when(F.col("_lo").isNull(), F.col("_hi") * 2 - 1).when(F.col("_hi").isNull(), F.col("_lo") * 2 + 1).otherwise(
            (F.col("_lo") + F.col("_hi")) / 2)
        newton = F.col("lam") - gap / F.col("_h")
        inside = (F.col("_h") > 0) & (F.coalesce(newton > F.col("_lo"), F.lit(True))) & (F.coalesce(newton < F.col("_hi"), F.lit(True)))
        near = F.abs(gap) <= TOLERANCE * F.col("target")
        active = written(
            active.join(moments, "sid").withColumn("_lo", lo).withColumn("_hi", hi).withColumn("done", near)
            .withColumn("lam", F.when(near, F.col("lam")).when(inside, newton).otherwise(middle))
            .select("sid", "target", "scale", "full", "lam", F.col("_lo").alias("lo"), F.col("_hi").alias("hi"), "done"), "dual")
        if active.filter("not done").isEmpty():
            break
        active = active.drop("done")
    return (state.select("sid", "scale", "full").join(active.select("sid", "lam"), "sid", "left")
            .withColumn("lam", F.coalesce("lam", F.lit(0.0))))


def mix_documents(docs: DataFrame, weights=WEIGHTS, share: float = TOTAL_SHARE, cap: int = CAP) -> DataFrame:
    """(doc_id, source, size, source_size, target, rate, copies, taken) of every row."""
    size = F.coalesce(F.regexp_count(docs["text"], F.lit(WORD)), F.lit(0)).cast("long")
    units = written(docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["source"].cast("string").alias("source"),
                                size.alias("size")).groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("m")), "units")
    rows = units.select("source", (F.col("size") * F.col("m")).alias("size"), "m")
    grouped = rows.groupBy("source").agg(F.sum("size").alias("size"), F.sum("m").alias("n_docs"))
    sources = written(targets(grouped.select("source", "size"), weights, share, cap).drop("n_docs")
                      .join(grouped.select("source", "n_docs").withColumnRenamed("source", "_s"),
                            F.col("source").eqNullSafe(F.col("_s"))).drop("_s"), "sources")
    keyed = units.withColumnRenamed("source", "_s").join(
        sources.select("source", "sid"), F.col("_s").eqNullSafe(F.col("source"))).drop("_s")
    hist = written(keyed.groupBy("sid", "size").agg(F.sum("m").alias("n"), F.count(F.lit(1)).alias("n_units")), "sizes")
    dual = _solve(hist, sources, cap)
    x = F.col("size") / F.col("scale")
    rate = (F.when(F.col("size") == 0, F.lit(1.0)).when(F.col("full"), F.lit(float(cap)))
            .otherwise(F.least(F.exp(F.least(F.col("lam") * x, F.lit(50.0))), F.lit(float(cap)))))
    rated = written(hist.join(dual, "sid").select("sid", "size", "n", rate.alias("rate"),
                                                  F.ceil(F.col("n_units") / PART_DOCS).cast("int").alias("n_parts")), "rates")
    # parts of cells, then whole copies along the sizes of each source
    dealt = keyed.join(rated.select("sid", "size", "rate", "n_parts"), ["sid", "size"]).withColumn(
        "part", F.pmod(F.xxhash64("doc_id"), F.col("n_parts")).cast("int"))
    parts = dealt.groupBy("sid", "size", "part").agg(F.sum("m").alias("n"), F.first("rate").alias("rate"))
    along = Window.partitionBy("sid").orderBy("size", "part")
    upto, below = along.rowsBetween(Window.unboundedPreceding, 0), along.rowsBetween(Window.unboundedPreceding, -1)
    total, whole = F.col("n") * F.col("rate"), Window.partitionBy("sid")
    parts = (parts.withColumn("_to", F.sum(total).over(upto))
             .withColumn("_from", F.coalesce(F.lag("_to").over(along), F.lit(0.0)))
             .withColumn("_copies", F.least(F.floor(F.col("_to") + 0.5) - F.floor(F.col("_from") + 0.5), F.col("n") * cap))
             .join(sources.select("sid", "target"), "sid")
             .withColumn("_rest", F.col("target") - F.sum(F.col("_copies") * F.col("size")).over(whole))
             .withColumn("_room", F.when(F.col("size") == 0, F.lit(0))
                         .when(F.col("_rest") > 0, F.col("n") * cap - F.col("_copies")).otherwise(F.col("_copies")))
             .withColumn("_before", F.coalesce(F.sum(F.col("_room") * F.col("size")).over(below), F.lit(0)))
             .withColumn("_fill", F.when(F.col("size") == 0, F.lit(0)).otherwise(F.least(F.col("_room"), F.greatest(
                 F.lit(0), F.round((F.abs(F.col("_rest")) - F.col("_before")) / F.col("size"))))).cast("long"))
             .withColumn("copies_total", (F.col("_copies") + F.when(F.col("_rest") > 0, F.col("_fill")).otherwise(-F.col("_fill"))).cast("long"))
             .select("sid", "size", "part", F.col("n").alias("_n"), "copies_total"))
    order = (Window.partitionBy("sid", "size", "part").orderBy(F.xxhash64(F.lit("mix"), "doc_id"), "doc_id")
             .rowsBetween(Window.unboundedPreceding, 0))
    placed = dealt.withColumn("_end", F.sum("m").over(order)).join(parts, ["sid", "size", "part"]).withColumn(
        "_at", F.explode(F.sequence(F.col("_end") - F.col("m"), F.col("_end") - 1)))
    copies = F.floor(F.col("copies_total") / F.col("_n")) + (F.col("_at") < F.col("copies_total") % F.col("_n")).cast("long")
    return (placed.withColumn("copies", copies.cast("long"))
            .join(sources.select("sid", F.col("source_size").cast("long").alias("source_size"), "target"), "sid")
            .select("doc_id", "source", "size", "source_size", "target", "rate", "copies",
                    (F.col("copies") * F.col("size")).alias("taken")))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs``, all columns, each row as often as the mix takes it (not at all, or up to the cap).

    The row travels as one struct, so its column names, whatever they are, meet none of the names used here.
    """
    chosen = written(mix_documents(docs, **options).select("doc_id", "source", "size", "copies"), "mix")
    rows = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), docs["doc_id"].cast("long").alias("id"),
        docs["source"].cast("string").alias("of"), F.coalesce(F.regexp_count(docs["text"], F.lit(WORD)), F.lit(0)).cast("long").alias("words"),
        F.xxhash64(docs["text"]).alias("hash"))
    if chosen.groupBy("doc_id").count().filter("count > 1").isEmpty():
        taken = bounded(chosen.filter("copies > 0").select("doc_id", "copies"))
        joined = rows.select("row", "id").join(taken, F.col("id").eqNullSafe(F.col("doc_id")))
    else:   # repeated ids: rows of equal source and size take the group's copies in turn
        chosen = chosen.withColumn("turn", F.row_number().over(Window.partitionBy("doc_id", "source", "size").orderBy(F.col("copies").desc())))
        rows = rows.withColumn("place", F.row_number().over(Window.partitionBy("id", "of", "words").orderBy("hash")))
        joined = rows.join(chosen.filter("copies > 0"), F.col("id").eqNullSafe(F.col("doc_id")) & F.col("of").eqNullSafe(F.col("source"))
                           & (F.col("words") == F.col("size")) & (F.col("place") == F.col("turn")))
    return joined.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")).select("row.*")
