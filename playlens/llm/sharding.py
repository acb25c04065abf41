"""Rendezvous hashing of stable record keys over weighted shards.

Every (key, shard) pair has a score ``-ln(u) / weight`` with ``u`` in (0, 1)
from an md5 of both; the record goes to the shard of the least score.  A new
shard only takes the records on which it beats their present best, so nothing
else moves, and shards fill in proportion to their weights.  The assignment is
a map over the rows: no shuffle and no state.

``slot`` numbers the records of a shard from 0 in hash order.  Each shard's
hash range is cut into parts of about :data:`PART_ROWS` rows, rows are numbered
inside a part, and the parts' totals are summed up before them, so no task
holds a shard.  Identical rows are counted first and expanded afterwards, so a
key repeated any number of times stays in one row until then.

A null key is the key of the text ``null``; a null text has no bytes (size 1,
crc 0).  Repeated rows get slots of their own.  Very long texts count by their bytes alone.
An empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARDS = tuple((j, 1.0) for j in range(16))
PART_ROWS = 50_000


def _unit52(text: Column) -> Column:
    """The first 52 bits of the md5 as a long."""
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def _score(key: Column, shard: Column, weight: Column) -> Column:
    u = (_unit52(F.concat(key, F.lit("/"), shard.cast("string"))) + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(u) / weight


def _best(key: Column, shards) -> Column:
    """Struct (score, shard) of the winning shard; equal scores go to the lower shard."""
    table = F.array(*[F.struct(F.lit(int(j)).alias("shard"), F.lit(float(w)).alias("weight")) for j, w in shards])
    return F.array_min(F.transform(table, lambda s: F.struct(
        _score(key, s["shard"], s["weight"]).alias("score"), s["shard"].alias("shard"))))


def assign_shards(rows: DataFrame, key: Column, shards=SHARDS, new_weight: float = 1.0) -> DataFrame:
    """Adds ``shard`` and ``grown_shard`` (the shard if one more of ``new_weight`` joined)."""
    name = F.coalesce(key.cast("string"), F.lit("null"))
    grown = max(j for j, _ in shards) + 1
    return (rows.withColumn("_best", _best(name, shards))
            .withColumn("_new", _score(name, F.lit(grown), F.lit(float(new_weight))))
            .withColumn("shard", F.col("_best.shard"))
            .withColumn("grown_shard", F.when(F.col("_new") < F.col("_best.score"), F.lit(grown)).otherwise(F.col("shard")))
            .drop("_best", "_new"))


def shard_documents(docs: DataFrame, shards=SHARDS, new_weight: float = 1.0) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row."""
    raw = F.coalesce(docs["text"], F.lit("")).cast("binary")
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), (F.octet_length(raw) + 1).cast("long").alias("size"),
                       F.crc32(raw).cast("long").alias("text_crc32"))
    rows = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("_n"))
    placed = assign_shards(rows, F.col("doc_id"), shards, new_weight)
    order = _unit52(F.concat_ws("/", F.lit("slot"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
                                F.col("size").cast("string"), F.col("text_crc32").cast("string")))
    parts = max(1, -(-docs.count() // (len(shards) * PART_ROWS)))
    placed = placed.withColumn("_h", order).withColumn(
        "_part", F.floor(F.col("_h") / F.lit(float(1 << 52)) * parts).cast("int"))
    sizes = placed.groupBy("shard", "_part").agg(F.sum("_n").alias("_rows"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("shard", "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    inside = (Window.partitionBy("shard", "_part").orderBy("_h", F.col("doc_id").asc_nulls_first(), "size", "text_crc32")
              .rowsBetween(Window.unboundedPreceding, 0))
    out = placed.withColumn("_end", F.sum("_n").over(inside)).join(sizes, ["shard", "_part"])
    first = F.col("_start") + F.col("_end") - F.col("_n")
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("shard").cast("int").alias("shard"),
                      F.explode(F.sequence(first, first + F.col("_n") - 1)).alias("slot"),
                      F.col("grown_shard").cast("int").alias("grown_shard"))


def _sql() -> str:
    def unit(text):
        return f"(('0x' || substr(md5({text}), 1, 13))::BIGINT)"

    def score(shard, weight):
        return f"(-ln(({unit(f"name || '/' || {shard}")} + 0.5) / {float(1 << 52)!r}) / {weight!r})"
    scores = ", ".join(f"{{'score': {score(j, w)}, 'shard': {j}}}" for j, w in SHARDS)
    grown = max(j for j, _ in SHARDS) + 1
    return f"""
WITH steps AS (SELECT list_transform(range(256), lambda b: list_reduce(list_concat([b], range(8)),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
rows AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size,
    CASE WHEN coalesce(text, '') = '' THEN 0 ELSE xor(4294967295, list_reduce(
      list_concat([4294967295::BIGINT], list_transform(string_split(trim(regexp_replace(hex(encode(text)), '(..)', '\\1 ', 'g')), ' '),
        lambda h: ('0x' || h)::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) END AS text_crc32,
    coalesce(doc_id::VARCHAR, 'null') AS name FROM documents, steps),
placed AS (SELECT *, list_min([{scores}]) AS best, {score(grown, 1.0)} AS fresh,
    {unit("'slot/' || name || '/' || size || '/' || text_crc32")} AS h FROM rows)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, best.shard::INTEGER AS shard,
  row_number() OVER (PARTITION BY best.shard ORDER BY h, doc_id, size, text_crc32) - 1 AS slot,
  CASE WHEN fresh < best.score THEN {grown} ELSE best.shard END::INTEGER AS grown_shard
FROM placed"""


ORACLE_SQL = _sql()
