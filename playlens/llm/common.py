"""Shared steps: reading tables, written intermediates, connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str, release: bool = False) -> DataFrame:
    """``df`` written once as a table in the shared checkpoint folder and read back.

    Later jobs read the files, so the work above is not repeated and a lost
    executor costs nothing but its running tasks.  With ``release`` the shuffle files of
    the job go at its end, not when the driver next collects its garbage.
    """
    path, conf = scratch_path(df.sparkSession, name), df.sparkSession.conf
    before = conf.get(RELEASE, "false")
    if release:
        conf.set(RELEASE, "true")
    try:
        df.write.parquet(path)
    finally:
        if release:
            conf.set(RELEASE, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Deletes the files of :func:`written` tables that nothing reads any more."""
    for table in tables:
        jvm, files = table.sparkSession.sparkContext._jvm, table.inputFiles()
        if files:
            folder = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(files[0])).getParent()
            folder.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


BROADCAST_ROWS = 1_000_000


def bounded(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, a written table of a few fixed-size columns, with a broadcast hint up to ``limit`` rows.

    Beyond the limit the hint is left off and Spark joins by shuffling.
    """
    return F.broadcast(df) if df.count() <= limit else df


SPREAD_BROADCAST = 100_000
HOT_ROWS = 100_000


def join_spread(rows: DataFrame, table: DataFrame, key: str, n: str = "n", limit: int = SPREAD_BROADCAST, hot: int = HOT_ROWS) -> DataFrame:
    """``rows`` left joined with ``table``: one row of fixed size per key, with the number ``n`` of rows that hold it.

    Up to ``limit`` keys are broadcast.  Beyond, only keys held by ``hot`` rows or more
    are (at most one for every ``hot`` rows), and the rest, none of them
    frequent, join by a shuffle.  ``rows`` and ``table`` are read several times: written tables.
    """
    if table.count() <= limit:
        return rows.join(F.broadcast(table), key, "left")
    frequent = bounded(table.filter(F.col(n) >= hot))
    rest = rows.join(frequent.select(key), key, "left_anti").join(table.filter(F.col(n) < hot), key, "left")
    return rows.join(frequent, key).unionByName(rest)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable, for every node with an edge.

    Alternating large-star and small-star steps: each replaces a node's edges
    by edges to the smallest node it sees, so the edge set never grows beyond
    its first size and a star remains.  Every round is a checkpointed job on
    the edges alone; the driver sees one checksum per round.
    """
    def stars(e: DataFrame) -> DataFrame:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        # large star: every larger neighbour of a node points to the node's smallest
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.unionByName(low.filter("m < a").select("a", F.col("m").alias("b"))).distinct()
        # small star: a node and its smaller neighbours point to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        return (small.filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                .unionByName(least.select("a", F.col("m").alias("b"))).distinct())

    def mark(e: DataFrame):
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = (edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
           .filter("a > b").distinct())
    now = written(now, "edges")
    seen = mark(now)
    for _ in range(max_rounds if seen[0] else 0):
        now = written(stars(now), "stars")
        new = mark(now)
        if new == seen:
            break
        seen = new
    else:
        if seen[0]:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return (now.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct())


def shingle_sql(table: str, ident: str, size: int, whole_if_shorter: bool) -> str:
    """DuckDB: distinct (id, shingle) of a table's texts, A-Z lower-cased; without shorter texts unless asked for."""
    short = (f"UNION SELECT {ident} AS id, array_to_string(w, ' ') FROM words WHERE len(w) BETWEEN 1 AND {size - 1}"
             if whole_if_shorter else "")
    return f"""(WITH words AS (SELECT {ident}, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM {table})
  SELECT DISTINCT {ident} AS id, array_to_string(w[i:i + {size - 1}], ' ') AS s
  FROM (SELECT {ident}, w, unnest(range(1, len(w) - {size - 2})) AS i FROM words) {short})"""
