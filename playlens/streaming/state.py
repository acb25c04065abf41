"""State tables of the streaming jobs, all under one state root.

* **history** (J3): media events, partitioned by ``day`` and ``batch_id``.
  Each micro-batch overwrites only its own partitions (dynamic overwrite),
  so replaying a batch after a failure rewrites the same files instead of
  adding rows.  Readers prune by ``day`` and then filter exact timestamps.
* **closed days**: days that ended long ago, rewritten as one set of files per
  day (:func:`compact_days`), so files do not grow with the number of batches.
* **versioned tables** (J5, the high-water mark): small results of a batch.
  Batch ``n`` reads version ``n-1`` and writes version ``n``; a replay of
  batch ``n`` recomputes the same version.  Every batch writes a version, so
  ``n-1`` always exists after the first batch.
* **first-wins tables** (J7): keyed rows that never change once stored, in
  buckets by key.  A batch reads the buckets its keys fall into and adds the
  keys they lack as new files of its own; nothing stored is rewritten.
* **votes** (J6): per-batch counts, written once; Spark's own state store sums them
  (:func:`playlens.streaming.jobs.run_genre_totals`).

A new stream (new checkpoint) must get a new state root.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from playlens.functions.time import ntz_literal
from playlens.operators.barrier import materialize
from playlens.schemas import HISTORY

HISTORY_DDL = "id bigint, ts timestamp_ntz, user_id string, media_name string, day date, batch_id bigint"


def _read_parquet_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    try:
        df = spark.read.schema(schema).parquet(path)
        df.schema
        return df
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return spark.createDataFrame([], schema)
        raise


def version_path(root: str, name: str, version: int) -> str:
    return f"{root.rstrip('/')}/{name}/v={version}"


def read_version(spark: SparkSession, root: str, name: str, version: int, schema: StructType) -> DataFrame:
    """State ``name`` as of ``version``; empty only before the first batch.

    Every batch writes a version, so a missing one is lost state and raises:
    reading it as empty would restart counts and marks without a word.
    """
    if version < 0:
        return spark.createDataFrame([], schema)
    df = spark.read.schema(schema).parquet(version_path(root, name, version))
    df.schema
    return df


def write_version(df: DataFrame, root: str, name: str, version: int) -> str:
    path = version_path(root, name, version)
    df.write.mode("overwrite").parquet(path)
    return path


def history_path(root: str) -> str:
    return f"{root.rstrip('/')}/history"


def append_history(batch: DataFrame, root: str, batch_id: int) -> None:
    """Write one micro-batch of media events into its ``(day, batch_id)`` partitions."""
    cols = [c.name for c in HISTORY.fields]
    (batch.select(*cols)
     .withColumn("day", F.to_date("ts"))
     .withColumn("batch_id", F.lit(batch_id).cast("bigint"))
     .write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy("day", "batch_id")
     .parquet(history_path(root)))


def read_history(spark: SparkSession, root: str, start=None) -> DataFrame:
    """History rows with ``ts >= start`` (all when None); ``day`` prunes partitions first."""
    hist = _open_and_closed(spark, history_path(root), HISTORY_DDL)
    if start is None:
        return hist
    start_col = start if not isinstance(start, str) else ntz_literal(start)
    return hist.filter(F.col("day") >= F.to_date(start_col)).filter(F.col("ts") >= start_col)


def newest_event(spark: SparkSession, root: str):
    """The newest event time stored, read from the newest day alone."""
    days = [d for path in (history_path(root), closed_path(history_path(root))) for d, _, _ in _leaves(spark, path) if d[:4].isdigit()]
    if not days:
        return None
    return read_history(spark, root).filter(F.col("day") == F.lit(max(days)).cast("date")).agg(F.max("ts")).first()[0]


# ---- closed days ----------------------------------------------------------------------------------

CLOSED_FILES = 8        # files of a closed day at most, besides those a size limit adds
CLOSED_FILE_ROWS = 5_000_000


def closed_path(path: str) -> str:
    return f"{path}_closed"


def _open_and_closed(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """Rows of a table partitioned by ``day, batch_id`` and of its closed days.

    A closed day holds the batches up to its ``through``; open folders of these
    batches that a stopped compaction left behind are passed over.
    """
    schema = StructType.fromDDL(ddl)
    newest: dict[str, tuple[int, str]] = {}
    for day, through, folder in _leaves(spark, closed_path(path)):
        if through > newest.get(day, (-1, ""))[0]:
            newest[day] = (through, folder)
    rows = _read_parquet_or_empty(spark, path, schema)
    if not newest:
        return rows
    done = F.create_map(*[F.lit(x) for day, (through, _) in newest.items() for x in (day, through)])
    name = F.coalesce(F.col("day").cast("string"), F.lit(NULL_DAY))
    rows = rows.filter(F.col("batch_id") > F.coalesce(F.try_element_at(done, name), F.lit(-1)))
    closed = (spark.read.schema(StructType([*schema.fields, StructField("through", LongType())]))
              .option("basePath", closed_path(path)).parquet(*[folder for _, folder in newest.values()]))
    return rows.unionByName(closed.select(*schema.names))


def compact_days(spark: SparkSession, root: str, before, through: int) -> None:
    """Rewrite each day before ``before`` as one file set holding the batches up to ``through``.

    A day is rewritten only if it has open folders of such batches.  Safe to
    stop and to repeat at any point: a closed day takes effect when its folder
    is committed, readers then pass over what it holds, and the folders it
    replaces are deleted last.  Late rows of a closed day stay open until the next run.
    """
    for path, ddl, by in ((history_path(root), HISTORY_DDL, "id"), (daily_counts_path(root), DAILY_DDL, "title")):
        todo = sorted({day for day, batch, _ in _leaves(spark, path) if batch <= through and day[:4].isdigit() and day < str(before)})
        held = {day: n for day, n, _ in _leaves(spark, closed_path(path))}
        stale = [day for day in todo if held.get(day, -1) < through]
        if stale:
            rows = _open_and_closed(spark, path, ddl).filter(F.col("day").isin([F.lit(d).cast("date") for d in stale]) & (F.col("batch_id") <= through))
            if path == daily_counts_path(root):     # partial counts of a day add up
                rows = rows.groupBy("kind", "title", "day").agg(F.sum("views").cast("bigint").alias("views"), F.max("batch_id").alias("batch_id"))
            (rows.withColumn("through", F.lit(through).cast("bigint"))
             .repartition("day", F.pmod(F.xxhash64(by), F.lit(CLOSED_FILES)))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", CLOSED_FILE_ROWS)
             .partitionBy("day", "through").parquet(closed_path(path)))
        newest: dict[str, int] = {}
        for day, n, _ in _leaves(spark, closed_path(path)):
            newest[day] = max(n, newest.get(day, -1))
        for table in (path, closed_path(path)):
            for day, n, folder in _leaves(spark, table):
                if n < newest.get(day, -1) or (table == path and n <= newest.get(day, -1)):
                    _delete(spark, folder)


# ---- daily partial counts (incremental rolling statistics) ---------------------------------------

DAILY_DDL = "kind string, title string, views bigint, day date, batch_id bigint"


def daily_counts_path(root: str) -> str:
    return f"{root.rstrip('/')}/daily_counts"


def append_daily_counts(titled: DataFrame, root: str, batch_id: int, time_col: str = "ts") -> None:
    """Write one micro-batch's views per ``(day, kind, title)`` into its own partitions.

    These partial counts are what a range query sums for the days it covers
    completely, so it never re-reads raw events of those days.  Like the
    history, a replayed batch rewrites its own partitions.
    """
    (titled.groupBy(F.to_date(time_col).alias("day"), "kind", "title")
     .agg(F.count(F.lit(1)).alias("views"))
     .withColumn("batch_id", F.lit(batch_id).cast("bigint"))
     .repartition("day", "title")     # aggregated rows; AQE keeps the files few, no day sits in one task
     .write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy("day", "batch_id")
     .parquet(daily_counts_path(root)))


def range_counts(spark: SparkSession, root: str, start, end, titled_history) -> DataFrame:
    """Views per ``(kind, title)`` with ``start <= ts <= end``.

    Days between the two boundary days come from the daily partial counts;
    only the boundary days are counted from raw history rows
    (``titled_history`` maps history rows to ``kind, title``).  Both reads
    prune by ``day``.
    """
    start_col = start if not isinstance(start, str) else ntz_literal(start)
    end_col = end if not isinstance(end, str) else ntz_literal(end)
    start_day, end_day = F.to_date(start_col), F.to_date(end_col)
    partial = _open_and_closed(spark, daily_counts_path(root), DAILY_DDL)
    full_days = partial.filter((F.col("day") > start_day) & (F.col("day") < end_day)).select("kind", "title", "views")
    edge_rows = read_history(spark, root).filter((F.col("day") == start_day) | (F.col("day") == end_day)).filter(
        (F.col("ts") >= start_col) & (F.col("ts") <= end_col))
    edge = titled_history(edge_rows).groupBy("kind", "title").agg(F.count(F.lit(1)).alias("views"))
    return full_days.unionByName(edge).groupBy("kind", "title").agg(
        F.sum("views").cast("bigint").alias("views"))


def daily_counts(spark: SparkSession, root: str) -> DataFrame:
    """All daily partial counts summed: ``day, kind, title, views``."""
    partial = _open_and_closed(spark, daily_counts_path(root), DAILY_DDL)
    return partial.groupBy("day", "kind", "title").agg(F.sum("views").cast("bigint").alias("views"))


# ---- retention --------------------------------------------------------------------------------

def _folder(spark: SparkSession, path: str):
    """The path's file system and its sub-folders ``name=value`` (metadata only)."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [s.getPath() for s in fs.listStatus(hadoop) if s.isDirectory()] if fs.exists(hadoop) else []
    return fs, [(p.getName().partition("=")[2], p) for p in found if "=" in p.getName()]


NULL_DAY = "__HIVE_DEFAULT_PARTITION__"


def _leaves(spark: SparkSession, path: str) -> list[tuple[str, int, str]]:
    """(day, number, folder) of every ``day=.../batch_id=...`` folder (metadata only)."""
    _, days = _folder(spark, path)
    return [(day, int(n), p.toString()) for day, folder in days for n, p in _folder(spark, folder.toString())[1] if n.isdigit()]


def _delete(spark: SparkSession, path: str) -> None:
    fs, _ = _folder(spark, path)
    fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path), True)


def newest_version(spark: SparkSession, root: str, name: str) -> int | None:
    """The newest version number of a state table, from the folder names alone."""
    _, parts = _folder(spark, f"{root.rstrip('/')}/{name}")
    return max((int(v) for v, _ in parts if v.isdigit()), default=None)


def drop_old_versions(spark: SparkSession, root: str, name: str, keep: int = 3) -> None:
    """Keep the newest ``keep`` versions of a state table (at least two: a replay reads ``n-1``)."""
    fs, parts = _folder(spark, f"{root.rstrip('/')}/{name}")
    for _, path in sorted(((int(v), p) for v, p in parts if v.isdigit()), key=lambda x: x[0])[:-max(keep, 2)]:
        fs.delete(path, True)


def drop_days_before(spark: SparkSession, root: str, day) -> None:
    """Drop stored days before ``day`` from the history and the daily counts, open and closed."""
    tables = (history_path(root), daily_counts_path(root))
    for path in (*tables, *map(closed_path, tables)):
        fs, parts = _folder(spark, path)
        for value, folder in parts:
            if value[:4].isdigit() and value < str(day):
                fs.delete(folder, True)


# ---- first-wins tables (J7) -----------------------------------------------------------------------

FIRST_WINS_BUCKETS = 64


def first_wins_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def read_first_wins(spark: SparkSession, root: str, name: str, schema: StructType, before: int | None = None) -> DataFrame:
    """The table's rows with their ``bucket``; ``before`` leaves out batches from that one on."""
    stored = StructType([*schema.fields, StructField("bucket", IntegerType()), StructField("batch_id", LongType())])
    rows = _read_parquet_or_empty(spark, first_wins_path(root, name), stored)
    if before is not None:
        rows = rows.filter(F.col("batch_id") < before)
    return rows.select(*schema.names, "bucket")


def append_first_wins(rows: DataFrame, root: str, name: str, key: str, batch_id: int, buckets: int = FIRST_WINS_BUCKETS) -> None:
    """Adds the rows (one per ``key``) whose key no earlier batch has stored.

    Only the buckets of the batch's keys are read (partition-pruned), and only
    files of this batch are written: a replay overwrites just these.
    """
    spark = rows.sparkSession
    rows = materialize(rows.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")))
    touched = [r[0] for r in rows.select("bucket").distinct().collect()]       # at most ``buckets`` numbers
    if not touched:
        return
    schema = rows.drop("bucket").schema
    held = read_first_wins(spark, root, name, schema, before=batch_id).filter(F.col("bucket").isin(touched)).select(F.col(key).alias("_held"))
    fresh = rows.join(held, F.col(key).eqNullSafe(F.col("_held")), "left_anti")
    (fresh.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("bucket", "batch_id").parquet(first_wins_path(root, name)))


# ---- votes: per-batch counts, written once (J6) -----------------------------------------------------

def votes_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def write_votes(counts: DataFrame, root: str, name: str, batch_id: int) -> None:
    """One batch's counts (a closed vocabulary) as files a stream reads; a replayed batch keeps the first ones.

    A finished folder is marked by Spark's ``_SUCCESS`` file; one without it
    was never read as the totals run after the write, and is written again.
    """
    spark = counts.sparkSession
    path = f"{votes_path(root, name)}/batch_id={batch_id}"
    fs, _ = _folder(spark, path)
    if not fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")):
        counts.coalesce(1).write.mode("overwrite").parquet(path)
