"""Activity-log envelopes: JSON documents ``{"Items": [...], "TotalRecordCount": n}``.

Writer (A2): log rows are packed into envelopes of at most ``page_size``
items (grouped by id range, so no envelope grows with the data), one JSON
document per line, one directory per pull numbered ``<prefix>_NN``.  Spark's
commit protocol renames finished files into place, so a reader never sees a
half-written file.

Reader (A1): batch or streaming, fixed schema, JSON Lines by default
(splittable); ``multi_line=True`` reads one pretty-printed document per file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlens import params
from playlens.functions.text import padded_number
from playlens.schemas import LOG_ENVELOPE

DATE_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSS'Z'"
FILE_PREFIX = "activity"
CORRUPT = "_corrupt_record"


def log_items(log: DataFrame) -> DataFrame:
    """Log rows (``id, date, user_id, type, name``) -> one ``item`` struct per row."""
    return log.select(
        F.struct(
            F.col("id").alias("Id"),
            F.col("name").alias("Name"),
            F.lit(None).cast("string").alias("ShortOverview"),
            F.col("type").alias("Type"),
            F.date_format("date", DATE_FORMAT).alias("Date"),
            F.col("user_id").alias("UserId"),
            F.lit(None).cast("string").alias("UserPrimaryImageTag"),
            F.lit("Info").alias("Severity"),
        ).alias("item"),
        *[c for c in log.columns if c == "pull"],
    )


def pack_envelopes(log: DataFrame, page_size: int = params.ENVELOPE_PAGE_SIZE) -> DataFrame:
    """Group log rows into envelopes: ``pull, page, Items, TotalRecordCount``.

    A row keeps its ``pull`` column if it has one (else pull 1).  Items are
    sorted by id inside an envelope; a page holds ids ``[page*size, (page+1)*size)``.
    A page with more rows than that (null or repeated ids) is cut into several envelopes.
    """
    rows = log if "pull" in log.columns else log.withColumn("pull", F.lit(1))
    items = log_items(rows).withColumn("page", F.floor(F.col("item.Id") / page_size))
    full = items.groupBy(F.col("pull").alias("_pull"), F.col("page").alias("_page")).agg(
        F.ceil(F.count(F.lit(1)) / page_size).alias("_parts")).filter("_parts > 1")
    same = F.col("pull").eqNullSafe(F.col("_pull")) & F.col("page").eqNullSafe(F.col("_page"))
    part = F.when(F.col("_parts") > 1, F.pmod(F.monotonically_increasing_id(), F.col("_parts"))).otherwise(0)
    return items.join(full, same, "left").withColumn("_part", part).groupBy("pull", "page", "_part").agg(
        F.array_sort(F.collect_list("item")).alias("Items"),
        F.count(F.lit(1)).cast("int").alias("TotalRecordCount"),
    ).drop("_part")


def file_name(number: int, prefix: str = FILE_PREFIX) -> str:
    """``<prefix>_NN``: the pull number padded to two digits (more digits past 99)."""
    return f"{prefix}_{str(number).zfill(params.FILE_NUMBER_WIDTH)}"


def write_envelopes(envelopes: DataFrame, root: str, number: int, prefix: str = FILE_PREFIX,
                    multi_line: bool = False) -> str:
    """Write one pull's envelopes under ``root/<prefix>_NN``; returns the path.

    JSON Lines by default; ``multi_line`` writes one document per file, over
    many lines.
    """
    path = f"{root.rstrip('/')}/{file_name(number, prefix)}"
    writer = envelopes.select(F.to_json(F.struct("Items", "TotalRecordCount"), {"pretty": str(multi_line).lower()}).alias(
        "value")).write.mode("errorifexists")
    (writer.option("maxRecordsPerFile", 1) if multi_line else writer).text(path)
    return path


def unparsable(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Documents under ``path`` that are no envelopes (or arrays of them): ``file, document``."""
    schema = T.StructType([*LOG_ENVELOPE.fields, T.StructField("_corrupt_record", T.StringType())])
    docs = spark.read.text(path, wholetext=multi_line).select(
        F.input_file_name().alias("file"), F.col("value").alias("document")).filter(F.trim("document") != "")
    one, many = F.from_json("document", schema), F.from_json("document", T.ArrayType(LOG_ENVELOPE))
    return docs.filter(F.when(F.ltrim("document").startswith("["), many.isNull())
                       .otherwise(one["_corrupt_record"].isNotNull()))


def write_pulls(log_with_pull: DataFrame, root: str, prefix: str = FILE_PREFIX,
                page_size: int = params.ENVELOPE_PAGE_SIZE) -> list[str]:
    """Write every pull as its own directory, one job each, in pull order.

    Separate jobs give the files increasing modification times, which is the
    order a file stream picks them up in.
    """
    env = pack_envelopes(log_with_pull, page_size).persist()
    try:
        # The distinct pull numbers: one per file written, a handful.
        pulls = sorted(r[0] for r in env.select("pull").distinct().collect())
        return [write_envelopes(env.filter(F.col("pull") == p).drop("pull", "page"), root, p, prefix)
                for p in pulls]
    finally:
        env.unpersist()


def read_envelopes(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Batch read of envelope files with the fixed schema (no inference pass)."""
    return spark.read.schema(LOG_ENVELOPE).option("multiLine", multi_line).json(path)


def stream_envelopes(spark: SparkSession, path: str, multi_line: bool = False,
                     max_files_per_trigger: int | None = None,
                     clean_source: str | None = None, archive_dir: str | None = None, corrupt: bool = False) -> DataFrame:
    """Streaming read of envelope files appearing under ``path`` (A1).

    ``clean_source`` may be ``"archive"`` (with ``archive_dir``) or
    ``"delete"`` to drop files once a batch has committed them.  ``corrupt``
    adds the column :data:`CORRUPT`: the text of a document that does not parse.
    """
    schema = T.StructType([*LOG_ENVELOPE.fields, T.StructField(CORRUPT, T.StringType())]) if corrupt else LOG_ENVELOPE
    reader = spark.readStream.schema(schema).option("multiLine", multi_line)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if clean_source:
        reader = reader.option("cleanSource", clean_source)
        if archive_dir:
            reader = reader.option("sourceArchiveDir", archive_dir)
    return reader.json(path)


def file_numbers(paths: DataFrame, prefix: str = FILE_PREFIX) -> DataFrame:
    """Pull number and padded file number of each envelope file (``input_file_name``)."""
    num = F.regexp_extract(F.col("file"), rf"{prefix}_(\d+)", 1).cast("int")
    return paths.select("*", num.alias("pull"), padded_number(num).alias("file_no"))


def assign_pulls(log: DataFrame, pulls: int = 4, overlap: float = 0.1) -> DataFrame:
    """Split log rows into ``pulls`` id ranges, each reaching ``overlap`` of a range
    back into its predecessor, so neighbouring pulls share rows (the pull overlap).

    Adds ``pull`` (1-based); an overlapping row appears twice.
    """
    bounds = log.agg(F.min("id").alias("_lo"), F.max("id").alias("_hi"))
    # One-row frame of bounds: a scalar subquery, not a join.
    lo = bounds.select("_lo").scalar()
    hi = bounds.select("_hi").scalar()
    width = (hi - lo + F.lit(1)).cast("double") / pulls
    pos = (F.col("id") - lo).cast("double")
    k = F.least(F.floor(pos / width), F.lit(pulls - 1)).cast("int")
    nxt = k + 1
    in_overlap = (nxt <= pulls - 1) & (pos >= nxt * width - F.lit(overlap) * width)
    ks = F.when(in_overlap, F.array(k, nxt)).otherwise(F.array(k))
    return log.select("*", F.explode(ks).alias("_k")).withColumn("pull", F.col("_k") + 1).drop("_k")
