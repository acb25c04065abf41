"""Parquet tables and the playback views derived from them.

The test tables are a star schema plus an ``events`` fact table.  The views
below turn them into the shapes the playback pipelines consume:

``catalogue``         item_id, type, title, tmdb_id      (one row per order)
``catalogue_genres``  item_id, genre                      (distinct order/part-type)
``genre_lookup``      name, id                            (distinct part types)
``english_titles``    tmdb_id, title                      (a subset of the catalogue)
``playback_log``      id, date, user_id, type, name       (one row per event)
``denylist``          pattern                             (two channel names)

Only ``p_partkey`` values within one modulus of zero can meet ``o_orderkey %
200``, and only such item ids can meet ``floor(value) % 200``; both joins
therefore filter the small side to that range first, which gives the
broadcast a size bound that does not grow with the data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# ---- fixed values of the derived views (see FIXTURES.md) --------------------
CATALOGUE_MODULUS = 200          # item i is described by part i % 200
SERIES_EVERY = 3                 # item_id % 3 = 0 -> Series, else Movie
NO_TMDB_EVERY = 7                # item_id % 7 = 0 -> no provider id
TMDB_OFFSET = 600000             # provider id = 600000 + item_id
NO_ENGLISH_EVERY = 5             # item_id % 5 = 0 -> not in the English cache
ENGLISH_PREFIX = "EN "
GENRE_ID_BASE = 7500             # genre id = 7500 + rank of the part type
LIVE_CHANNEL_EVERY = 20          # event_id % 20 = 0 -> live channel "CCTV5+"
EMPTY_TITLE_EVERY = 33           # event_id % 33 = 0 -> empty title
EPISODES = 10                    # episode number = event_id % 10
HD_DEVICE_EVERY = 50             # event_id % 50 = 1 -> device "HD box"
LIVE_CHANNEL = "CCTV5+"
DENYLIST_PATTERNS = ["CCTV5+", "HD"]
PLAYBACK_EVENT_TYPES = ["view", "click"]
# ---- end of fixed values -----------------------------------------------------


@dataclass
class Tables:
    """Lazy accessors for the parquet tables of one scale-factor directory."""

    spark: SparkSession
    sf_dir: str

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir.rstrip('/')}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.read(name)
        raise AttributeError(name)


def _near_zero(col: str) -> F.Column:
    """Values that ``x % CATALOGUE_MODULUS`` can take for any bigint x."""
    return F.col(col).between(-(CATALOGUE_MODULUS - 1), CATALOGUE_MODULUS - 1)


def catalogue(t: Tables) -> DataFrame:
    """Catalogue items: one per order, described by part ``o_orderkey % 200``."""
    parts = t.part.select("p_partkey", "p_name").filter(_near_zero("p_partkey"))
    orders = t.orders.select(F.col("o_orderkey").alias("item_id"))
    key = F.col("item_id")
    return (
        orders.join(F.broadcast(parts), (key % CATALOGUE_MODULUS) == F.col("p_partkey"))
        .select(
            key,
            F.when(key % SERIES_EVERY == 0, F.lit("Series")).otherwise(F.lit("Movie")).alias("type"),
            F.concat(F.col("p_name"), F.lit(" "), key.cast("string")).alias("title"),
            F.when(key % NO_TMDB_EVERY == 0, F.lit(None).cast("string"))
            .otherwise((key + TMDB_OFFSET).cast("string"))
            .alias("tmdb_id"),
        )
    )


def catalogue_genres(t: Tables) -> DataFrame:
    """Genre links: the distinct part types of an order's lines."""
    lines = t.lineitem.select(F.col("l_orderkey").alias("item_id"), "l_partkey")
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("genre"))
    return lines.join(parts, "l_partkey").select("item_id", "genre").distinct()


def genre_lookup(t: Tables) -> DataFrame:
    """Genre name -> id; ids follow the sorted distinct part types.

    The window runs over the distinct type names only (a closed vocabulary of
    genre names), never over fact rows.
    """
    from pyspark.sql import Window

    names = t.part.select(F.col("p_type").alias("name")).distinct()
    return names.select(
        "name",
        (F.lit(GENRE_ID_BASE) + F.row_number().over(Window.orderBy("name"))).cast("bigint").alias("id"),
    )


def english_titles(t: Tables, cat: DataFrame | None = None) -> DataFrame:
    """English-title cache: provider id -> English title, for part of the catalogue."""
    cat = cat if cat is not None else catalogue(t)
    return cat.filter(
        F.col("tmdb_id").isNotNull() & (F.col("item_id") % NO_ENGLISH_EVERY != 0)
    ).select("tmdb_id", F.concat(F.lit(ENGLISH_PREFIX), F.col("title")).alias("title"))


def playback_log(t: Tables, cat: DataFrame | None = None, user_id: int | None = None) -> DataFrame:
    """The activity log as rows ``id, date, user_id, type, name``.

    ``user_id`` keeps one user's rows; the numeric comparison reaches the scan.
    """
    cat = cat if cat is not None else catalogue(t)
    items = cat.filter(_near_zero("item_id")).select("item_id", "type", "title")
    ev = t.events.select("event_id", "ts", "user_id", "event_type", "value")
    if user_id is not None:
        ev = ev.filter(F.col("user_id") == int(user_id))
    eid = F.col("event_id")
    shown = (
        F.when(eid % LIVE_CHANNEL_EVERY == 0, F.lit(LIVE_CHANNEL))
        .when(eid % EMPTY_TITLE_EVERY == 0, F.lit(""))
        .when(F.col("type") == "Series",
              F.concat(F.col("title"), F.lit(" - S1, Ep"), (eid % EPISODES).cast("string")))
        .otherwise(F.col("title"))
    )
    device = F.when(eid % HD_DEVICE_EVERY == 1, F.lit("HD box")).otherwise(F.lit("device"))
    joined = ev.join(
        F.broadcast(items),
        (F.floor("value").cast("bigint") % CATALOGUE_MODULUS) == F.col("item_id"),
    )
    return joined.select(
        eid.alias("id"),
        F.col("ts").alias("date"),
        F.col("user_id").cast("string").alias("user_id"),
        F.when(F.col("event_type").isin(PLAYBACK_EVENT_TYPES), F.lit("VideoPlayback"))
        .otherwise(F.col("event_type"))
        .alias("type"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string"), F.lit(" is playing "), shown,
                 F.lit(" on "), device).alias("name"),
    )


def denylist(spark: SparkSession) -> DataFrame:
    """The channel deny-list of the fixtures: two channel names."""
    return spark.createDataFrame([(p,) for p in DENYLIST_PATTERNS], "pattern string")
