"""Schemas of the inputs and state tables."""

from pyspark.sql import types as T

# One item of the activity-log envelope.
LOG_ITEM = T.StructType([
    T.StructField("Id", T.LongType(), True),
    T.StructField("Name", T.StringType(), True),
    T.StructField("ShortOverview", T.StringType(), True),
    T.StructField("Type", T.StringType(), True),
    T.StructField("Date", T.StringType(), True),
    T.StructField("UserId", T.StringType(), True),
    T.StructField("UserPrimaryImageTag", T.StringType(), True),
    T.StructField("Severity", T.StringType(), True),
])

# One JSON document of the activity log: a page of items plus the total.
LOG_ENVELOPE = T.StructType([
    T.StructField("Items", T.ArrayType(LOG_ITEM), True),
    T.StructField("TotalRecordCount", T.IntegerType(), True),
])

# Deny-list of live-TV channel names (CSV with header).
DENYLIST_CSV = T.StructType([T.StructField("Channel Name", T.StringType(), True)])

# Genre name -> genre id lookup (CSV with header).
GENRE_LOOKUP = T.StructType([
    T.StructField("name", T.StringType(), True),
    T.StructField("id", T.LongType(), True),
])

# Provider id -> English title cache (CSV with header; ids compared as strings).
ENGLISH_TITLES = T.StructType([
    T.StructField("tmdb_id", T.StringType(), True),
    T.StructField("title", T.StringType(), True),
])

# Title -> genres history of series (genres joined by ", ").
TITLE_GENRES = T.StructType([
    T.StructField("Title", T.StringType(), True),
    T.StructField("Genres", T.StringType(), True),
])

# Genre -> count state of movies.
GENRE_COUNTS = T.StructType([
    T.StructField("Genres", T.StringType(), True),
    T.StructField("Counts", T.LongType(), True),
])

# Rolling history of media events kept by the streaming statistics.
HISTORY = T.StructType([
    T.StructField("id", T.LongType(), True),
    T.StructField("ts", T.TimestampNTZType(), True),
    T.StructField("user_id", T.StringType(), True),
    T.StructField("media_name", T.StringType(), True),
])
