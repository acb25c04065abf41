"""Parameters of the playback pipelines.

The first block holds fixed values that must equal the original
application's for the results to match; they are stated here once, as text.
"""

# ---- fixed values (must match the original application) -------------------
# Event types kept from the activity log.
PLAYBACK_TYPES = ["VideoPlayback"]
# Title inside the log sentence "<user> is playing <title> on <device>".
MEDIA_NAME_PATTERN = r"playing\s+(.*?)\s+on"
# A title with a dash is a series episode; the series name is the part before it.
SERIES_NAME_PATTERN = r"^(.*?)\s*-\s*"
# Time ranges of the statistics, as calendar intervals subtracted from "now".
TIME_RANGES = {
    "week": "INTERVAL 1 WEEK",
    "month": "INTERVAL 1 MONTH",
    "half_year": "INTERVAL 6 MONTH",
}
# Days of overlap between consecutive pulls of the activity log.
PULL_OVERLAP_DAYS = 2
# Date format of the pull filter.
PULL_DATE_FORMAT = "yyyy-MM-dd"
# Genre list separator in the title/genre history.
GENRE_SEPARATOR = ", "
# FP-Growth thresholds for series genres.
FP_MIN_SUPPORT = 0.1
FP_MIN_CONFIDENCE = 0.2
# Top-k sizes of the recommendations.
TOP_GENRES = 3
TOP_TITLES = 3
# Catalogue item types that a title search may return.
SEARCH_ITEM_TYPES = ["Series", "Movie"]
# Envelope file numbers are zero-padded to two digits.
FILE_NUMBER_WIDTH = 2
# Chart titles of the two statistics panels.
CHART_TITLE_MOVIES = "Number of views per movie for all users in one month"
CHART_TITLE_SERIES = "Number of views per TV series for all users in one month"
# Default user of the recommendation pipeline.
DEFAULT_USER = "1"
# ---- end of fixed values ---------------------------------------------------

# Kinds of media after the series/movie split.
KIND_SERIES = "series"
KIND_MOVIE = "movie"

# Upper bound (rows) for sides we broadcast after checking their size.
BROADCAST_ROW_LIMIT = 100_000
# Rows x patterns up to which a text search may be a nested loop, and patterns up to which it may whatever the rows.
NESTED_LOOP_PAIRS = 10_000_000
NESTED_LOOP_PATTERNS = 500
# A bounded list of at most so many names is turned into a pushed-down filter.
FILTER_NAMES = 100
# Items per envelope document written by the envelope sink.
ENVELOPE_PAGE_SIZE = 5_000
