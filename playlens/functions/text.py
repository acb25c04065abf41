"""String and array expressions over log sentences, titles and genre lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from playlens import params


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def media_name(name: str | Column, pattern: str = params.MEDIA_NAME_PATTERN) -> Column:
    """Title inside the log sentence; ``""`` when the sentence does not match."""
    return F.regexp_extract(_c(name), pattern, 1)


def is_series_title(title: str | Column, pattern: str = params.SERIES_NAME_PATTERN) -> Column:
    """True when the title has the episode dash, so it belongs to a series."""
    return _c(title).rlike(pattern)


def series_name(title: str | Column, pattern: str = params.SERIES_NAME_PATTERN) -> Column:
    """The part before the first dash of a series title, null for other titles."""
    t = _c(title)
    return F.when(t.rlike(pattern), F.regexp_extract(t, pattern, 1))


def genre_array(genres: str | Column, sep: str = params.GENRE_SEPARATOR) -> Column:
    """Genre string -> distinct genre array; empty or null string -> null basket.

    Splitting ``""`` would give ``[""]`` (a false genre) and repeated genres
    would make FP-Growth reject the basket, so both are normalised here.
    """
    g = _c(genres)
    return F.when(g.isNull() | (g == ""), F.lit(None)).otherwise(
        F.array_distinct(F.split(g, _regex_quote(sep)))
    )


def genre_string(genres: str | Column, sep: str = params.GENRE_SEPARATOR) -> Column:
    """Genre array -> one string, in the array's order."""
    return F.array_join(_c(genres), sep)


def padded_number(n: str | Column, width: int = params.FILE_NUMBER_WIDTH) -> Column:
    """``str(n).zfill(width)`` for non-negative numbers."""
    digits = _c(n).cast("string")
    return F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0"))


def provider_id(ids: str | Column, provider: str = "Tmdb") -> Column:
    """Provider id from a ``map<string,string>`` of ids; ``""`` when absent."""
    return F.coalesce(F.try_element_at(_c(ids), F.lit(provider)), F.lit(""))


def _regex_quote(s: str) -> str:
    special = set("\\^$.|?*+()[]{}")
    return "".join("\\" + ch if ch in special else ch for ch in s)
