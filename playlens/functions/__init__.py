"""Column expressions used by the operators (all JVM-side built-ins)."""

from playlens.functions.text import (  # noqa: F401
    genre_array, genre_string, media_name, padded_number, provider_id, series_name,
    is_series_title,
)
from playlens.functions.time import (  # noqa: F401
    event_time, pull_start_date, range_start, ntz_literal,
)
