"""Independent SQL for every registered query, written for DuckDB.

Each statement starts from the raw parquet tables (registered as views of
the same names) and re-derives the playback views with plain SQL, then
answers the query.  Column names and types match the Spark side: counts
are BIGINT, positions INTEGER, sets are sorted ``", "``-joined strings and
ratios are rounded.
"""

from __future__ import annotations

# ---- derived views ------------------------------------------------------------------
VIEWS = r"""
catalogue AS (
  SELECT o.o_orderkey AS item_id,
         CASE WHEN o.o_orderkey % 3 = 0 THEN 'Series' ELSE 'Movie' END AS type,
         p.p_name || ' ' || CAST(o.o_orderkey AS VARCHAR) AS title,
         CASE WHEN o.o_orderkey % 7 = 0 THEN NULL
              ELSE CAST(600000 + o.o_orderkey AS VARCHAR) END AS tmdb_id
  FROM orders o JOIN part p ON p.p_partkey = o.o_orderkey % 200
),
catalogue_genres AS (
  SELECT DISTINCT l.l_orderkey AS item_id, p.p_type AS genre
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
),
genre_lookup AS (
  SELECT name, CAST(7500 + row_number() OVER (ORDER BY name) AS BIGINT) AS id
  FROM (SELECT DISTINCT p_type AS name FROM part) g
),
english_titles AS (
  SELECT tmdb_id, 'EN ' || title AS title
  FROM catalogue WHERE tmdb_id IS NOT NULL AND item_id % 5 <> 0
),
playback_log AS (
  SELECT e.event_id AS id, e.ts AS date, CAST(e.user_id AS VARCHAR) AS user_id,
         CASE WHEN e.event_type IN ('view', 'click') THEN 'VideoPlayback' ELSE e.event_type END AS type,
         'user_' || CAST(e.user_id AS VARCHAR) || ' is playing ' ||
         CASE WHEN e.event_id % 20 = 0 THEN 'CCTV5+'
              WHEN e.event_id % 33 = 0 THEN ''
              WHEN c.type = 'Series' THEN c.title || ' - S1, Ep' || CAST(e.event_id % 10 AS VARCHAR)
              ELSE c.title END
         || ' on ' || CASE WHEN e.event_id % 50 = 1 THEN 'HD box' ELSE 'device' END AS name
  FROM events e JOIN catalogue c ON c.item_id = CAST(floor(e.value) AS BIGINT) % 200
),
en_lookup AS (SELECT tmdb_id, min(title) AS en_title FROM english_titles
              WHERE tmdb_id IS NOT NULL GROUP BY tmdb_id),
item_genre_str AS (SELECT item_id, string_agg(genre, ', ' ORDER BY genre) AS genres
                   FROM catalogue_genres GROUP BY item_id),
denylist AS (SELECT * FROM (VALUES ('CCTV5+'), ('HD')) t(pattern)),
playback AS (
  SELECT * FROM playback_log WHERE type IN ('VideoPlayback')
),
not_denied AS (
  SELECT l.* FROM playback l
  WHERE l.name IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM denylist d WHERE contains(l.name, d.pattern))
),
media_events AS (
  SELECT * FROM (
    SELECT l.*, regexp_extract(l.name, 'playing\s+(.*?)\s+on', 1) AS media_name FROM not_denied l
  ) m WHERE media_name <> ''
),
titled AS (
  SELECT m.*,
         CASE WHEN regexp_matches(media_name, '^(.*?)\s*-\s*') THEN 'series' ELSE 'movie' END AS kind,
         CASE WHEN regexp_matches(media_name, '^(.*?)\s*-\s*')
              THEN regexp_extract(media_name, '^(.*?)\s*-\s*', 1) ELSE media_name END AS title
  FROM media_events m
)
"""


def with_views(body: str, extra: str = "") -> str:
    """Prefix ``body`` with the derived views (and optional extra CTEs)."""
    ctes = VIEWS.strip()
    if extra.strip():
        ctes += ",\n" + extra.strip()
    return f"WITH {ctes}\n{body.strip()}"


SQL: dict[str, str] = {}


def register(name: str, body: str, extra: str = "") -> None:
    SQL[name] = with_views(body, extra)


# ---- view statistics ------------------------------------------------------------------
MONTH_CUT = "TIMESTAMP '2024-02-15 00:00:00' - INTERVAL 1 MONTH"

register("view_statistics", f"""
SELECT kind, title, views,
       CAST(row_number() OVER (PARTITION BY kind ORDER BY views DESC, title) AS INTEGER) AS rank
FROM (SELECT kind, title, count(*) AS views FROM titled WHERE date >= {MONTH_CUT} GROUP BY kind, title) v
""")

TS = "strftime(date, '%Y-%m-%d %H:%M:%S.%f') AS date"


# ---- log operators --------------------------------------------------------------------------
register("filter_event_type", f"SELECT id, {TS}, user_id, type, name FROM playback")
register("filter_denylist", "SELECT id, user_id, name FROM not_denied")
register("extract_media_name", "SELECT id, user_id, media_name FROM media_events")
register("split_series", r"""
SELECT id, regexp_extract(media_name, '^(.*?)\s*-\s*', 1) AS media_name
FROM media_events WHERE regexp_matches(media_name, '^(.*?)\s*-\s*')""")
register("split_movies", r"""
SELECT id, media_name FROM media_events WHERE NOT regexp_matches(media_name, '^(.*?)\s*-\s*')""")
register("user_history", f"SELECT id, {TS}, media_name FROM media_events WHERE user_id = '1'")
register("time_range_week", f"""
SELECT id, {TS}, media_name FROM media_events
WHERE date >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 1 WEEK""")
register("time_range_month", f"""
SELECT id, {TS}, media_name FROM media_events WHERE date >= {MONTH_CUT}""")
register("time_range_half_year", f"""
SELECT id, {TS}, media_name FROM media_events
WHERE date >= TIMESTAMP '2024-07-15 00:00:00' - INTERVAL 6 MONTH""")

PULL1 = "SELECT * FROM playback_log WHERE date < TIMESTAMP '2024-01-20 00:00:00'"
PULL2 = "SELECT * FROM playback_log WHERE CAST(date AS DATE) >= DATE '2024-01-18'"
register("incremental_pull", f"SELECT id, {TS}, name, '2024-01-18' AS pull_from FROM ({PULL2}) p")
register("high_water_mark", f"""
SELECT 1 AS pull, count(*) AS rows, max(id) AS mark FROM ({PULL1}) a
UNION ALL
SELECT 2 AS pull, count(*) AS rows, max(id) AS mark FROM ({PULL2}) b""")
register("high_water_filter", f"""
SELECT id, name FROM ({PULL2}) p WHERE id > (SELECT max(id) FROM ({PULL1}) a)""")
register("batch_counts", f"""
SELECT (SELECT count(*) FROM ({PULL2}) p) AS batch_rows,
       (SELECT count(*) FROM ({PULL2}) p WHERE id > (SELECT max(id) FROM ({PULL1}) a)) AS kept_rows""")

# ---- statistics -----------------------------------------------------------------------------
register("distinct_titles", "SELECT DISTINCT kind, title FROM titled")

STATS = f"""
stats AS (
  SELECT kind, title, views,
         CAST(row_number() OVER (PARTITION BY kind ORDER BY views DESC, title) AS INTEGER) AS rank
  FROM (SELECT kind, title, count(*) AS views FROM titled WHERE date >= {MONTH_CUT} GROUP BY kind, title) v
)"""
register("series_views", "SELECT title, views, rank FROM stats WHERE kind = 'series'", STATS)
register("movie_views", "SELECT title, views, rank FROM stats WHERE kind = 'movie'", STATS)


def search_ctes(terms: str, p: str = "") -> str:
    """CTEs ``{p}search`` and ``{p}resolved`` for the distinct, non-null ``term`` column of ``terms``."""
    return f"""
{p}search AS (
  SELECT term, item_id, item_type, item_title, tmdb_id FROM (
    SELECT s.term, c.item_id, c.type AS item_type, c.title AS item_title, c.tmdb_id,
           row_number() OVER (PARTITION BY s.term
                              ORDER BY CASE WHEN lower(c.title) = lower(s.term) THEN 0 ELSE 1 END,
                                       c.item_id) AS rn
    FROM (SELECT DISTINCT term FROM {terms} WHERE term IS NOT NULL) s
    JOIN catalogue c ON contains(lower(c.title), lower(s.term)) AND c.type IN ('Series', 'Movie')
  ) x WHERE rn = 1
),
{p}resolved AS (
  SELECT t.term, s.item_id, s.item_type, s.item_title, s.tmdb_id,
         CASE WHEN s.item_id IS NULL THEN 'no_item'
              WHEN s.tmdb_id IS NULL OR s.tmdb_id = '' THEN 'no_tmdb_id'
              WHEN e.en_title IS NULL THEN 'unresolved' ELSE 'ok' END AS status,
         CASE WHEN s.item_id IS NOT NULL AND s.tmdb_id IS NOT NULL AND s.tmdb_id <> ''
              THEN coalesce(e.en_title, s.item_title) END AS english_title,
         coalesce(g.genres, '') AS genres
  FROM (SELECT DISTINCT term FROM {terms} WHERE term IS NOT NULL) t
  LEFT JOIN {p}search s ON s.term = t.term
  LEFT JOIN en_lookup e ON e.tmdb_id = s.tmdb_id
  LEFT JOIN item_genre_str g ON g.item_id = s.item_id
)"""


STATS_TERMS = STATS + ",\nstat_terms AS (SELECT title AS term FROM stats)," + search_ctes("stat_terms")
register("view_statistics_english", """
SELECT st.kind, st.title, st.views, st.rank, r.english_title, r.status
FROM stats st LEFT JOIN resolved r ON r.term = st.title""", STATS_TERMS)
register("chart_table", """
SELECT st.kind AS panel,
       CASE WHEN st.kind = 'movie' THEN 'Number of views per movie for all users in one month'
            ELSE 'Number of views per TV series for all users in one month' END AS panel_title,
       st.rank AS position, coalesce(r.english_title, st.title) AS label, st.views
FROM stats st LEFT JOIN resolved r ON r.term = st.title""", STATS_TERMS)

# ---- catalogue lookups ----------------------------------------------------------------------
ALL_TERMS = "all_terms AS (SELECT DISTINCT kind, title, title AS term FROM titled)," + search_ctes("all_terms")
register("search_catalogue", """
SELECT a.kind, a.title, s.item_id, s.item_type, s.item_title, s.tmdb_id
FROM all_terms a LEFT JOIN search s ON s.term = a.term""", ALL_TERMS)
register("search_status", """
SELECT a.kind, a.title, r.status, r.english_title
FROM all_terms a JOIN resolved r ON r.term = a.term""", ALL_TERMS)
register("english_title_lookup", """
SELECT c.item_id, c.tmdb_id, coalesce(e.en_title, c.title) AS title, e.en_title IS NOT NULL AS cached
FROM catalogue c
LEFT JOIN (SELECT tmdb_id, min(title) AS en_title FROM english_titles GROUP BY tmdb_id) e
  ON e.tmdb_id = c.tmdb_id
WHERE c.tmdb_id IS NOT NULL""")
register("english_title_missing", """
SELECT c.item_id, c.tmdb_id, c.type FROM catalogue c
WHERE c.tmdb_id IS NOT NULL AND c.tmdb_id <> ''
  AND NOT EXISTS (SELECT 1 FROM english_titles e WHERE e.tmdb_id = c.tmdb_id)""")

# ---- genres and the movie recommendation chain ----------------------------------------------
register("genre_strings", "SELECT item_id, genres FROM item_genre_str")
register("genres_exploded", "SELECT item_id, genre FROM catalogue_genres")


def top_tail(p: str, counts: str, item_type: str) -> str:
    """CTEs from genre counts to the top-3 titles: ``{p}top3 {p}ids {p}tbg {p}hits {p}top_titles``."""
    return f"""
{p}top3 AS (
  SELECT genre, counts, CAST(row_number() OVER (ORDER BY counts DESC, genre) AS INTEGER) AS rank
  FROM {counts} ORDER BY counts DESC, genre LIMIT 3
),
{p}ids AS (SELECT name, id FROM genre_lookup WHERE name IN (SELECT genre FROM {p}top3)),
{p}tbg AS (
  SELECT i.id AS genre_id, c.item_id, c.title
  FROM {p}ids i JOIN catalogue_genres g ON g.genre = i.name JOIN catalogue c ON c.item_id = g.item_id
  WHERE c.type = '{item_type}'
),
{p}hits AS (SELECT title, count(*) AS hits FROM {p}tbg GROUP BY title),
{p}top_titles AS (
  SELECT title, hits, CAST(row_number() OVER (ORDER BY hits DESC, title) AS INTEGER) AS rank
  FROM {p}hits ORDER BY hits DESC, title LIMIT 3
),
{p}top_terms AS (SELECT title AS term FROM {p}top_titles),""" + search_ctes(f"{p}top_terms", f"{p}d_")


MOVIES = (
    "user_movies AS (SELECT DISTINCT title AS term FROM titled WHERE user_id = '1' AND kind = 'movie'),"
    + search_ctes("user_movies", "m_") + """,
m_usable AS (SELECT * FROM m_resolved WHERE status IN ('ok', 'unresolved')),
m_counts AS (SELECT g.genre, count(*) AS counts
             FROM m_usable u JOIN catalogue_genres g ON g.item_id = u.item_id GROUP BY g.genre),"""
    + top_tail("m_", "m_counts", "Movie")
)
register("genre_counts_movies", "SELECT genre, counts FROM m_counts", MOVIES)
register("top3_genres", "SELECT genre, counts, rank FROM m_top3", MOVIES)
register("genre_ids", "SELECT name, id FROM m_ids", MOVIES)
register("titles_by_genre_movie", "SELECT genre_id, item_id, title FROM m_tbg", MOVIES)
register("genre_hit_counts", "SELECT title, hits FROM m_hits", MOVIES)
register("top3_titles", "SELECT title, hits, rank FROM m_top_titles", MOVIES)
register("recommend_details", """
SELECT t.rank, t.title, r.item_id, r.english_title, r.status, r.genres
FROM m_top_titles t LEFT JOIN m_d_resolved r ON r.term = t.title""", MOVIES)
register("recommend_movies", """
SELECT t.rank, coalesce(r.english_title, t.title) AS title, coalesce(r.genres, '') AS genres, t.hits
FROM m_top_titles t LEFT JOIN m_d_resolved r ON r.term = t.title""", MOVIES)


# ---- FP-Growth, exactly, with genre sets as bit masks -----------------------------------------
def fp_ctes(p: str, baskets: str) -> str:
    """Frequent sets, rules and predictions over ``baskets(key, s)`` (``s`` a genre bit mask).

    Support 0.1 and confidence 0.2; ``{p}n`` counts the non-null baskets.
    """
    return f"""
{p}n AS (SELECT count(*) AS n FROM {baskets}),
{p}masks AS (SELECT unnest(range(1, (SELECT (1 << count(*)) FROM genre_bits))) AS m),
{p}freq AS (
  SELECT k.m, count(*) AS freq FROM {p}masks k JOIN {baskets} b ON (b.s & k.m) = k.m
  GROUP BY k.m HAVING count(*) >= ceil(0.1 * (SELECT n FROM {p}n))
),
{p}rules AS (
  SELECT f.m & ~(1 << g.bit) AS ante, g.bit AS cbit, g.name AS consequent,
         CAST(f.freq AS DOUBLE) / a.freq AS confidence,
         (CAST(f.freq AS DOUBLE) / a.freq) / (CAST(c.freq AS DOUBLE) / (SELECT n FROM {p}n)) AS lift,
         CAST(f.freq AS DOUBLE) / (SELECT n FROM {p}n) AS support
  FROM {p}freq f
  JOIN genre_bits g ON (f.m >> g.bit) & 1 = 1
  JOIN {p}freq a ON a.m = (f.m & ~(1 << g.bit))
  JOIN {p}freq c ON c.m = (1 << g.bit)
  WHERE bit_count(f.m) >= 2 AND CAST(f.freq AS DOUBLE) / a.freq >= 0.2
),
{p}pred AS (
  SELECT b.key, string_agg(DISTINCT r.consequent, ', ' ORDER BY r.consequent) AS prediction
  FROM {baskets} b JOIN {p}rules r ON (b.s & r.ante) = r.ante AND ((b.s >> r.cbit) & 1) = 0
  GROUP BY b.key
)"""


def mask_text(mask: str) -> str:
    return (f"(SELECT coalesce(string_agg(g.name, ', ' ORDER BY g.name), '') FROM genre_bits g "
            f"WHERE (({mask}) >> g.bit) & 1 = 1)")


GENRE_BITS = "genre_bits AS (SELECT name, CAST(id - 7501 AS INTEGER) AS bit FROM genre_lookup),"
ITEM_FP = GENRE_BITS + """
item_baskets AS (
  SELECT cg.item_id AS key, bit_or(1 << g.bit) AS s
  FROM catalogue_genres cg JOIN genre_bits g ON g.name = cg.genre GROUP BY cg.item_id
),""" + fp_ctes("i_", "item_baskets")
register("freq_itemsets", f"SELECT {mask_text('f.m')} AS items, f.freq FROM i_freq f", ITEM_FP)
register("association_rules", f"""
SELECT {mask_text('r.ante')} AS antecedent, r.consequent, round(r.confidence, 9) AS confidence,
       round(r.lift, 9) AS lift, round(r.support, 9) AS support
FROM i_rules r""", ITEM_FP)
register("rule_predictions", """
SELECT c.item_id, coalesce(gs.genres, '') AS basket, coalesce(p.prediction, '') AS prediction
FROM catalogue c
LEFT JOIN item_genre_str gs ON gs.item_id = c.item_id
LEFT JOIN i_pred p ON p.key = c.item_id""", ITEM_FP)
register("predicted_genres", """
SELECT p.key AS item_id, unnest(string_split(p.prediction, ', ')) AS genre FROM i_pred p""", ITEM_FP)

SERIES = (
    "user_series AS (SELECT DISTINCT title AS term FROM titled WHERE user_id = '1' AND kind = 'series'),"
    + search_ctes("user_series", "s_") + """,
s_hist AS (SELECT english_title AS Title, min(genres) AS Genres FROM s_resolved
           WHERE status IN ('ok', 'unresolved') GROUP BY english_title),
""" + GENRE_BITS + """
s_baskets AS (
  SELECT h.Title AS key, bit_or(1 << g.bit) AS s
  FROM s_hist h, unnest(string_split(h.Genres, ', ')) AS x(genre)
  JOIN genre_bits g ON g.name = x.genre GROUP BY h.Title
),""" + fp_ctes("s_", "s_baskets") + """,
s_counts AS (
  SELECT genre, count(*) AS counts
  FROM (SELECT unnest(string_split(prediction, ', ')) AS genre FROM s_pred) x GROUP BY genre
),""" + top_tail("s_", "s_counts", "Series")
)
register("dedup_titles_user", "SELECT Title, Genres FROM s_hist", SERIES)
register("predicted_genre_counts", "SELECT genre, counts FROM s_counts", SERIES)
register("titles_by_genre_series", "SELECT genre_id, item_id, title FROM s_tbg", SERIES)
register("recommend_series", """
SELECT t.rank, coalesce(r.english_title, t.title) AS title, coalesce(r.genres, '') AS genres, t.hits
FROM s_top_titles t LEFT JOIN s_d_resolved r ON r.term = t.title""", SERIES)

# ---- recommendations for all users ------------------------------------------------------------
def tail_all(p: str, item_type: str) -> str:
    """From ``{p}counts(user_id, genre, counts)`` to ``{p}out``: every user's top-3 titles with details."""
    return f"""
{p}top3 AS (
  SELECT user_id, genre FROM {p}counts
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY counts DESC, genre) <= 3
),
{p}hits AS (
  SELECT t.user_id, c.title, count(*) AS hits
  FROM {p}top3 t JOIN genre_lookup k ON k.name = t.genre JOIN catalogue_genres g ON g.genre = t.genre
  JOIN catalogue c ON c.item_id = g.item_id AND c.type = '{item_type}'
  GROUP BY t.user_id, c.title
),
{p}best AS (
  SELECT user_id, title, hits, CAST(row_number() OVER (PARTITION BY user_id ORDER BY hits DESC, title) AS INTEGER) AS rank
  FROM {p}hits QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY hits DESC, title) <= 3
),
{p}best_terms AS (SELECT DISTINCT title AS term FROM {p}best),""" + search_ctes(f"{p}best_terms", f"{p}d_") + f""",
{p}out AS (
  SELECT b.user_id, b.rank, coalesce(r.english_title, b.title) AS title, coalesce(r.genres, '') AS genres, b.hits
  FROM {p}best b LEFT JOIN {p}d_resolved r ON r.term = b.title
)"""


register("recommend_movies_all_users", "SELECT * FROM ma_out", """
ma_titles AS (SELECT DISTINCT user_id, title AS term FROM titled WHERE kind = 'movie'),""" + search_ctes("ma_titles", "ma_") + """,
ma_counts AS (
  SELECT t.user_id, g.genre, count(*) AS counts
  FROM ma_titles t JOIN ma_resolved r ON r.term = t.term AND r.status IN ('ok', 'unresolved')
  JOIN catalogue_genres g ON g.item_id = r.item_id GROUP BY ALL
),""" + tail_all("ma_", "Movie"))
register("recommend_series_all_users", "SELECT * FROM sa_out", GENRE_BITS + """
sa_titles AS (SELECT DISTINCT user_id, title AS term FROM titled WHERE kind = 'series'),""" + search_ctes("sa_titles", "sa_") + """,
sa_hist AS (
  SELECT t.user_id, r.english_title, min(r.genres) AS genres
  FROM sa_titles t JOIN sa_resolved r ON r.term = t.term AND r.status IN ('ok', 'unresolved') GROUP BY ALL
),
sa_baskets AS (
  SELECT h.user_id, h.english_title, bit_or(1 << g.bit) AS s
  FROM sa_hist h, unnest(string_split(h.genres, ', ')) AS x(genre) JOIN genre_bits g ON g.name = x.genre GROUP BY ALL
),
sa_n AS (SELECT user_id, count(*) AS n FROM sa_baskets GROUP BY user_id),
sa_masks AS (SELECT unnest(range(1, (SELECT (1 << count(*)) FROM genre_bits))) AS m),
sa_freq AS (
  SELECT b.user_id, k.m, count(*) AS freq FROM sa_masks k JOIN sa_baskets b ON (b.s & k.m) = k.m JOIN sa_n n ON n.user_id = b.user_id
  GROUP BY b.user_id, k.m, n.n HAVING count(*) >= ceil(0.1 * n.n)
),
sa_rules AS (
  SELECT f.user_id, a.m AS ante, g.bit AS cbit, g.name AS consequent
  FROM sa_freq f JOIN genre_bits g ON (f.m >> g.bit) & 1 = 1
  JOIN sa_freq a ON a.user_id = f.user_id AND a.m = (f.m & ~(1 << g.bit))
  WHERE CAST(f.freq AS DOUBLE) / a.freq >= 0.2
),
sa_pred AS (
  SELECT DISTINCT b.user_id, b.english_title, r.consequent
  FROM sa_baskets b JOIN sa_rules r ON r.user_id = b.user_id AND (b.s & r.ante) = r.ante AND ((b.s >> r.cbit) & 1) = 0
),
sa_counts AS (SELECT user_id, consequent AS genre, count(*) AS counts FROM sa_pred GROUP BY ALL),""" + tail_all("sa_", "Series"))

# ---- sources and sinks ------------------------------------------------------------------------
PULLS = """
bounds AS (SELECT min(id) AS lo, max(id) AS hi FROM playback_log),
pos AS (
  SELECT l.id, CAST(l.id - b.lo AS DOUBLE) AS pos, CAST(b.hi - b.lo + 1 AS DOUBLE) / 4 AS width
  FROM playback_log l, bounds b
),
kk AS (SELECT id, pos, width, CAST(least(floor(pos / width), 3) AS INTEGER) AS k FROM pos),
pulls AS (
  SELECT id, k + 1 AS pull FROM kk
  UNION ALL
  SELECT id, k + 2 AS pull FROM kk WHERE k + 1 <= 3 AND pos >= (k + 1) * width - 0.1 * width
)"""
register("pack_envelope", """
SELECT lpad(CAST(pull AS VARCHAR), CAST(greatest(length(CAST(pull AS VARCHAR)), 2) AS INTEGER), '0') AS file_no, count(DISTINCT floor(id / 5000)) AS documents,
       count(*) AS items, count(*) AS total_record_count
FROM pulls GROUP BY pull""", PULLS)
register("flatten_log", f"SELECT id, {TS}, user_id, type, name FROM playback_log")
register("item_names", "SELECT name FROM playback_log")
register("provider_id", "SELECT item_id, coalesce(tmdb_id, '') AS tmdb FROM catalogue")

HALVES = """
old_half AS (SELECT * FROM titled WHERE date < TIMESTAMP '2024-01-20 00:00:00'),
new_half AS (SELECT * FROM titled WHERE date >= TIMESTAMP '2024-01-20 00:00:00'),
old_series AS (SELECT DISTINCT title AS term FROM old_half WHERE kind = 'series'),
new_series AS (SELECT DISTINCT title AS term FROM new_half WHERE kind = 'series'),
old_movies AS (SELECT DISTINCT title AS term FROM old_half WHERE kind = 'movie'),
new_movies AS (SELECT DISTINCT title AS term FROM new_half WHERE kind = 'movie'),""" + ",".join([
    search_ctes("old_series", "os_"), search_ctes("new_series", "ns_"),
    search_ctes("old_movies", "om_"), search_ctes("new_movies", "nm_")]) + """,
os_hist AS (SELECT english_title AS Title, min(genres) AS Genres FROM os_resolved
            WHERE status IN ('ok', 'unresolved') GROUP BY english_title),
ns_hist AS (SELECT english_title AS Title, min(genres) AS Genres FROM ns_resolved
            WHERE status IN ('ok', 'unresolved') GROUP BY english_title),
half_counts AS (
  SELECT g.genre, count(*) AS counts FROM om_resolved u JOIN catalogue_genres g ON g.item_id = u.item_id
  WHERE u.status IN ('ok', 'unresolved') GROUP BY g.genre
  UNION ALL
  SELECT g.genre, count(*) AS counts FROM nm_resolved u JOIN catalogue_genres g ON g.item_id = u.item_id
  WHERE u.status IN ('ok', 'unresolved') GROUP BY g.genre
)"""
register("union_history", f"""
SELECT {TS}, media_name FROM media_events WHERE date >= {MONTH_CUT}""")
register("dedup_titles", """
SELECT Title, Genres FROM os_hist
UNION ALL
SELECT Title, Genres FROM ns_hist WHERE Title NOT IN (SELECT Title FROM os_hist)""", HALVES)
register("merge_genre_counts", """
SELECT genre, CAST(sum(counts) AS BIGINT) AS counts FROM half_counts GROUP BY genre""", HALVES)
register("history_or_empty", "SELECT Title, Genres FROM os_hist", HALVES)
register("csv_roundtrip", "SELECT kind, title, views, rank FROM stats", STATS)
register("denylist_scan", """
SELECT d.pattern, count(*) AS hits FROM playback p JOIN denylist d ON contains(p.name, d.pattern)
GROUP BY d.pattern""")
register("title_cache_append", """
SELECT tmdb_id, title FROM english_titles
UNION ALL
SELECT DISTINCT ON (tmdb_id) tmdb_id, item_title AS title FROM resolved WHERE status = 'unresolved'
""", ALL_TERMS)

# ---- streaming --------------------------------------------------------------------------------
register("stream_flatten", """
SELECT m.id, m.user_id, m.media_name FROM media_events m JOIN pulls p ON p.id = m.id""", PULLS)
register("stream_dedup", "SELECT id, user_id, media_name FROM media_events")
register("stream_rolling_stats", "SELECT kind, title, views, rank FROM stats", STATS)
register("stream_statistics", "SELECT kind, title, views, rank FROM stats", STATS)
FIRST_PULL = PULLS + """,
first_pull AS (SELECT id, min(pull) AS pull FROM pulls GROUP BY id),
batch_movies AS (
  SELECT DISTINCT f.pull, t.title AS term FROM titled t JOIN first_pull f ON f.id = t.id WHERE t.kind = 'movie'
),""" + search_ctes("batch_movies", "bm_") + """,
all_series AS (SELECT DISTINCT title AS term FROM titled WHERE kind = 'series'),""" + search_ctes("all_series", "as_")
register("stream_genre_counts", """
SELECT g.genre, count(*) AS counts
FROM batch_movies b JOIN bm_resolved r ON r.term = b.term
JOIN catalogue_genres g ON g.item_id = r.item_id
WHERE r.status IN ('ok', 'unresolved') GROUP BY g.genre""", FIRST_PULL)
register("stream_title_genres", """
SELECT english_title AS Title, min(genres) AS Genres FROM as_resolved
WHERE status IN ('ok', 'unresolved') GROUP BY english_title""", FIRST_PULL)
register("stream_daily_views", """
SELECT strftime(date, '%Y-%m-%d') AS day, kind, title, count(*) AS views
FROM titled GROUP BY 1, 2, 3""")

register("stream_daily_views_watermarked", """
SELECT strftime(t.date, '%Y-%m-%d') AS day, t.kind, t.title, count(*) AS views
FROM titled t JOIN (SELECT DISTINCT p.id FROM landed p JOIN media_events m ON m.id = p.id
                    WHERE p.mark IS NULL OR date_trunc('day', m.date) + INTERVAL 1 DAY > p.mark) k ON k.id = t.id
WHERE date_trunc('day', t.date) + INTERVAL 1 DAY <= (SELECT max(date) - INTERVAL 3 DAY FROM media_events)
GROUP BY 1, 2, 3""", PULLS + """,
place AS (SELECT id, CASE pull WHEN 3 THEN 4 WHEN 4 THEN 3 ELSE pull END AS place FROM pulls),
landed AS (SELECT p.id, (SELECT max(m.date) - INTERVAL 3 DAY FROM media_events m JOIN place q ON q.id = m.id AND q.place < s.place) AS mark
           FROM place p JOIN (SELECT DISTINCT place FROM place) s ON s.place = p.place)""")
register("stream_reject_counts", """
SELECT batch, reason, count(*) AS rejects FROM (
  SELECT DISTINCT CAST(pull - 1 AS INTEGER) AS batch, 'document' AS reason, CAST(floor(id / 5000) AS BIGINT) AS what FROM pulls WHERE floor(id / 5000) % 3 = 0
  UNION ALL
  SELECT CAST(pull - 1 AS INTEGER), 'date', id FROM pulls WHERE floor(id / 5000) % 5 = 0) x
GROUP BY batch, reason""", PULLS)
register("title_cache_append_typed", """
SELECT item_type, tmdb_id, min(title) AS title, batch FROM (
  SELECT item_type, tmdb_id, title, batch, min(batch) OVER (PARTITION BY item_type, tmdb_id) AS first FROM (
    SELECT type AS item_type, CAST(item_id % 500 AS VARCHAR) AS tmdb_id, title, CAST(item_id % 3 AS INTEGER) AS batch FROM catalogue) i) x
WHERE batch = first GROUP BY ALL""")
register("stream_dedup_out_of_order", "SELECT id, user_id, media_name FROM media_events")
register("stream_flatten_multiline", """
SELECT m.id, m.user_id, m.media_name FROM media_events m JOIN pulls p ON p.id = m.id""", PULLS)
register("stream_statistics_backlog", "SELECT kind, title, views, rank FROM stats", STATS)
SQL["stream_chart_table"] = SQL["chart_table"]
register("stream_rolling_window", """
SELECT b AS batch, kind, title, views,
       CAST(row_number() OVER (PARTITION BY b, kind ORDER BY views DESC, title) AS INTEGER) AS rank
FROM (SELECT e.b, t.kind, t.title, count(*) AS views
      FROM ends e JOIN first_pull f ON f.pull <= e.b + 1 JOIN titled t ON t.id = f.id
      WHERE t.date BETWEEN e.as_of - INTERVAL 1 WEEK AND e.as_of GROUP BY ALL) x""", PULLS + """,
first_pull AS (SELECT id, min(pull) AS pull FROM pulls GROUP BY id),
ends AS (SELECT CAST(p - 1 AS INTEGER) AS b, max(m.date) AS as_of
         FROM range(1, 5) r(p) JOIN first_pull f ON f.pull <= r.p JOIN media_events m ON m.id = f.id GROUP BY p)""")
USER_BATCHES = FIRST_PULL + """,
user_batches AS (SELECT DISTINCT f.pull, t.title AS term FROM titled t JOIN first_pull f ON f.id = t.id
                 WHERE t.user_id = '1' AND t.kind = 'movie'),""" + search_ctes("user_batches", "ub_") + """,
ub_counts AS (SELECT g.genre, count(*) AS counts FROM user_batches b JOIN ub_resolved r ON r.term = b.term
              JOIN catalogue_genres g ON g.item_id = r.item_id
              WHERE r.status IN ('ok', 'unresolved') GROUP BY g.genre),""" + top_tail("ub_", "ub_counts", "Movie")
register("stream_movie_recommendations", """
SELECT t.rank, coalesce(r.english_title, t.title) AS title, coalesce(r.genres, '') AS genres, t.hits
FROM ub_top_titles t LEFT JOIN ub_d_resolved r ON r.term = t.title""", USER_BATCHES)
SQL["stream_series_recommendations"] = SQL["recommend_series"]

# ---- cases that the other inputs do not reach ---------------------------------------------------
register("file_number_padding", """
SELECT pull, CASE WHEN pull < 10 THEN '0' ELSE '' END || CAST(pull AS VARCHAR) AS file_no
FROM (SELECT DISTINCT id % 1300 AS pull FROM playback_log) p""")
register("filter_denylist_regex", """
SELECT id, user_id, name FROM playback WHERE name IS NOT NULL AND NOT regexp_matches(name, 'CCTV5+|HD')""")
register("filter_denylist_parts", """
SELECT id, user_id, name FROM playback p WHERE name IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM part d WHERE contains(p.name, d.p_name || ' ' || CAST(d.p_partkey - d.p_partkey % 2 AS VARCHAR) || ' '))""")
register("time_range_mid_data", f"""
SELECT id, {TS}, media_name FROM media_events
WHERE date BETWEEN TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 1 WEEK AND TIMESTAMP '2024-01-20 00:00:00'""")
register("english_title_by_type", """
SELECT i.item_id, i.item_type, i.tmdb_id, coalesce(c.title, i.item_title) AS english_title,
       CASE WHEN c.title IS NULL THEN 'unresolved' ELSE 'ok' END AS status
FROM typed i LEFT JOIN (
  SELECT item_type, tmdb_id, arg_min('EN ' || item_type || ' ' || item_title, item_id) AS title
  FROM typed WHERE item_id % 5 <> 0 GROUP BY ALL) c ON c.item_type = i.item_type AND c.tmdb_id = i.tmdb_id""", """
typed AS (SELECT item_id, type AS item_type, title AS item_title, CAST(item_id % 500 AS VARCHAR) AS tmdb_id FROM catalogue)""")
register("search_contains", """
SELECT t.term AS title, s.item_id, s.item_type, s.item_title, s.tmdb_id
FROM part_terms t LEFT JOIN search s ON s.term = t.term""", """
part_terms AS (SELECT DISTINCT substr(lower(p_name), 2, 7) AS term FROM part
               UNION SELECT substr(lower(p_name), 1, 1) FROM part UNION SELECT '' FROM part),""" + search_ctes("part_terms"))
