"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each string runs on DuckDB with the driver's tables registered as views and
must return the same columns (names and values) as the Spark query of the
same key. Shared derivations are CTE snippets below.
"""

from __future__ import annotations

# documents -> article feed (same rule as tallyho.sources.fixtures.articles)
FEED_CTE = r"""
feed AS (
  SELECT CASE WHEN doc_id % 13 = 6 THEN 'bad'
              ELSE strftime(CAST(DATE '2015-02-18' + CAST(doc_id % 10 AS INTEGER) AS DATE), '%Y%m%d') || '000000' END
           || '-' || CAST(doc_id AS VARCHAR) || CASE WHEN doc_id % 13 = 7 THEN '-' ELSE '' END AS record_id,
         CASE WHEN doc_id % 11 <> 5 THEN CAST(DATE '2015-02-18' + CAST(doc_id % 10 AS INTEGER) AS DATE) END AS day,
         CASE WHEN doc_id % 17 <> 8 THEN array_to_string(
           list_transform(
             list_filter(string_split_regex(text, '[ \n]+'), lambda w: w <> ''),
             lambda w, i: w || ',' || CAST(i AS VARCHAR)),
           ';') || CASE WHEN doc_id % 7 = 3 THEN ';null,1;Type ParentCategory,2;Smith, John,3;Broken,4' ELSE '' END
         END AS AllNames
  FROM documents
)"""

TOKENS_CTE = r"""
toks AS (
  SELECT day, unnest(string_split(AllNames, ';')) AS tok FROM feed WHERE AllNames IS NOT NULL
)"""


def names_cte(strip: str = "last", name: str = "mentions") -> str:
    cut = (
        "CASE WHEN strpos(tok, ',') > 0 THEN regexp_replace(tok, ',[^,]*$', '') ELSE tok END"
        if strip == "last"
        else "split_part(tok, ',', 1)"
    )
    return f"""
{name} AS (
  SELECT day, name FROM (SELECT day, {cut} AS name FROM toks)
  WHERE day IS NOT NULL AND name IS NOT NULL AND name <> '' AND name NOT IN ('null', 'Type ParentCategory')
)"""


COUNTS_CTE = """
counts AS (SELECT day, name, CAST(count(*) AS BIGINT) AS n FROM mentions GROUP BY day, name)"""

RANKED_CTE = """
ranked AS (
  SELECT day, CAST(row_number() OVER (PARTITION BY day ORDER BY n DESC, name ASC) AS INTEGER) AS rank,
         name, n
  FROM counts
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


TOP_NAMES_PER_DAY = (
    _with(FEED_CTE, TOKENS_CTE, names_cte(), COUNTS_CTE, RANKED_CTE)
    + "\nSELECT day, rank, name, n FROM ranked WHERE rank <= 10"
)

NAME_COUNTS_PER_DAY = _with(FEED_CTE, TOKENS_CTE, names_cte(), COUNTS_CTE) + "\nSELECT day, name, n FROM counts"

TOP_NAMES_LIST = (
    _with(FEED_CTE, TOKENS_CTE, names_cte(), COUNTS_CTE, RANKED_CTE)
    + """
SELECT day, string_agg(name || ':' || CAST(n AS VARCHAR), ';' ORDER BY rank) AS top_names
FROM ranked WHERE rank <= 10 GROUP BY day"""
)

FIRST_DAYS_TOP = (
    _with(FEED_CTE, TOKENS_CTE, names_cte(), COUNTS_CTE, RANKED_CTE)
    + """
SELECT day, rank, name, n FROM ranked
WHERE rank <= 10
  AND day IN (SELECT day FROM (SELECT DISTINCT day FROM ranked) ORDER BY day LIMIT 5)"""
)

TOP_NAMES_FIRST_COMMA = (
    _with(FEED_CTE, TOKENS_CTE, names_cte("first"), COUNTS_CTE, RANKED_CTE)
    + "\nSELECT day, rank, name, n FROM ranked WHERE rank <= 10"
)

_LAST_CUT = "CASE WHEN strpos(tok, ',') > 0 THEN regexp_replace(tok, ',[^,]*$', '') ELSE tok END"

STRIP_FIRST_VS_LAST = (
    _with(FEED_CTE, TOKENS_CTE)
    + f"""
SELECT day, CAST(count(*) AS BIGINT) AS tokens,
       CAST(count(*) FILTER (WHERE {_LAST_CUT} <> split_part(tok, ',', 1)) AS BIGINT) AS differing
FROM toks WHERE tok <> '' GROUP BY day"""
)

NOISE_FILTERED = (
    _with(FEED_CTE, TOKENS_CTE)
    + f"""
SELECT day, CAST(count(*) AS BIGINT) AS tokens,
       CAST(count(*) FILTER (WHERE nm = '') AS BIGINT) AS empty_names,
       CAST(count(*) FILTER (WHERE nm <> '' AND nm IN ('null', 'Type ParentCategory')) AS BIGINT) AS noise_names,
       CAST(count(*) FILTER (WHERE nm <> '' AND nm NOT IN ('null', 'Type ParentCategory')) AS BIGINT) AS kept_names
FROM (SELECT day, {_LAST_CUT} AS nm FROM toks) GROUP BY day"""
)

FEED_LINE_REPORT = (
    _with(FEED_CTE)
    + """
SELECT CAST(count(*) AS BIGINT) AS lines, CAST(count(*) FILTER (WHERE AllNames IS NULL) AS BIGINT) AS short_lines,
       CAST(count(*) FILTER (WHERE AllNames IS NOT NULL AND day IS NULL) AS BIGINT) AS undated_lines,
       CAST(count(*) FILTER (WHERE AllNames = '') AS BIGINT) AS empty_name_lines
FROM feed"""
)

FEED_REJECTS = _with(FEED_CTE) + "\nSELECT record_id AS record_key FROM feed WHERE record_id LIKE 'bad-%'"

REJECT_REASONS = (
    _with(
        FEED_CTE,
        """
l AS (
  SELECT AllNames IS NULL AS short, record_id LIKE 'bad-%' AS no_stamp, AllNames IS NOT NULL AND day IS NULL AS undated,
         COALESCE(AllNames LIKE '%;Broken,4%', false) AS bad_bytes
  FROM feed
),
r AS (
  SELECT unnest(['lines', 'rejects', 'short', 'no_stamp', 'undated', 'bad_bytes']) AS reason,
         unnest([true, short OR no_stamp OR undated, short, no_stamp, undated, bad_bytes]) AS hit
  FROM l
)""",
    )
    + """
SELECT reason, CAST(count(*) FILTER (hit) AS BIGINT) AS seen, CAST(count(*) FILTER (hit) AS BIGINT) AS held
FROM r GROUP BY reason"""
)

# ---- events ---------------------------------------------------------------

KEYED_CTE = """
keyed AS (
  SELECT event_id, ts, strftime(ts, '%Y%m%d%H%M%S') || '-' || CAST(event_id AS VARCHAR) AS record_key,
         CAST(strftime(ts, '%Y%m%d%H%M%S') AS BIGINT) AS key_ts, event_id AS key_seq
  FROM events
)"""

# malformed keys among the events' (fixtures.edge_keys)
EDGE_KEYS_CTE = """
edge AS (
  SELECT event_id, CASE event_id % 23 WHEN 5 THEN 'x-1' WHEN 6 THEN record_key || '-' WHEN 7 THEN record_key || '-1'
           WHEN 8 THEN '5-' ELSE record_key END AS record_key,
         CASE WHEN event_id % 23 IN (5, 7, 8) THEN 0 ELSE key_ts END AS key_ts,
         CASE WHEN event_id % 23 IN (5, 7, 8) THEN 0 ELSE key_seq END AS key_seq
  FROM keyed
)"""

MENTIONS_CTE = """
m AS (SELECT event_id, 'user_' || CAST(user_id AS VARCHAR) AS name, ts FROM events)"""

LANDED_CTE = """
landed AS (
  SELECT DISTINCT strftime(time_bucket(INTERVAL 15 MINUTE, ts), '%Y%m%d%H%M') || '00.gkg.csv' AS file_name
  FROM events
)"""

EXPECTED_CTE = """
expected AS (
  SELECT strftime(g, '%Y%m%d%H%M') || '00.gkg.csv' AS file_name
  FROM (SELECT unnest(generate_series(min(time_bucket(INTERVAL 15 MINUTE, ts)),
                                      max(time_bucket(INTERVAL 15 MINUTE, ts)),
                                      INTERVAL 15 MINUTE)) AS g FROM events)
)"""

RECORD_KEY_PARTS = _with(KEYED_CTE, EDGE_KEYS_CTE) + "\nSELECT event_id, record_key, key_ts, key_seq FROM edge"

LAST_RECORD_KEY = (
    _with(KEYED_CTE, EDGE_KEYS_CTE)
    + """
SELECT COALESCE((SELECT CAST(key_ts AS VARCHAR) || '-' || CAST(key_seq AS VARCHAR)
                 FROM edge ORDER BY key_ts DESC, key_seq DESC LIMIT 1),
                '20150218230000-0') AS last_key"""
)

SLOT_BOUNDS = """
SELECT event_id,
       time_bucket(INTERVAL 15 MINUTE, ts) AS slot_start,
       time_bucket(INTERVAL 15 MINUTE, ts) + INTERVAL 15 MINUTE AS slot_end,
       strftime(time_bucket(INTERVAL 15 MINUTE, ts), '%Y%m%d%H%M') || '00.gkg.csv' AS segment,
       date_trunc('minute', ts) AS key_minute
FROM events"""

EXPECTED_SEGMENTS = _with(EXPECTED_CTE) + "\nSELECT file_name FROM expected"

MISSING_SEGMENTS = (
    _with(EXPECTED_CTE, LANDED_CTE)
    + "\nSELECT file_name FROM expected WHERE file_name NOT IN (SELECT file_name FROM landed)"
)

NEW_SEGMENTS = (
    _with(LANDED_CTE)
    + """
SELECT file_name,
       (SELECT max(file_name) FROM landed WHERE file_name > '20150218230000.gkg.csv') AS next_mark
FROM landed WHERE file_name > '20150218230000.gkg.csv'"""
)

SEGMENT_POLLS = (
    _with(
        LANDED_CTE,
        """
cut AS (SELECT a[len(a) // 2 + 1] AS seen, a[len(a) // 4 + 1] AS mark FROM (SELECT list_sort(list(file_name)) AS a FROM landed)),
one AS (SELECT file_name, max(file_name) OVER () AS next_mark FROM landed, cut WHERE file_name <= seen AND file_name > mark),
two AS (
  SELECT file_name, max(file_name) OVER () AS next_mark FROM landed
  WHERE file_name > COALESCE((SELECT max(next_mark) FROM one), (SELECT mark FROM cut))
)""",
    )
    + "\nSELECT 1 AS poll, * FROM one UNION ALL SELECT 2, * FROM two"
)

EVENT_TIME_SPREAD = """
WITH f AS (
  SELECT event_id, ts,
         strftime(time_bucket(INTERVAL 15 MINUTE, ts), '%Y%m%d%H%M') || '00.gkg.csv' AS file
  FROM events
), r AS (
  SELECT event_id, file,
         row_number() OVER (PARTITION BY file ORDER BY event_id) AS line_no,
         count(*) OVER (PARTITION BY file) AS lines,
         first_value(ts) OVER (PARTITION BY file ORDER BY event_id
                               ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS first_ts
  FROM f
)
SELECT event_id, file, CAST(line_no AS BIGINT) AS line_no, CAST(lines AS BIGINT) AS lines,
       CAST(epoch_ms(date_trunc('minute', first_ts)) + (line_no - 1) * (900000 // lines) AS BIGINT) AS event_ms
FROM r"""

_PACED = """
paced AS (
  SELECT event_id, strftime(ts, '%Y%m%d') AS file,
         CAST(900 + 1 - ntile(900) OVER (PARTITION BY strftime(ts, '%Y%m%d') ORDER BY event_id DESC) AS INTEGER)
           AS release_second
  FROM events
)"""

REPLAY_PACING = _with(_PACED) + "\nSELECT event_id, file, release_second FROM paced"

REPLAY_BATCHES = (
    _with(_PACED)
    + "\nSELECT file, release_second, CAST(count(*) AS BIGINT) AS rows FROM paced GROUP BY file, release_second"
)

CHANGELOG_CTE = """
steps AS (
  SELECT name, event_id, 'arrival' AS kind, ts AS change_ts, 1 AS d FROM m
  UNION ALL
  SELECT name, event_id, 'expiry' AS kind, ts + INTERVAL 60 MINUTE AS change_ts, -1 AS d FROM m
), log AS (
  SELECT name, event_id, kind, change_ts, d,
         CAST(sum(d) OVER (PARTITION BY name ORDER BY change_ts, d, event_id
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS n
  FROM steps
)"""

TRAILING_CHANGELOG = _with(MENTIONS_CTE, CHANGELOG_CTE) + "\nSELECT name, event_id, kind, change_ts, n FROM log"

TRAILING_COUNT = (
    _with(MENTIONS_CTE, CHANGELOG_CTE)
    + "\nSELECT name, event_id, change_ts AS ts, n FROM log WHERE kind = 'arrival'"
)

LATEST_CTE = """
latest AS (
  SELECT name, n FROM (
    SELECT name, n, row_number() OVER (PARTITION BY name ORDER BY change_ts DESC, d DESC, event_id DESC) AS rn
    FROM log WHERE change_ts <= (SELECT max(ts) FROM events)
  ) WHERE rn = 1 AND n > 0
)"""

BOARD_CTE = """
board AS (
  SELECT CAST(row_number() OVER (ORDER BY n DESC, name ASC) AS INTEGER) AS rank, name, n FROM latest
  QUALIFY rank <= 100
)"""

LATEST_PER_NAME = _with(MENTIONS_CTE, CHANGELOG_CTE, LATEST_CTE) + "\nSELECT name, n FROM latest"

BOARD_100 = _with(MENTIONS_CTE, CHANGELOG_CTE, LATEST_CTE, BOARD_CTE) + "\nSELECT rank, name, n FROM board"

BOARD_FLOOR = (
    _with(MENTIONS_CTE, CHANGELOG_CTE, LATEST_CTE, BOARD_CTE)
    + """
SELECT CAST(count(*) AS BIGINT) AS entries, min(n) AS floor_n,
       (SELECT name FROM board ORDER BY n, name LIMIT 1) AS floor_name
FROM board"""
)

BOARD_SNAPSHOT = (
    _with(MENTIONS_CTE, CHANGELOG_CTE, LATEST_CTE, BOARD_CTE)
    + """
SELECT '[' || string_agg('{"name":"' || name || '","count":' || CAST(n AS VARCHAR) || '}', ',' ORDER BY name)
       || ']' AS message
FROM board"""
)

BOARD_DELTAS = (
    _with(MENTIONS_CTE, CHANGELOG_CTE)
    + """,
per_bucket AS (
  SELECT bucket, name, n AS cnt FROM (
    SELECT time_bucket(INTERVAL 1 HOUR, change_ts) AS bucket, name, n,
           row_number() OVER (PARTITION BY time_bucket(INTERVAL 1 HOUR, change_ts), name
                              ORDER BY change_ts DESC, d DESC, event_id DESC) AS rn
    FROM log
  ) WHERE rn = 1
)
SELECT bucket, part, CAST(count(*) AS BIGINT) AS entries,
       '[' || string_agg('{"name":"' || name || '","count":' || CAST(cnt AS VARCHAR) || '}', ',' ORDER BY name)
           || ']' AS message
FROM (SELECT *, (row_number() OVER (PARTITION BY bucket ORDER BY name) - 1) // 10000 AS part
      FROM per_bucket)
GROUP BY bucket, part"""
)

COMPACTED_COUNTS = "SELECT event_type, CAST(count(*) AS BIGINT) AS rows FROM events GROUP BY event_type"

HOURLY_SLIDING_COUNTS = """
WITH w AS (
  SELECT 'user_' || CAST(user_id AS VARCHAR) AS name,
         unnest(generate_series(time_bucket(INTERVAL 5 MINUTE, ts) - INTERVAL 55 MINUTE,
                                time_bucket(INTERVAL 5 MINUTE, ts), INTERVAL 5 MINUTE)) AS window_start
  FROM events
)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, name, CAST(count(*) AS BIGINT) AS n
FROM w GROUP BY window_start, name"""

FEED_STREAM_TOP = (
    "WITH "
    + FEED_CTE.strip()
    + r""",
lines AS (
  SELECT AllNames, split_part(record_id, '-', 1) AS seg,
         CAST(split_part(record_id, '-', 2) AS BIGINT) AS seq
  FROM feed WHERE record_id NOT LIKE 'bad-%'
),
spread AS (
  SELECT AllNames,
         epoch_ms(strptime(substr(seg, 1, 12), '%Y%m%d%H%M')) AS start_ms,
         row_number() OVER (PARTITION BY seg ORDER BY seq) AS line_no,
         count(*) OVER (PARTITION BY seg) AS lines
  FROM lines
),
timed AS (
  SELECT AllNames, make_timestamp((start_ms + (line_no - 1) * (900000 // lines)) * 1000) AS ts
  FROM spread
),
toks AS (SELECT ts, unnest(string_split(AllNames, ';')) AS tok FROM timed WHERE AllNames <> ''),
named AS (
  SELECT ts, name FROM (
    SELECT ts, CASE WHEN strpos(tok, ',') > 0 THEN regexp_replace(tok, ',[^,]*$', '') ELSE tok END AS name
    FROM toks)
  WHERE name IS NOT NULL AND name <> '' AND name NOT IN ('null', 'Type ParentCategory')
),
w AS (
  SELECT name,
         unnest(generate_series(time_bucket(INTERVAL 15 MINUTE, ts) - INTERVAL 45 MINUTE,
                                time_bucket(INTERVAL 15 MINUTE, ts), INTERVAL 15 MINUTE)) AS window_start
  FROM named
),
counts AS (SELECT window_start, name, count(*) AS n FROM w GROUP BY window_start, name),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY n DESC, name) AS rank FROM counts
)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, CAST(rank AS INTEGER) AS rank,
       name, CAST(n AS BIGINT) AS n
FROM ranked WHERE rank <= 10"""
)

# Besides those windows, the board: names by their mentions of the last hour at the
# newest time less 10 minutes.
STREAM_OUTPUTS = (
    FEED_STREAM_TOP[: FEED_STREAM_TOP.rindex("\nSELECT window_start")]
    + """,
mark AS (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE AS mark FROM named),
live AS (
  SELECT name, count(*) AS n FROM named, mark
  WHERE ts <= mark AND ts + INTERVAL 1 HOUR > mark GROUP BY name
)
SELECT window_start, CAST(rank AS INTEGER) AS rank, name, CAST(n AS BIGINT) AS n FROM ranked WHERE rank <= 10
UNION ALL
SELECT NULL, CAST(row_number() OVER (ORDER BY n DESC, name) AS INTEGER) AS rank, name, n
FROM live QUALIFY rank <= 100"""
)

# The board as of each landing's watermark: the newest time landed so far less
# 10 minutes, in milliseconds. Rows land late by the rule of
# catalog._stream_table, in 4 slices of the arrival.
_BOARDS = (
    MENTIONS_CTE.strip(),
    CHANGELOG_CTE,
    """
late AS (SELECT ts, epoch_us(ts) + (event_id * 7919 % 540) * 1000000 AS arrival FROM events),
width AS (SELECT min(arrival) AS lo, greatest(1, CAST(ceil((max(arrival) + 1 - min(arrival)) / 4.0) AS BIGINT)) AS w FROM late),
marks AS (
  SELECT k, (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE FROM late WHERE arrival < lo + k * w) AS mark
  FROM width, (SELECT unnest([1, 2, 3, 4]) AS k)
),
counted AS (
  SELECT k, name, n FROM (
    SELECT k, name, n, row_number() OVER (PARTITION BY k, name ORDER BY change_ts DESC, d DESC, event_id DESC) AS rn
    FROM marks JOIN log ON change_ts <= mark
  ) WHERE rn = 1 AND n > 0
),
boards AS (
  SELECT k, CAST(row_number() OVER (PARTITION BY k ORDER BY n DESC, name) AS INTEGER) AS rank, name, n
  FROM counted QUALIFY rank <= 100
),
deltas AS (
  SELECT COALESCE(b.k, a.k + 1) AS k, COALESCE(b.name, a.name) AS name, COALESCE(b.n, 0) AS count
  FROM (SELECT * FROM boards WHERE k < 4) a FULL JOIN boards b ON a.k + 1 = b.k AND a.name = b.name
  WHERE a.n IS DISTINCT FROM b.n
),
steps_of AS (SELECT *, CAST(dense_rank() OVER (ORDER BY k) AS INTEGER) AS step FROM deltas)""",
)

BOARD_EVICTIONS = _with(*_BOARDS) + "\nSELECT step, name, count FROM steps_of"

STORED_COUNTS = _with(*_BOARDS) + "\nSELECT name, n FROM counted WHERE k = 4"

STREAM_BOARD = (
    _with(*_BOARDS)
    + "\nSELECT step, rank, name, n FROM boards JOIN (SELECT DISTINCT k, step FROM steps_of) USING (k)"
)

SQL: dict[str, str] = {
    "top_names_per_day": TOP_NAMES_PER_DAY,
    "name_counts_per_day": NAME_COUNTS_PER_DAY,
    "top_names_list": TOP_NAMES_LIST,
    "first_days_top": FIRST_DAYS_TOP,
    "top_names_first_comma": TOP_NAMES_FIRST_COMMA,
    "strip_first_vs_last": STRIP_FIRST_VS_LAST,
    "noise_filtered": NOISE_FILTERED,
    "feed_file_top_names": TOP_NAMES_PER_DAY,
    "feed_view_top_names": TOP_NAMES_PER_DAY,
    "feed_line_top_names": TOP_NAMES_PER_DAY,
    "feed_line_report": FEED_LINE_REPORT,
    "record_key_parts": RECORD_KEY_PARTS,
    "last_record_key": LAST_RECORD_KEY,
    "slot_bounds": SLOT_BOUNDS,
    "expected_segments": EXPECTED_SEGMENTS,
    "missing_segments": MISSING_SEGMENTS,
    "new_segments": NEW_SEGMENTS,
    "segment_polls": SEGMENT_POLLS,
    "feed_rejects": FEED_REJECTS,
    "reject_reasons": REJECT_REASONS,
    "event_time_spread": EVENT_TIME_SPREAD,
    "replay_pacing": REPLAY_PACING,
    "replay_batches": REPLAY_BATCHES,
    "trailing_changelog": TRAILING_CHANGELOG,
    "trailing_count": TRAILING_COUNT,
    "latest_per_name": LATEST_PER_NAME,
    "board_100": BOARD_100,
    "board_floor": BOARD_FLOOR,
    "board_snapshot": BOARD_SNAPSHOT,
    "board_deltas": BOARD_DELTAS,
    "flush_deltas": BOARD_DELTAS.replace("INTERVAL 1 HOUR", "INTERVAL 1 SECOND"),
    "compacted_counts": COMPACTED_COUNTS,
    "packed_counts": COMPACTED_COUNTS,
    "incremental_top_names": TOP_NAMES_PER_DAY,
    "upserted_counts": LATEST_PER_NAME,
    "feed_stream_top": FEED_STREAM_TOP,
    "stream_outputs": STREAM_OUTPUTS,
    "hourly_sliding_counts": HOURLY_SLIDING_COUNTS,
    "stateful_trailing": TRAILING_COUNT,
    "stateful_changelog": TRAILING_CHANGELOG,
    "stream_flush": BOARD_DELTAS.replace("INTERVAL 1 HOUR", "INTERVAL 1 SECOND"),
    "segment_stream": SEGMENT_POLLS,
    "stored_counts": STORED_COUNTS,
    "board_evictions": BOARD_EVICTIONS,
    "stream_board": STREAM_BOARD,
}
