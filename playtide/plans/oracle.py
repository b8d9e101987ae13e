"""The same queries as SQL for an independent engine, over the same tables."""

from __future__ import annotations

from playtide.schema import MONITOR_FEATURES, PAGE_VOCABULARY
from playtide.sources.adapters import CHROME_AGENT, DAY_MS, FIREFOX_AGENT, OTHER_AGENT, REGISTRATION_START_MS

EVENTS = f"""
keyed AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
raw AS (
  SELECT epoch_us(ts) // 1000 AS ts, CAST(user_id AS VARCHAR) AS "userId",
    user_id * 100 + (day(ts) - 1) // 3 AS "sessionId",
    CASE event_type WHEN 'view' THEN 'NextSong'
      WHEN 'click' THEN CASE WHEN k % 2 = 0 THEN 'Thumbs Up' ELSE 'Add to Playlist' END
      WHEN 'error' THEN CASE k % 3 WHEN 0 THEN 'Error' WHEN 1 THEN 'Help' ELSE 'Thumbs Down' END
      WHEN 'signup' THEN CASE WHEN k % 2 = 0 THEN 'Home' ELSE 'Settings' END
      WHEN 'purchase' THEN CASE WHEN k % 20 = 0 THEN 'Downgrade' ELSE 'Upgrade' END END AS page,
    CASE WHEN event_id % 3 = 0 THEN 'paid' ELSE 'free' END AS level,
    event_id AS "itemInSession",
    CASE user_id % 5 WHEN 0 THEN 'New York, NY' WHEN 1 THEN 'Chicago, IL' WHEN 2 THEN 'Guam'
      WHEN 4 THEN 'Austin, TX' END AS location,
    CASE user_id % 4 WHEN 0 THEN '{CHROME_AGENT}' WHEN 1 THEN '{FIREFOX_AGENT}' WHEN 2 THEN '{OTHER_AGENT}'
      END AS "userAgent",
    {REGISTRATION_START_MS} + user_id * {DAY_MS} AS registration,
    CASE WHEN user_id % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
    CASE WHEN event_type = 'view' THEN 'artist_' || (k % 8) END AS artist,
    CASE WHEN event_type = 'view' THEN 'song_' || (k % 40) END AS song,
    CASE WHEN event_type = 'view' THEN value END AS duration
  FROM keyed),
silver AS (
  SELECT *, make_timestamp(ts * 1000) AS event_time, make_timestamp(registration * 1000) AS registration_time,
    string_split(location, ', ')[1] AS city, string_split(location, ', ')[2] AS state,
    coalesce(nullif(regexp_extract("userAgent", '(Firefox|Chrome|Safari|Opera|Edge)', 1), ''), 'Unknown') AS browser,
    coalesce(nullif(regexp_extract("userAgent", '(Windows|Macintosh|Android|iPhone|Linux)', 1), ''), 'Unknown') AS os
  FROM raw),
mid AS (SELECT CAST(floor((min(ts) + max(ts)) / 2) AS BIGINT) AS middle FROM raw)
"""

ORDER_PLAYS = """
plays AS (
  SELECT CAST(o_custkey AS VARCHAR) AS "userId", CAST(l_partkey AS VARCHAR) AS song, p_brand AS artist
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)
"""

EVENT_PLAYS = """plays AS (SELECT "userId", song, artist FROM silver WHERE page = 'NextSong')"""

# Counts of plays, activity limits on the totals before any filtering.
MATRIX = """
counted AS (
  SELECT "userId", song, artist, count(*) AS play_count FROM plays
  WHERE "userId" IS NOT NULL AND song IS NOT NULL AND artist IS NOT NULL GROUP BY ALL),
matrix AS (
  SELECT * FROM counted
  WHERE "userId" IN (SELECT "userId" FROM counted GROUP BY 1 HAVING sum(play_count) >= 2)
    AND song IN (SELECT song FROM counted GROUP BY 1 HAVING sum(play_count) >= 2))
"""

ENCODED = """
users AS (SELECT "userId", CAST(row_number() OVER (ORDER BY "userId") - 1 AS INTEGER) AS user_idx
  FROM (SELECT DISTINCT "userId" FROM matrix)),
songs AS (SELECT song, CAST(row_number() OVER (ORDER BY song) - 1 AS INTEGER) AS song_idx
  FROM (SELECT DISTINCT song FROM matrix)),
encoded AS (SELECT matrix."userId", matrix.song, artist, user_idx, song_idx, play_count, CAST(1.0 AS DOUBLE) AS label
  FROM matrix JOIN users ON matrix."userId" = users."userId" JOIN songs ON matrix.song = songs.song)
"""


def hash60(*parts: str) -> str:
    return f"('0x' || substr(md5(concat_ws(':', {', '.join(parts)})), 1, 15))::BIGINT"


def uniform(*parts: str) -> str:
    return f"({hash60(*parts)} / 1152921504606846976::DOUBLE)"


NEGATIVES = f"""
pairs AS (SELECT DISTINCT user_idx, song_idx FROM encoded),
unseen AS (
  SELECT user_idx, song_idx, row_number() OVER (PARTITION BY user_idx ORDER BY song_idx) - 1 AS place,
    count(*) OVER (PARTITION BY user_idx) AS size
  FROM (SELECT user_idx, song_idx FROM (SELECT DISTINCT user_idx FROM pairs), songs) ANTI JOIN pairs USING (user_idx, song_idx)),
sizes AS (SELECT DISTINCT user_idx, size FROM unseen),
draws AS (
  SELECT user_idx, {hash60("'42'", "user_idx", "song_idx", "draw")} % size AS place
  FROM pairs JOIN sizes USING (user_idx) CROSS JOIN (SELECT unnest(range(1, 5)) AS draw)),
negatives AS (
  SELECT user_idx, song_idx, CAST(0 AS BIGINT) AS play_count, CAST(0.0 AS DOUBLE) AS label
  FROM draws JOIN unseen USING (user_idx, place)),
training AS (
  SELECT user_idx, song_idx, play_count, label FROM encoded UNION ALL SELECT * FROM negatives)
"""


def split_case(value: str, shares: dict[str, float]) -> str:
    names, upper, arms = list(shares), 0.0, []
    for name in names[:-1]:
        upper += shares[name]
        arms.append(f"WHEN {value} < {round(upper, 12)}::DOUBLE THEN '{name}'")
    return f"CASE {' '.join(arms)} ELSE '{names[-1]}' END"


PARTS = {"train": 0.70, "val": 0.15, "test": 0.15}
HOLDOUT = {"train": 0.8, "test": 0.2}

_key = ("'42'", "CAST(label AS VARCHAR)", "user_idx", "song_idx")
SPLIT_EXACT = f"""
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY h, user_idx, song_idx) - 1 AS position,
    count(*) OVER (PARTITION BY label) AS size
  FROM (SELECT *, {hash60(*_key)} AS h FROM training)),
exact AS (
  SELECT user_idx, song_idx, play_count, label, {split_case("position / size::DOUBLE", PARTS)} AS split FROM ranked)
"""


def page_counts() -> str:
    named = {
        "total_songs": "NextSong",
        "thumbs_down": "Thumbs Down",
        "thumbs_up": "Thumbs Up",
        "settings_visits": "Settings",
        "help_visits": "Help",
        "downgrade_count": "Downgrade",
        "cancel_count": "Cancellation Confirmation",
    }
    return ", ".join(f"count(*) FILTER (page = '{page}') AS {name}" for name, page in named.items())


_days = """CAST(date_diff('day', CAST(min(event_time) AS DATE),
  (SELECT CAST(max(event_time) AS DATE) FROM silver)) + 1 AS INTEGER) AS days_active"""
_ratios = """CASE WHEN total_songs > 0 THEN thumbs_down / total_songs::DOUBLE ELSE 0.0::DOUBLE END AS dislike_ratio,
  CASE WHEN days_active > 0 THEN total_sessions / days_active::DOUBLE ELSE 0.0::DOUBLE END AS avg_sessions_per_day"""

V1 = f"""
v1_counts AS (
  SELECT "userId", level, gender, {page_counts()}, count("sessionId") AS total_sessions, {_days}
  FROM silver GROUP BY "userId", level, gender),
v1 AS (SELECT *, {_ratios} FROM v1_counts)
"""

V2 = f"""
v2_counts AS (
  SELECT "userId", {page_counts()}, count(*) FILTER (page = 'Error') AS error_visits,
    count(*) FILTER (page IN ('Add Friend', 'Add to Playlist')) AS social_actions,
    count(*) FILTER (page = 'Upgrade') AS upgrade_count, count("sessionId") AS total_sessions, {_days}
  FROM silver GROUP BY "userId"),
newest AS (
  SELECT "userId", level AS current_level, gender FROM silver
  QUALIFY row_number() OVER (PARTITION BY "userId" ORDER BY event_time DESC, level DESC, gender DESC) = 1),
v2 AS (
  SELECT v2_counts.*, current_level, gender, {_ratios},
    CASE WHEN thumbs_down > 0 THEN thumbs_up / thumbs_down::DOUBLE ELSE thumbs_up + 1.0::DOUBLE END AS like_dislike_ratio,
    CASE WHEN total_sessions > 0 THEN error_visits / total_sessions::DOUBLE ELSE 0.0::DOUBLE END AS error_rate
  FROM v2_counts JOIN newest USING ("userId")),
labelled AS (
  SELECT *,
    CAST(current_level = 'free' AND (cancel_count > 0 OR downgrade_count > 0) AS INTEGER) AS churn_new,
    CAST(cancel_count > 0 OR current_level = 'free' AS INTEGER) AS churn_old
  FROM v2)
"""


def monitor(name: str, source: str) -> str:
    return f"""
{name}_counts AS (
  SELECT "userId", count(*) FILTER (page = 'NextSong') AS total_songs,
    count(*) FILTER (page = 'Thumbs Down') AS thumbs_down, count(*) FILTER (page = 'Thumbs Up') AS thumbs_up,
    count(*) FILTER (page = 'Settings') AS settings_visits, count(*) FILTER (page = 'Help') AS help_visits,
    count(DISTINCT "sessionId") AS total_sessions,
    CAST(greatest(1, (epoch_us((SELECT max(event_time) FROM {source})) - epoch_us(min(event_time))) // 86400000000)
      AS INTEGER) AS days_active
  FROM {source} GROUP BY "userId"),
{name} AS (SELECT *, {_ratios} FROM {name}_counts)
"""


_long = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS value, '{{side}}' AS side FROM {{table}}"
    for f in MONITOR_FEATURES
)
DRIFT = f"""
early AS (SELECT * FROM silver WHERE ts <= (SELECT middle FROM mid)),
{monitor("base", "early")}, {monitor("cur", "silver")},
long AS ({_long.format(side="ref", table="base")} UNION ALL {_long.format(side="cur", table="cur")}),
stats AS (
  SELECT feature, count(*) FILTER (side = 'ref') AS n_ref, count(*) FILTER (side = 'cur') AS n_cur,
    avg(value) FILTER (side = 'ref') AS ref_mean, avg(value) FILTER (side = 'cur') AS cur_mean,
    stddev_samp(value) FILTER (side = 'ref') AS ref_std, stddev_samp(value) FILTER (side = 'cur') AS cur_std
  FROM long GROUP BY feature),
steps AS (
  SELECT feature, value, count(*) FILTER (side = 'ref') AS r, count(*) FILTER (side = 'cur') AS c
  FROM long GROUP BY feature, value),
cdf AS (
  SELECT feature, sum(r) OVER w AS cr, sum(c) OVER w AS cc FROM steps WINDOW w AS (PARTITION BY feature ORDER BY value)),
gaps AS (
  SELECT feature, max(abs(cr / n_ref::DOUBLE - cc / n_cur::DOUBLE)) AS ks_statistic
  FROM cdf JOIN stats USING (feature) GROUP BY feature),
scaled AS (
  SELECT *, ks_statistic * sqrt(n_ref::DOUBLE * n_cur / (n_ref + n_cur)) AS lam FROM gaps JOIN stats USING (feature)),
drift AS (
  SELECT *, CASE WHEN lam < 0.2 THEN 1.0::DOUBLE ELSE least(1.0::DOUBLE, greatest(0.0::DOUBLE,
    (SELECT sum(CASE WHEN k % 2 = 1 THEN 2.0::DOUBLE ELSE -2.0::DOUBLE END * exp(-2.0::DOUBLE * k * k * lam * lam))
     FROM range(1, 101) AS t(k)))) END AS p_value
  FROM scaled),
summary AS (
  SELECT max(n_ref) AS n_baseline_users, max(n_cur) AS n_current_users,
    CAST(count(*) FILTER (p_value < 0.05) AS INTEGER) AS n_drifted_cols, CAST(count(*) AS INTEGER) AS n_total_cols,
    list(feature ORDER BY feature) FILTER (p_value < 0.05) AS names
  FROM drift)
"""

_codes = " ".join(f"WHEN '{page}' THEN {code}" for code, page in enumerate(PAGE_VOCABULARY))


def sequences(source: str, min_len: int = 3) -> str:
    return f"""
ordered AS (
  SELECT "userId", "sessionId", CASE page {_codes} ELSE 0 END AS code,
    row_number() OVER (PARTITION BY "userId", "sessionId" ORDER BY ts, "itemInSession", page) AS position
  FROM {source} WHERE page IS NOT NULL AND "sessionId" IS NOT NULL),
sequences AS (
  SELECT "userId", "sessionId", count(*) AS session_length,
    list(code ORDER BY position) FILTER (position <= 50) AS codes
  FROM ordered GROUP BY "userId", "sessionId" HAVING count(*) >= {min_len})
"""


PART_REST_MS = 6 * 3_600_000

# paths: diagonal by diagonal, the share of lattice paths that have stayed nearer than the statistic
DAYS_DRIFT = f"""
daily AS (
  SELECT floor(ts / {DAY_MS})::BIGINT AS day, count(*)::DOUBLE AS streams, count(DISTINCT "userId")::DOUBLE AS users FROM silver GROUP BY 1),
sided AS (SELECT *, day <= (SELECT avg(day) FROM daily) AS ref FROM daily),
longer AS (
  SELECT 'streams' AS feature, streams AS value, ref FROM sided UNION ALL SELECT 'users', users, ref FROM sided),
sizes AS (SELECT feature, count(*) FILTER (ref) AS n_ref, count(*) FILTER (NOT ref) AS n_cur FROM longer GROUP BY feature),
steps AS (
  SELECT feature, count(*) FILTER (ref) OVER w AS below_ref, count(*) FILTER (NOT ref) OVER w AS below_cur FROM longer
  WINDOW w AS (PARTITION BY feature ORDER BY value RANGE UNBOUNDED PRECEDING)),
stat AS (
  SELECT feature, any_value(n_ref) AS n_ref, any_value(n_cur) AS n_cur, max(abs(below_ref / n_ref::DOUBLE - below_cur / n_cur::DOUBLE)) AS ks,
    max(abs(below_ref * n_cur - below_cur * n_ref)) AS reach
  FROM steps JOIN sizes USING (feature) GROUP BY feature),
paths AS (
  SELECT feature, n_ref, n_cur, ks, reach, 0::BIGINT AS s, list_transform(range(0, n_ref + 1), lambda i: CASE WHEN i = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS u
  FROM stat
  UNION ALL
  SELECT feature, n_ref, n_cur, ks, reach, s + 1,
    list_transform(range(0, n_ref + 1), lambda i:
      CASE WHEN s + 1 - i >= 0 AND s + 1 - i <= n_cur AND abs(i * n_cur - (s + 1 - i) * n_ref) < reach
        THEN (CASE WHEN i > 0 THEN i * u[i] ELSE 0 END + (s + 1 - i) * u[i + 1]) / (s + 1)::DOUBLE ELSE 0.0::DOUBLE END)
  FROM paths WHERE s < n_ref + n_cur)
"""


SHARES = f"""
{V1},
scored AS (
  SELECT *, 1 - total_songs / greatest(total_sessions, 1)::DOUBLE AS churn_prob,
    CASE WHEN 1 - total_songs / greatest(total_sessions, 1)::DOUBLE > 0.8 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction,
    CAST(cancel_count > 0 OR downgrade_count > 0 AS INTEGER) AS churn
  FROM v1)
"""


def tier(inclusive: bool) -> str:
    op = ">=" if inclusive else ">"
    return (
        f"CASE WHEN churn_prob {op} 0.7::DOUBLE THEN 'high' WHEN churn_prob {op} 0.4::DOUBLE THEN 'medium' ELSE 'low' END"
    )


# Ranking candidates: a walk over the catalogue modulo the next prime.
def candidates(positives: str, known: str) -> str:
    return f"""
size AS (
  SELECT n, (SELECT min(p) FROM range(greatest(n, 2), 2 * n + 3) AS t(p)
    WHERE NOT EXISTS (SELECT 1 FROM range(2, p) AS d(v) WHERE p % v = 0)) AS prime
  FROM (SELECT count(*) AS n FROM songs)),
sampled AS (
  SELECT user_idx FROM (SELECT DISTINCT user_idx FROM {positives})
  ORDER BY {hash60("'42'", "user_idx")}, user_idx LIMIT 500),
chosen AS (
  SELECT user_idx, song_idx FROM (SELECT DISTINCT user_idx, song_idx FROM {positives})
  WHERE user_idx IN (SELECT user_idx FROM sampled)
  QUALIFY row_number() OVER (PARTITION BY user_idx ORDER BY {hash60("'42'", "user_idx", "song_idx")}, song_idx) = 1),
heard AS (
  SELECT DISTINCT user_idx, song_idx FROM (SELECT user_idx, song_idx FROM {positives} UNION ALL {known})
  WHERE user_idx IN (SELECT user_idx FROM sampled)),
walk AS (
  SELECT user_idx, step, CAST(({hash60("'42start'", "user_idx")} % prime
    + step * ({hash60("'42step'", "user_idx")} % greatest(prime - 1, 1) + 1)) % prime AS INTEGER) AS song_idx
  FROM sampled, size, LATERAL (SELECT unnest(range(0, prime)) AS step)),
unheard AS (
  SELECT user_idx, song_idx FROM walk ANTI JOIN heard USING (user_idx, song_idx)
  WHERE song_idx < (SELECT n FROM size)
  QUALIFY row_number() OVER (PARTITION BY user_idx ORDER BY step) <= 99),
candidates AS (
  SELECT user_idx, song_idx, 1 AS is_positive FROM chosen UNION ALL SELECT user_idx, song_idx, 0 FROM unheard)
"""


def text_time(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S')"


LATENESS = "INTERVAL 10 MINUTE"
# Windows that end at or before the newest time minus the lateness are closed.
CLOSED = f"(SELECT max(event_time) - {LATENESS} FROM silver)"


def with_events(*parts: str, body: str) -> str:
    return f"WITH {','.join([EVENTS, *parts])} {body}"


def with_orders(*parts: str, body: str) -> str:
    return f"WITH {','.join([ORDER_PLAYS, *parts])} {body}"


def closed_windows(seconds: int, columns: str, keys: str, where: str = "TRUE") -> str:
    start = f"time_bucket(INTERVAL {seconds} SECOND, event_time)"
    return with_events(
        body=f"""SELECT {text_time(start)} AS bucket, {keys} {columns} FROM silver WHERE {where}
        GROUP BY ALL HAVING max({start}) + INTERVAL {seconds} SECOND <= {CLOSED}"""
    )


SCORED = """
rated AS (SELECT "userId", "sessionId", abs(session_length - (SELECT avg(session_length) FROM sequences)) AS e FROM sequences),
limits AS (SELECT quantile_cont(e, 0.95) AS t FROM rated)"""

STORED_PART = """part AS (
  SELECT "itemInSession" AS item, ts FROM raw WHERE ts <= (SELECT middle FROM mid) AND "itemInSession" % 7 <> 0)"""


def factors(plays: str, size: int = 16) -> str:
    """Vectors of users and songs as one column per group of songs, and the score of a pair."""
    own = ", ".join(f"CAST(sum(CASE WHEN song_idx % {size} = {i} THEN play_count ELSE 0 END) AS DOUBLE) AS u{i}" for i in range(size))
    shared = ", ".join(f"sum(play_count * u{i}) AS s{i}" for i in range(size))
    return f"""
user_factors AS (SELECT user_idx, {own} FROM {plays} GROUP BY 1),
song_factors AS (SELECT song_idx, {shared} FROM {plays} JOIN user_factors USING (user_idx) GROUP BY 1)"""


DOT = " + ".join(f"u{i} * s{i}" for i in range(16))


def statements() -> dict[str, str]:
    """Query name to SQL."""
    dense_events = (EVENT_PLAYS, MATRIX, ENCODED)
    train_parts = f"""
marked AS (SELECT *, {split_case(uniform("'42'", "user_idx", "song_idx"), HOLDOUT)} AS split FROM encoded),
train AS (SELECT * FROM marked WHERE split = 'train'), test AS (SELECT * FROM marked WHERE split = 'test')"""
    hit_rate = (
        train_parts,
        candidates("test", "SELECT user_idx, song_idx FROM train"),
        """popularity AS (SELECT song_idx, CAST(sum(play_count) AS DOUBLE) AS score FROM train GROUP BY 1),
        ranked AS (SELECT user_idx, is_positive,
          row_number() OVER (PARTITION BY user_idx ORDER BY coalesce(score, 0.0) DESC, song_idx) AS rank
          FROM candidates LEFT JOIN popularity USING (song_idx))""",
    )
    hit_rate_body = """SELECT count(*) AS users, count(*) FILTER (rank <= 10) AS hits,
        avg(CASE WHEN rank <= 10 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS hit_rate FROM ranked WHERE is_positive = 1"""
    own_top = """best AS (SELECT "userId", user_idx, song, play_count,
        row_number() OVER (PARTITION BY user_idx ORDER BY play_count DESC, song_idx) AS rank FROM encoded
        QUALIFY rank <= 10)"""
    by_factors = f"""best AS (SELECT user_idx, song_idx, {DOT} AS score,
        row_number() OVER (PARTITION BY user_idx ORDER BY {DOT} DESC, song_idx) AS rank
        FROM user_factors, song_factors QUALIFY rank <= 10)"""
    scored_body = """SELECT "userId", "sessionId", CAST(e > t AS INTEGER) AS is_anomaly, round(e, 9) AS recon_error,
        round(least(greatest(CASE WHEN t > 0 THEN e / t WHEN e > 0 THEN 5.0::DOUBLE ELSE 0.0::DOUBLE END, 0), 5), 9) AS anomaly_score
        FROM rated, limits"""
    agents = "count(*) AS events FROM silver GROUP BY ALL"
    return {
        "parse_events": with_events(
            body='SELECT ts, "userId", "sessionId", page, level, location, gender, artist, song, duration FROM raw'
        ),
        "clean_events": with_events(
            body=f"""SELECT ts, "userId", "sessionId", page, city, state, browser, os,
            {text_time("registration_time")} AS registered FROM silver
            QUALIFY row_number() OVER (PARTITION BY "userId", ts, "sessionId" ORDER BY "itemInSession", page, song) = 1"""
        ),
        "dedupe_events": with_events(
            body="""SELECT "userId", ts, "sessionId", "itemInSession", page, song FROM (
            SELECT * FROM raw UNION ALL SELECT * REPLACE ("itemInSession" + 1 AS "itemInSession", 'Home' AS page) FROM raw)
            QUALIFY row_number() OVER (PARTITION BY "userId", ts, "sessionId" ORDER BY "itemInSession", page, song) = 1"""
        ),
        "split_location": with_events(body=f"SELECT location, city, state, {agents}"),
        "parse_user_agent": with_events(body=f'SELECT "userAgent", browser, os, {agents}'),
        "parse_user_agent_blank": with_events(
            body=f"""SELECT "userAgent", CASE WHEN "userAgent" IS NOT NULL AND browser = 'Unknown' THEN '' ELSE browser END AS browser,
            CASE WHEN "userAgent" IS NOT NULL AND os = 'Unknown' THEN '' ELSE os END AS os, {agents}"""
        ),
        "incremental_filter": with_events(
            STORED_PART,
            body="""SELECT "userId", ts, "sessionId", page FROM raw WHERE "itemInSession" NOT IN (SELECT item FROM part)""",
        ),
        "incremental_filter_indexed": with_events(
            STORED_PART,
            body="""SELECT "userId", ts, "sessionId", page FROM raw WHERE "itemInSession" NOT IN (SELECT item FROM part)""",
        ),
        "incremental_filter_late": with_events(
            STORED_PART,
            body=f"""SELECT "userId", ts, "sessionId", page FROM raw WHERE "itemInSession" NOT IN (SELECT item FROM part)
            AND ts > (SELECT max(ts) FROM part) - {3 * DAY_MS}""",
        ),
        "increment_report": with_events(
            STORED_PART,
            f"""fresh AS (SELECT ts > (SELECT max(ts) FROM part) - {3 * DAY_MS} AS recent FROM raw
              WHERE "itemInSession" NOT IN (SELECT item FROM part))""",
            body="""SELECT (SELECT count(*) FROM raw) AS total, count(*) FILTER (recent) AS taken,
            count(*) FILTER (NOT recent) AS too_late, (SELECT count(*) FROM raw) - count(*) AS known FROM fresh""",
        ),
        "parse_damaged_events": with_events(
            body="""SELECT ts, "userId", "sessionId", page, "itemInSession" FROM raw
            WHERE "itemInSession" % 10 <> 0 AND "itemInSession" % 11 <> 0"""
        ),
        "rejected_events": with_events(
            body="""SELECT "itemInSession" FROM raw WHERE "itemInSession" % 10 = 0 OR "itemInSession" % 11 = 0"""
        ),
        "require_fields": with_events(
            body="""SELECT ts, "userId", "itemInSession" FROM raw
            WHERE "itemInSession" % 9 <> 0 AND "itemInSession" % 10 <> 0 AND "itemInSession" % 13 <> 0"""
        ),
        "require_fields_blank": with_events(
            body="""SELECT ts, CASE WHEN "itemInSession" % 10 = 0 THEN '' ELSE "userId" END AS "userId", "itemInSession"
            FROM raw WHERE "itemInSession" % 9 <> 0 AND "itemInSession" % 13 <> 0"""
        ),
        "null_profile": with_events(
            body="""SELECT "column", nulls, total FROM (
            SELECT count(*) AS total, """
            + ", ".join(
                f'count(*) - count("{c}") AS "{c}"'
                for c in (
                    "ts", "userId", "sessionId", "page", "level", "itemInSession", "location", "userAgent",
                    "registration", "gender", "artist", "song", "duration",
                )
            )
            + """ FROM raw) UNPIVOT (nulls FOR "column" IN (ts, "userId", "sessionId", page, level, "itemInSession",
            location, "userAgent", registration, gender, artist, song, duration))"""
        ),
        "layer_counts": with_events(
            body='SELECT count(*) AS events, count(DISTINCT "userId") AS users, count(DISTINCT "sessionId") AS sessions FROM raw'
        ),
        "song_rankings": with_events(
            body="""SELECT artist, song, count(*) AS play_count FROM silver
            WHERE song IS NOT NULL AND artist IS NOT NULL GROUP BY ALL ORDER BY play_count DESC, artist, song"""
        ),
        "play_counts": with_events(
            body='SELECT "userId", song, count(*) AS play_count FROM silver WHERE song IS NOT NULL GROUP BY ALL'
        ),
        "listening_kpis": with_events(
            body="""SELECT count(*) AS streams, count(DISTINCT "userId") AS users,
            count(*) FILTER (level = 'paid') * 100::DOUBLE / count(*) AS paid_pct, count(DISTINCT song) AS songs
            FROM silver WHERE page = 'NextSong'"""
        ),
        "value_counts_gender": with_events(body='SELECT gender, count(*) AS "count" FROM silver GROUP BY 1'),
        "value_counts_level": with_events(body='SELECT level, count(*) AS "count" FROM silver GROUP BY 1'),
        "trending": with_events(
            body="""SELECT song, artist, count(*) AS plays FROM silver WHERE song IS NOT NULL GROUP BY ALL
            ORDER BY plays DESC, song, artist LIMIT 10"""
        ),
        "velocity": with_events(
            body=f"""SELECT {text_time("b")} AS bucket, events FROM (
            SELECT time_bucket(INTERVAL 10 SECOND, event_time) AS b, count(*) AS events FROM silver GROUP BY 1
            ORDER BY b DESC LIMIT 30) ORDER BY 1"""
        ),
        "top_artists": with_events(
            body="""SELECT artist, count(*) AS play_count FROM silver WHERE song IS NOT NULL AND artist IS NOT NULL
            GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""
        ),
        "top_artists_orders": with_orders(
            body="SELECT artist, count(*) AS play_count FROM plays GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"
        ),
        "top_songs_per_hour": with_events(
            body=f"""SELECT {text_time("b")} AS bucket, song, artist, plays FROM (
            SELECT time_bucket(INTERVAL 1 HOUR, event_time) AS b, song, artist, count(*) AS plays FROM silver
            WHERE song IS NOT NULL AND artist IS NOT NULL GROUP BY ALL)
            QUALIFY row_number() OVER (PARTITION BY b ORDER BY plays DESC, song, artist) <= 10"""
        ),
        "stream_top_songs": with_events(
            body=f"""SELECT {text_time("b")} AS bucket, song, artist, plays FROM (
            SELECT time_bucket(INTERVAL 1 HOUR, event_time) AS b, song, artist, count(*) AS plays FROM silver
            WHERE song IS NOT NULL AND artist IS NOT NULL GROUP BY ALL)
            WHERE b + INTERVAL 1 HOUR <= {CLOSED}
            QUALIFY row_number() OVER (PARTITION BY b ORDER BY plays DESC, song, artist) <= 10"""
        ),
        "stream_kpis": closed_windows(
            3600,
            "count(*) AS streams, round(count(*) FILTER (level = 'paid') * 100.0::DOUBLE / count(*), 9) AS paid_pct",
            "",
        ),
        "top_songs_orders": with_orders(
            body="""SELECT artist, song, count(*) AS play_count FROM plays GROUP BY ALL
            ORDER BY play_count DESC, artist, song LIMIT 100"""
        ),
        "latest_events": with_events(
            body="""SELECT ts, "userId", "sessionId", page, "itemInSession" FROM silver
            ORDER BY event_time DESC, "itemInSession" DESC, "userId", page LIMIT 50"""
        ),
        "user_features_v1": with_events(V1, body="SELECT * FROM v1"),
        "user_features_v2": with_events(V2, body="SELECT * FROM v2"),
        "user_features_monitor": with_events(monitor("cur", "silver"), body="SELECT * FROM cur"),
        "latest_per_key": with_events(
            body="""SELECT "userId", level AS current_level, gender FROM silver
            QUALIFY row_number() OVER (PARTITION BY "userId" ORDER BY event_time DESC, "itemInSession" DESC) = 1"""
        ),
        "churn_label_v1": with_events(
            SHARES, body='SELECT "userId", level, downgrade_count, cancel_count, churn FROM scored'
        ),
        "churn_label_v3": with_events(
            V2, body='SELECT "userId", current_level, churn_new, churn_old FROM labelled'
        ),
        "label_comparison": with_events(
            V2,
            body="""SELECT count(*) AS users, CAST(sum(churn_old) AS BIGINT) AS churn_old,
            CAST(sum(churn_new) AS BIGINT) AS churn_new, sum(churn_old) * 100::DOUBLE / count(*) AS churn_old_pct,
            sum(churn_new) * 100::DOUBLE / count(*) AS churn_new_pct,
            CAST(sum(churn_old) - sum(churn_new) AS BIGINT) AS difference FROM labelled""",
        ),
        "label_distribution": with_events(
            V2, body='SELECT churn_new, current_level, count(*) AS "count" FROM labelled GROUP BY ALL'
        ),
        "label_disagreements": with_events(
            V2,
            body="""SELECT "userId", current_level, downgrade_count, cancel_count, upgrade_count, churn_old, churn_new,
            CASE WHEN churn_old = 1 AND churn_new = 0 THEN 'label_changed' ELSE 'returned' END AS reason FROM labelled
            WHERE (churn_old = 1 AND churn_new = 0) OR (downgrade_count > 0 AND current_level = 'paid')""",
        ),
        "interaction_matrix": with_events(EVENT_PLAYS, MATRIX, body="SELECT * FROM matrix"),
        "interaction_matrix_orders": with_orders(MATRIX, body="SELECT * FROM matrix"),
        "interaction_matrix_active": with_orders(MATRIX.replace(">= 2", ">= 30"), body="SELECT * FROM matrix"),
        "matrix_stats": with_orders(
            MATRIX,
            body="""SELECT count(DISTINCT "userId") AS users, count(DISTINCT song) AS songs, count(*) AS interactions,
            1 - count(*) / (count(DISTINCT "userId")::DOUBLE * count(DISTINCT song)) AS sparsity FROM matrix""",
        ),
        "dense_ids": with_events(
            body="""SELECT "userId", CAST(row_number() OVER (ORDER BY "userId") - 1 AS INTEGER) AS user_idx
            FROM (SELECT DISTINCT "userId" FROM raw)"""
        ),
        "dense_ids_orders": with_orders(
            body="""SELECT song, CAST(row_number() OVER (ORDER BY song) - 1 AS INTEGER) AS song_idx
            FROM (SELECT DISTINCT song FROM plays)"""
        ),
        "id_mapping": "SELECT c_nationkey AS idx, min(c_name) AS c_name FROM customer GROUP BY 1",
        "encode_interactions": with_events(*dense_events, body="SELECT * FROM encoded"),
        "negative_samples": with_events(*dense_events, NEGATIVES, body="SELECT * FROM negatives"),
        "negative_samples_dense": with_orders(
            MATRIX.replace("FROM plays", "FROM (SELECT * REPLACE (artist AS song) FROM plays)"),
            ENCODED,
            NEGATIVES,
            body="""SELECT user_idx, count(*) AS rows, CAST(sum(song_idx) AS BIGINT) AS song_idx_sum
            FROM negatives GROUP BY 1""",
        ),
        "training_set": with_events(*dense_events, NEGATIVES, body="SELECT * FROM training"),
        "training_set_orders": with_orders(
            MATRIX,
            ENCODED,
            NEGATIVES,
            body="""SELECT label, CAST(user_idx // 100 AS BIGINT) AS bucket, count(*) AS rows,
            CAST(sum(song_idx) AS BIGINT) AS song_idx_sum FROM training GROUP BY ALL""",
        ),
        "hash_split": with_events(
            body=f"""SELECT *, {split_case(uniform("'42'", '"userId"', "song"), HOLDOUT)} AS split FROM (
            SELECT "userId", song, count(*) AS play_count FROM silver WHERE song IS NOT NULL GROUP BY ALL)"""
        ),
        "stratified_split": with_events(
            *dense_events, NEGATIVES, body=f"SELECT *, {split_case(uniform(*_key), PARTS)} AS split FROM training"
        ),
        "stratified_split_exact": with_events(*dense_events, NEGATIVES, SPLIT_EXACT, body="SELECT * FROM exact"),
        "class_balance": with_events(
            *dense_events, NEGATIVES, SPLIT_EXACT, body="SELECT split, label, count(*) AS rows FROM exact GROUP BY ALL"
        ),
        "ranking_candidates": with_events(
            *dense_events,
            candidates("encoded", "SELECT user_idx, song_idx FROM encoded"),
            body="SELECT * FROM candidates",
        ),
        "ranking_candidates_orders": with_orders(
            MATRIX,
            ENCODED,
            candidates("encoded", "SELECT user_idx, song_idx FROM encoded"),
            body="SELECT * FROM candidates",
        ),
        "hit_rate_at_k": with_events(*dense_events, *hit_rate, body=hit_rate_body),
        "hit_rate_orders": with_orders(MATRIX, ENCODED, *hit_rate, body=hit_rate_body),
        "own_plays_top_k": with_events(
            *dense_events,
            body="""SELECT "userId", CAST(rank AS INTEGER) AS rank, song, score FROM (
            SELECT "userId", song, play_count AS score,
              row_number() OVER (PARTITION BY user_idx ORDER BY play_count DESC, song_idx) AS rank FROM encoded)
            WHERE rank <= 10""",
        ),
        "decode_ids": """SELECT l_partkey + l_suppkey AS song_idx, l_orderkey, l_linenumber,
            coalesce(p_name, 'song_' || (l_partkey + l_suppkey)) AS song
            FROM lineitem LEFT JOIN part ON l_partkey + l_suppkey = p_partkey""",
        "recommendation_text": with_events(
            *dense_events,
            own_top,
            body="""SELECT "userId", string_agg(printf('%d. %s (%.2f)', rank, song, play_count::DOUBLE), chr(10) ORDER BY rank) AS recommended
            FROM best WHERE user_idx < 20 GROUP BY "userId" """,
        ),
        "lookup_recommendations": with_events(
            *dense_events,
            own_top,
            body="""SELECT "userId", CAST(rank AS INTEGER) AS rank, song, CAST(play_count AS FLOAT) AS score FROM best WHERE "userId" =
            (SELECT "userId" FROM encoded GROUP BY 1 ORDER BY sum(play_count) DESC, 1 LIMIT 1)""",
        ),
        "factor_recommendations": with_orders(
            MATRIX,
            ENCODED,
            factors("encoded"),
            by_factors,
            body="SELECT user_idx, CAST(rank AS INTEGER) AS rank, song_idx, CAST(CAST(score AS FLOAT) AS DOUBLE) AS score FROM best",
        ),
        "factor_lookup": with_orders(
            MATRIX,
            ENCODED,
            factors("encoded"),
            """wanted AS (SELECT "userId", user_idx FROM encoded GROUP BY ALL ORDER BY sum(play_count) DESC, 1 LIMIT 1)""",
            by_factors.replace("user_factors,", "wanted JOIN user_factors USING (user_idx),"),
            body="""SELECT "userId", CAST(rank AS INTEGER) AS rank, song, score FROM best JOIN wanted USING (user_idx) JOIN songs USING (song_idx)""",
        ),
        "factor_rmse": with_orders(
            MATRIX,
            ENCODED,
            train_parts,
            factors("train"),
            body=f"""SELECT count(*) AS pairs, round(sqrt(avg(({DOT} - play_count) * ({DOT} - play_count))), 6) AS rmse
            FROM test JOIN user_factors USING (user_idx) JOIN song_factors USING (song_idx)""",
        ),
        "factor_hit_rate": with_events(
            *dense_events,
            *hit_rate[:2],
            factors("train"),
            f"""scored AS (SELECT user_idx, is_positive, row_number() OVER (PARTITION BY user_idx ORDER BY {DOT} DESC, song_idx) AS rank
            FROM candidates JOIN user_factors USING (user_idx) JOIN song_factors USING (song_idx)),
            ranked AS (SELECT user_idx, coalesce(max(CASE WHEN is_positive = 1 AND rank <= 10 THEN 1 END), 0) AS hit FROM scored GROUP BY 1)""",
            body="""SELECT count(*) AS users, CAST(sum(hit) AS BIGINT) AS hits, avg(CAST(hit AS DOUBLE)) AS hit_rate FROM ranked""",
        ),
        "evaluate_scores_lines": """WITH scored AS (
            SELECT l_returnflag = 'R' AS positive, CAST(l_extendedprice AS DOUBLE) AS score FROM lineitem),
            steps AS (SELECT score, count(*) FILTER (positive) AS pos, count(*) FILTER (NOT positive) AS neg FROM scored GROUP BY 1),
            below AS (SELECT *, sum(neg) OVER (ORDER BY score) - neg AS lower FROM steps)
            SELECT (SELECT round(avg(CAST((score >= 40000.0::DOUBLE) = positive AS DOUBLE)), 9) FROM scored) AS accuracy,
            round(sum(pos * (lower + neg / 2::DOUBLE)) / (sum(pos)::DOUBLE * sum(neg)), 9) AS auc FROM below""",
        "score_columns": with_events(sequences("silver"), SCORED, body=scored_body),
        "lookup_anomaly": with_events(
            sequences("silver"), SCORED, body=scored_body + ' WHERE "sessionId" = (SELECT max("sessionId") FROM silver)'
        ),
        "ks_drift_missing": with_events(
            DRIFT.replace("CAST(thumbs_up AS DOUBLE) AS value, 'cur'", "CAST(NULL AS DOUBLE) AS value, 'cur'").replace(
                "FROM long GROUP BY feature", "FROM long WHERE value IS NOT NULL GROUP BY feature"
            ),
            body="""SELECT feature, CASE WHEN n_cur > 0 THEN p_value < 0.05 END AS drift, n_ref, n_cur,
            CASE WHEN n_cur > 0 THEN round(ks_statistic, 9) END AS ks_statistic,
            CASE WHEN n_cur > 0 THEN round(p_value, 9) END AS p_value, round(cur_mean, 9) AS cur_mean FROM drift""",
        ),
        "stable_sample_customers": f"""SELECT c_custkey, c_name FROM customer
            ORDER BY {hash60("'42'", "c_custkey")}, c_custkey LIMIT 500""",
        "lookup_churn": with_events(
            SHARES,
            body=f"""SELECT "userId" || '/' || level AS "userId", churn_prob, churn_prob > 0.5::DOUBLE AS is_churn,
            {tier(False)} AS risk_level FROM scored ORDER BY 1 LIMIT 1""",
        ),
        "validation_verdict": """WITH runs AS (
            SELECT avg(CAST(o_totalprice > (SELECT avg(o_totalprice) FROM orders) AS DOUBLE)) AS auc FROM orders GROUP BY o_orderpriority),
            stats AS (SELECT avg(auc) AS m, stddev_samp(auc) AS s, min(auc) AS lo, max(auc) AS hi FROM runs)
            SELECT CASE WHEN s > 0.08 THEN 'reject: unstable' WHEN m < 0.55 THEN 'reject: no signal' ELSE 'accept' END AS verdict,
            round(m, 9) AS mean_auc, round(s, 9) AS std_auc, round(lo, 9) AS min_auc, round(hi, 9) AS max_auc FROM stats""",
        "layer_stats": with_events(
            """layers AS (SELECT 'all' AS layer, ts FROM raw UNION ALL
              SELECT 'half', ts FROM raw WHERE ts <= (SELECT middle FROM mid))""",
            body="""SELECT layer, count(*) AS rows, max(ts) AS newest_ms,
            round(count(*) / ((max(ts) - min(ts)) / 60000::DOUBLE), 6) AS events_per_minute,
            (SELECT max(ts) FROM raw) - max(ts) AS lag_ms FROM layers GROUP BY layer""",
        ),
        "layer_round_trip": with_events(
            body='SELECT page, count(*) AS events, CAST(sum("itemInSession") AS BIGINT) AS items FROM raw GROUP BY page'
        ),
        "encode_names": with_orders(
            body="""SELECT song, "userId", play_count, song_idx FROM
            (SELECT "userId", song, count(*) AS play_count FROM plays GROUP BY ALL) JOIN
            (SELECT song, CAST(row_number() OVER (ORDER BY song) - 1 AS INTEGER) AS song_idx
             FROM (SELECT DISTINCT song FROM plays)) USING (song)"""
        ),
        "session_sequences": with_events(
            sequences("silver"),
            body="""SELECT "userId", "sessionId", session_length, array_to_string(codes, ',') AS page_seq FROM sequences""",
        ),
        "session_sequences_users": with_events(
            'whole AS (SELECT * REPLACE (CAST(0 AS BIGINT) AS "sessionId") FROM silver)',
            sequences("whole"),
            body="""SELECT "userId", "sessionId", session_length, array_to_string(codes, ',') AS page_seq FROM sequences""",
        ),
        "session_vectors": with_events(
            sequences("silver"),
            body="""SELECT "userId", "sessionId", session_length, CAST(50 AS INTEGER) AS size,
            round(list_sum(codes) / 23::DOUBLE, 6) AS total, codes[1] / 23::DOUBLE AS first,
            coalesce(codes[50], 0) / 23::DOUBLE AS last FROM sequences""",
        ),
        "session_stats": with_events(
            sequences("silver"),
            body="""SELECT count(*) AS sessions, avg(session_length) AS mean_length, max(session_length) AS max_length
            FROM sequences""",
        ),
        "late_rows": with_events(
            """hours AS (SELECT hour, ntile(6) OVER (ORDER BY hour) AS part FROM (SELECT DISTINCT date_trunc('hour', event_time) AS hour FROM silver)),
            placed AS (SELECT least(6, part + CASE WHEN "itemInSession" % 20 = 0 THEN 2 ELSE 0 END) AS part, ts
              FROM silver JOIN hours ON date_trunc('hour', event_time) = hour),
            marks AS (SELECT part, max(max(ts)) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) - 600000 AS mark
              FROM placed GROUP BY part)""",
            body="""SELECT CAST(part - 1 AS INTEGER) AS batch, count(*) AS late FROM placed JOIN marks USING (part)
            WHERE ts <= mark GROUP BY 1""",
        ),
        "stream_kpi_sketches": with_events(
            body=f"""SELECT CAST(CAST(event_time AS DATE) AS VARCHAR) AS day, count(*) AS streams,
            round(count(*) FILTER (level = 'paid') * 100.0::DOUBLE / count(*), 9) AS paid_pct, TRUE AS users_close, TRUE AS songs_close
            FROM silver WHERE date_trunc('hour', event_time) + INTERVAL 1 HOUR <= {CLOSED} GROUP BY 1"""
        ),
        "sketched_percentile": """SELECT strftime(ts, '%Y-%m') AS month, count(value) AS rows, TRUE AS "close" FROM events
            GROUP BY 1 HAVING count(value) > 0""",
        "published_layer": with_events(
            body="""SELECT 1 AS version, count(*) AS events, max(ts) AS newest_ms FROM raw WHERE ts <= (SELECT middle FROM mid)
            UNION ALL SELECT 2, count(*), max(ts) FROM raw"""
        ),
        "unreadable_files": "SELECT count(*) AS events, CAST(1 AS BIGINT) AS left_out FROM events",
        "exact_percentile": "SELECT count(*) AS rows, round(quantile_cont(value, 0.95), 6) AS p95 FROM events",
        "ks_drift": with_events(
            DRIFT,
            body="""SELECT feature, p_value < 0.05 AS drift, n_ref, n_cur, round(ks_statistic, 9) AS ks_statistic,
            round(p_value, 9) AS p_value, round(ref_mean, 9) AS ref_mean, round(cur_mean, 9) AS cur_mean,
            round(ref_std, 9) AS ref_std, round(cur_std, 9) AS cur_std FROM drift""",
        ),
        "drift_summary": with_events(
            DRIFT,
            body="""SELECT n_baseline_users, n_current_users, n_drifted_cols > n_total_cols // 3 AS dataset_drift,
            n_drifted_cols / n_total_cols::DOUBLE AS drift_score, n_drifted_cols, n_total_cols,
            array_to_string(names, ',') AS drifted_columns, n_drifted_cols / n_total_cols::DOUBLE > 0.3 AS alert FROM summary""",
        ),
        "alerts": with_events(
            DRIFT,
            body="""SELECT 'DATA_DRIFT' AS type, 'HIGH' AS severity,
            'Drift score=' || printf('%.2f', n_drifted_cols / n_total_cols::DOUBLE) || ' | Drifted: ['
              || array_to_string(list_transform(names, lambda n: '''' || n || ''''), ', ') || ']' AS message
            FROM summary WHERE n_drifted_cols / n_total_cols::DOUBLE > 0.3""",
        ),
        "risk_tiers": with_events(
            SHARES,
            body=f"""SELECT "userId", level, churn_prob, {tier(False)} AS risk_api, {tier(True)} AS risk_dashboard FROM scored""",
        ),
        "churn_kpis": with_events(
            SHARES,
            body=f"""SELECT count(*) AS users, count(*) FILTER ({tier(True)} = 'high') AS high_risk,
            count(*) FILTER ({tier(True)} = 'medium') AS medium_risk, round(avg(churn_prob), 9) AS avg_prob FROM scored""",
        ),
        "histogram": with_events(
            SHARES,
            body="""SELECT CAST(bin AS INTEGER) AS bin, round(bin * 0.05::DOUBLE, 6) AS bin_start,
            count(churn_prob) AS "count" FROM range(0, 20) AS t(bin)
            LEFT JOIN scored ON least(floor(churn_prob * 20), 19) = bin GROUP BY bin""",
        ),
        "confusion_matrix": with_events(
            SHARES, body='SELECT churn, prediction, count(*) AS "count" FROM scored GROUP BY ALL'
        ),
        "top_at_risk": with_events(
            SHARES,
            body="""SELECT "userId" || '/' || level AS "userId", churn_prob, printf('%.1f%%', churn_prob * 100) AS risk,
            total_songs, cancel_count FROM scored ORDER BY churn_prob DESC, "userId" || '/' || level LIMIT 10""",
        ),
        "stable_sample": with_events(
            SHARES,
            body=f"""SELECT "userId", level, total_songs, churn_prob FROM scored
            ORDER BY {hash60("'42'", '"userId"', "level")}, "userId", level LIMIT 500""",
        ),
        "latest_metrics": """SELECT o_orderpriority AS experiment, 'orders' AS metric, CAST(count(*) AS DOUBLE) AS value,
            strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d %H:%M:%S') AS run_ts FROM orders o
            WHERE CAST(o_orderdate AS DATE) = (SELECT max(CAST(o_orderdate AS DATE)) FROM orders i
              WHERE i.o_orderpriority = o.o_orderpriority)
            GROUP BY o_orderpriority, CAST(o_orderdate AS DATE)""",
        "stream_ingest": with_events(body='SELECT ts, "userId", "sessionId", page, song FROM raw'),
        "stream_silver": with_events(body='SELECT ts, "userId", "sessionId", page, city, browser FROM silver'),
        "stream_velocity": closed_windows(10, "count(*) AS events", ""),
        "evaluate_scores": with_events(
            *dense_events,
            NEGATIVES,
            f"""marked AS (SELECT *, {split_case(uniform(*_key), PARTS)} AS split FROM training),
            popularity AS (SELECT song_idx, sum(play_count) AS plays FROM marked
              WHERE split = 'train' AND label = 1 GROUP BY 1),
            scored AS (SELECT label, coalesce(plays / (SELECT max(plays) FROM popularity)::DOUBLE, 0.0::DOUBLE) AS score
              FROM marked LEFT JOIN popularity USING (song_idx) WHERE split = 'test'),
            steps AS (SELECT score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg
              FROM scored GROUP BY 1),
            below AS (SELECT *, sum(neg) OVER (ORDER BY score) - neg AS lower FROM steps)""",
            body="""SELECT (SELECT round(avg(CAST((score >= 0.5::DOUBLE) = (label = 1) AS DOUBLE)), 9) FROM scored) AS accuracy,
            round(sum(pos * (lower + neg / 2::DOUBLE)) / (sum(pos) * sum(neg))::DOUBLE, 9) AS auc FROM below""",
        ),
        "ks_drift_days": with_events(
            DAYS_DRIFT,
            body="""SELECT feature, n_ref, n_cur, round(ks, 9) AS ks_statistic, round(1 - u[n_ref + 1], 9) AS p_value,
            1 - u[n_ref + 1] < 0.05 AS drift FROM paths WHERE s = n_ref + n_cur""",
        ).replace("WITH", "WITH RECURSIVE", 1),
        "gap_sessions": with_events(
            """marked AS (SELECT "userId", ts, coalesce(ts - lag(ts) OVER (PARTITION BY "userId" ORDER BY ts) > 1800000, TRUE) AS opens
                FROM silver WHERE "userId" IS NOT NULL AND ts IS NOT NULL),
            placed AS (SELECT *, max(CASE WHEN opens THEN ts END) OVER (PARTITION BY "userId" ORDER BY ts RANGE UNBOUNDED PRECEDING) AS started
                FROM marked)""",
            body="""SELECT "userId", started, max(ts) + 1800000 AS ended, count(*) AS session_length FROM placed GROUP BY "userId", started""",
        ),
        "stream_session_parts": with_events(
            f"""marked AS (SELECT *, coalesce(ts - lag(ts) OVER (PARTITION BY "userId", "sessionId" ORDER BY ts) > {PART_REST_MS}, TRUE) AS opens
                FROM silver WHERE page IS NOT NULL AND "sessionId" IS NOT NULL AND "userId" IS NOT NULL),
            placed AS (SELECT *, max(CASE WHEN opens THEN ts END)
                OVER (PARTITION BY "userId", "sessionId" ORDER BY ts RANGE UNBOUNDED PRECEDING) AS started FROM marked),
            numbered AS (SELECT "userId", "sessionId", started, CASE page {_codes} ELSE 0 END AS code,
                row_number() OVER (PARTITION BY "userId", "sessionId", started ORDER BY ts, "itemInSession", page) AS position FROM placed)""",
            body="""SELECT "userId", "sessionId", started, count(*) AS session_length,
            array_to_string(list(code ORDER BY position) FILTER (position <= 50), ',') AS page_seq
            FROM numbered GROUP BY "userId", "sessionId", started""",
        ),
        "stream_session_sequences": with_events(
            sequences("silver", 1),
            body="""SELECT "userId", "sessionId", session_length, array_to_string(codes, ',') AS page_seq FROM sequences""",
        ),
        "stream_closed_sessions": with_events(
            """marked AS (SELECT "userId", event_time, coalesce(event_time - lag(event_time)
                OVER (PARTITION BY "userId" ORDER BY event_time) > INTERVAL 30 MINUTE, TRUE) AS opens FROM silver),
            grouped AS (SELECT *, count(*) FILTER (opens)
                OVER (PARTITION BY "userId" ORDER BY event_time, opens DESC ROWS UNBOUNDED PRECEDING) AS nr FROM marked),
            gaps AS (SELECT "userId", min(event_time) AS started, max(event_time) + INTERVAL 30 MINUTE AS ended,
                count(*) AS session_length FROM grouped GROUP BY "userId", nr)""",
            body=f"""SELECT "userId", {text_time("started")} AS started, {text_time("ended")} AS ended, session_length
            FROM gaps WHERE ended <= {CLOSED}""",
        ),
        "stream_trending": closed_windows(3600, "count(*) AS plays", "song, artist,", "song IS NOT NULL"),
    }
