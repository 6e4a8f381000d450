"""The same results in DuckDB SQL over the given tables, one statement per registered query.

Statements are built from named steps; each query takes the steps it needs, dependencies first.
"""

from __future__ import annotations

from cadenza.functions.keys import NULL_MARKER
from cadenza.operators import declared
from cadenza.operators.marts import LOADER
from cadenza.plans.registered import (
    CUTOFF, END, GENDERS, NEXT_RUN_TS, RUN_TS, START, STATES,
)
from cadenza.schemas import EVENT_SCHEMAS, TOPICS


def _key(*columns: str) -> str:
    texts = (f"COALESCE(CAST({c} AS VARCHAR), '{NULL_MARKER}')" for c in columns)
    return "md5(" + " || '-' || ".join(texts) + ")"


def _ts(literal) -> str:
    return f"TIMESTAMP '{literal}'"


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


_SECONDS = "EPOCH({end} - {start})"
_AUDIT = "{ts} AS inserted_time, '{by}' AS inserted_by, {ts} AS updated_time, '{by}' AS updated_by"


def _audit(run_ts) -> str:
    return _AUDIT.format(ts=_ts(run_ts), by=LOADER)


# name: (steps it reads, SQL)
_STEPS: dict[str, tuple[list[str], str]] = {
    "described": ([], """
        SELECT e.event_id, e.event_type, e.user_id, e.event_type IN ('click', 'view', 'purchase') AS is_play,
            CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS k,
            epoch_us(e.ts) // 1000 AS ts,
            CAST((epoch_us(e.ts) // 1000 - 1704067200000) // 86400000 AS INTEGER) AS sessionId,
            CAST(e.event_id % 2147483647 AS INTEGER) AS itemInSession,
            p.p_name, p.p_brand, CAST(p.p_size * CAST(7.25 AS DOUBLE) AS FLOAT) AS length,
            r.r_name AS city, lpad(CAST(e.user_id % 25 AS VARCHAR), 5, '0') AS zip,
            CASE WHEN e.user_id % 25 <> 7 THEN n.n_name END AS state,
            CAST((e.user_id % 25) * CAST(1.5 AS DOUBLE) - 100 AS FLOAT) AS lon,
            CAST((e.user_id % 25) * CAST(0.75 AS DOUBLE) + 20 AS FLOAT) AS lat,
            CASE e.user_id % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'M' END AS gender
        FROM events e
        LEFT JOIN part p
            ON p.p_partkey = CAST(floor(e.value * 10) AS BIGINT) % (SELECT count(*) FROM part)
        LEFT JOIN nation n ON n.n_nationkey = e.user_id % 25
        LEFT JOIN region r ON r.r_regionkey = n.n_regionkey"""),
    "wire": (["described"], """
        SELECT d.event_id, d.event_type, d.is_play, d.k, d.ts, d.sessionId, d.itemInSession,
            CAST(CASE WHEN d.k <> 97 THEN d.user_id END AS INTEGER) AS userId,
            CASE WHEN d.is_play THEN 'NextSong' WHEN d.event_type = 'signup' THEN 'Home' ELSE 'Error' END AS page,
            CASE WHEN d.is_play THEN d.p_brand END AS artist,
            CASE WHEN d.is_play AND d.k <> 42 THEN d.p_name END AS song,
            CASE WHEN d.is_play THEN d.length END AS duration,
            d.city, d.zip, d.state, d.lon, d.lat, d.gender,
            CASE WHEN d.k < 50 THEN 'agent-a' ELSE 'agent-b' END AS userAgent,
            'First' || d.user_id AS firstName, 'Last' || d.user_id AS lastName,
            1704067200000 + d.user_id * 1000 AS registration,
            CASE WHEN d.event_type = 'purchase' THEN 'paid' ELSE 'free' END AS level,
            'Logged In' AS auth, 'PUT' AS method, 200 AS status, d.k >= 10 AS success,
            c.copy, CAST(d.event_id % 2 AS INTEGER) AS "partition", d.event_id * 2 + c.copy AS "offset"
        FROM described d JOIN (SELECT unnest([0, 1]) AS copy) c ON c.copy = 0 OR d.k < 2"""),
    "land_auth_events": (["wire"], "SELECT * FROM wire WHERE event_type = 'signup'"),
    "land_status_change_events": (["wire"], "SELECT * FROM wire WHERE event_type = 'error'"),
    "land_listen_events": (["wire"], """
        SELECT * REPLACE (CASE WHEN k = 59 THEN 'Elsewhere' ELSE city END AS city)
        FROM wire WHERE is_play"""),
    "land_page_view_events": (["wire"], """
        SELECT * REPLACE (CASE WHEN k <> 58 THEN artist END AS artist,
            CASE WHEN k <> 58 THEN song END AS song,
            CASE WHEN k <> 58 THEN duration END AS duration)
        FROM wire"""),
}

_CAST = {
    "ts": "make_timestamp_ms(ts) AS ts",
    "registration": "make_timestamp_ms(registration) AS registration",
    **{c: f"CAST({c} AS DECIMAL(18,3)) AS {c}" for c in ("lon", "lat", "duration")},
}

for _topic in TOPICS:
    _columns = ", ".join(_CAST.get(c, c) for c in EVENT_SCHEMAS[_topic].fieldNames())
    _STEPS[f"stg_{_topic}"] = (
        [f"land_{_topic}"], f"SELECT DISTINCT {_columns} FROM land_{_topic}"
    )

_OBSERVED = "ts, userId AS user_id, lastName AS user_last_name, firstName AS user_first_name, " \
    "gender AS user_gender, userAgent AS user_agent, registration AS registered_at"
_ATTRIBUTES = ["user_last_name", "user_first_name", "user_gender", "user_agent", "registered_at"]
_ATTR = ", ".join(_ATTRIBUTES)
_BY_TIME = "ORDER BY {t} NULLS LAST, " + ", ".join(f"{a} NULLS LAST" for a in _ATTRIBUTES)

_STEPS |= {
    "int_dim_date": (["stg_listen_events"], """
        SELECT d AS date_key, CAST(isodow(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name,
            CAST(day(d) AS INTEGER) AS day_of_month, CAST(dayofyear(d) AS INTEGER) AS day_of_year,
            CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(isoyear(d) AS INTEGER) AS iso_year_number,
            CAST(month(d) AS INTEGER) AS month_number, monthname(d) AS month_name,
            CAST(quarter(d) AS INTEGER) AS quarter_number, CAST(year(d) AS INTEGER) AS year_number,
            isodow(d) >= 6 AS is_weekend
        FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM stg_listen_events)"""),
    "int_dim_time": (["stg_listen_events"], """
        SELECT CAST(k AS INTEGER) AS time_key,
            strftime(TIMESTAMP '2000-01-01' + to_seconds(k), '%H:%M:%S') AS time_value,
            CAST(h AS INTEGER) AS hour_number, CAST(m AS INTEGER) AS minute_number,
            CAST(k % 60 AS INTEGER) AS second_number, CAST((h + 11) % 12 + 1 AS INTEGER) AS hour_12,
            CASE WHEN h >= 12 THEN 'PM' ELSE 'AM' END AS am_pm,
            CAST(h * 60 + m AS INTEGER) AS minute_of_day, CAST(k AS INTEGER) AS second_of_day,
            CASE WHEN h < 5 OR h > 20 THEN 'Night' WHEN h < 12 THEN 'Morning'
                WHEN h < 17 THEN 'Afternoon' ELSE 'Evening' END AS time_period
        FROM (SELECT k, k // 3600 AS h, k % 3600 // 60 AS m FROM (
            SELECT DISTINCT date_part('hour', ts) * 3600 + date_part('minute', ts) * 60
                + date_part('second', ts) AS k FROM stg_listen_events))"""),
    "int_dim_location": (["stg_page_view_events"], f"""
        SELECT {_key("city", "zip", "state", "lon", "lat")} AS location_key, city AS location_city,
            zip AS location_zip, state AS location_state, lon AS location_lon, lat AS location_lat
        FROM (SELECT DISTINCT city, zip, state, lon, lat FROM stg_page_view_events)"""),
    "int_dim_session": (["stg_page_view_events"], f"""
        SELECT {_key("userId", "sessionId", "ts")} AS session_key, sessionId AS session_id,
            userId AS user_id, ts AS session_started_time, itemInSession AS session_number
        FROM stg_page_view_events WHERE COALESCE(artist, song, CAST(duration AS VARCHAR)) IS NOT NULL"""),
    "int_dim_song": (["stg_listen_events"], f"""
        SELECT {_key("artist", "song", "duration")} AS song_key, song AS song_name,
            artist AS song_artist_name, duration AS song_duration_seconds
        FROM (SELECT DISTINCT artist, song, duration FROM stg_listen_events)"""),
    "observations": ([f"stg_{t}" for t in TOPICS], " UNION ".join(
        f"SELECT {_OBSERVED} FROM stg_{t} WHERE userId IS NOT NULL" for t in TOPICS)),
    "change_flags": (["observations"], f"""
        SELECT *, CASE WHEN observation_number = 1 OR {" OR ".join(
            f"{a} IS DISTINCT FROM previous_{a}" for a in _ATTRIBUTES)} THEN 1 ELSE 0 END AS is_new_version
        FROM (SELECT *, row_number() OVER w AS observation_number, {", ".join(
            f"lag({a}) OVER w AS previous_{a}" for a in _ATTRIBUTES)}
            FROM observations WINDOW w AS (PARTITION BY user_id {_BY_TIME.format(t="ts")}))"""),
    "version_numbers": (["change_flags"], f"""
        SELECT ts, user_id, {_ATTR}, is_new_version, CAST(sum(is_new_version) OVER (PARTITION BY user_id
            ORDER BY observation_number ROWS UNBOUNDED PRECEDING) AS BIGINT) AS version_number
        FROM change_flags"""),
    "version_starts": (["version_numbers"], f"""
        SELECT user_id, {_ATTR}, version_number, min(ts) AS start_time
        FROM version_numbers GROUP BY ALL"""),
    "int_dim_user": (["version_starts"], f"""
        SELECT {_key("user_id", "start_time")} AS user_key, user_id, {_ATTR}, start_time,
            COALESCE(following, TIMESTAMP '9999-12-01') AS end_time, following IS NULL AS is_active
        FROM (SELECT *, lead(start_time) OVER (PARTITION BY user_id ORDER BY version_number) AS following
            FROM version_starts)"""),
    "timeline": (["stg_listen_events", "stg_page_view_events"], """
        SELECT userId, sessionId, ts, itemInSession FROM stg_listen_events
        UNION SELECT userId, sessionId, ts, itemInSession FROM stg_page_view_events"""),
    "next_event": (["timeline"], """
        SELECT *, lead(ts) OVER (PARTITION BY userId, sessionId
            ORDER BY ts NULLS LAST, itemInSession NULLS LAST) AS play_ended_at FROM timeline"""),
    "ended": (["stg_listen_events", "next_event"], """
        SELECT l.*, e.play_ended_at FROM stg_listen_events l
        LEFT JOIN next_event e USING (userId, sessionId, ts, itemInSession)"""),
    "int_fact": (["ended", "int_dim_date", "int_dim_time", "int_dim_user", "int_dim_song",
                  "int_dim_location", "int_dim_session"], f"""
        SELECT {_key("p.userId", "p.sessionId", "p.itemInSession")} AS play_key, p.userId AS user_id,
            p.sessionId AS session_id, p.itemInSession AS item_in_session, u.user_key, s.song_key,
            e.session_key, l.location_key, d.date_key AS play_date_key, t.time_key AS play_time_key,
            p.ts AS play_started_at, p.play_ended_at,
            {_SECONDS.format(start="p.ts", end="p.play_ended_at")} AS listened_seconds
        FROM ended p
        LEFT JOIN int_dim_date d ON d.date_key = CAST(p.ts AS DATE)
        LEFT JOIN int_dim_time t ON t.time_key = CAST(floor(epoch(p.ts)) AS BIGINT) % 86400
        LEFT JOIN int_dim_user u ON u.user_id = p.userId AND p.ts >= u.start_time AND p.ts < u.end_time
        LEFT JOIN int_dim_song s ON s.song_artist_name IS NOT DISTINCT FROM p.artist
            AND s.song_name IS NOT DISTINCT FROM p.song
            AND s.song_duration_seconds IS NOT DISTINCT FROM p.duration
        LEFT JOIN int_dim_location l ON l.location_city IS NOT DISTINCT FROM p.city
            AND l.location_zip IS NOT DISTINCT FROM p.zip AND l.location_state IS NOT DISTINCT FROM p.state
            AND l.location_lon IS NOT DISTINCT FROM p.lon AND l.location_lat IS NOT DISTINCT FROM p.lat
        LEFT JOIN int_dim_session e ON e.user_id = p.userId AND e.session_id = p.sessionId
            AND e.session_started_time = p.ts AND e.session_number = p.itemInSession"""),
    "earlier_fact": (["int_fact"], f"""
        SELECT * REPLACE (
            CASE WHEN play_ended_at < {_ts(CUTOFF)} THEN play_ended_at END AS play_ended_at,
            CASE WHEN play_ended_at < {_ts(CUTOFF)} THEN listened_seconds END AS listened_seconds)
        FROM int_fact WHERE play_started_at < {_ts(CUTOFF)}"""),
}

_DEFAULTS = {
    "int_dim_user": ("user_key", "'-1'", {
        "user_id": "-1", "user_last_name": "'Unknown'", "user_first_name": "'Unknown'",
        "user_gender": "'Unknown'", "registered_at": _ts("1970-01-01"), "user_agent": "'Unknown'",
        "start_time": _ts("1970-01-01"), "end_time": _ts("1970-01-01"), "is_active": "FALSE"}),
    "int_dim_song": ("song_key", "'-1'", {
        "song_name": "'Unknown'", "song_artist_name": "'Unknown'",
        "song_duration_seconds": "CAST(-1 AS DECIMAL(18,3))"}),
    "int_dim_session": ("session_key", "'-1'", {
        "session_id": "-1", "user_id": "-1", "session_started_time": _ts("1970-01-01"),
        "session_number": "-1"}),
    "int_dim_location": ("location_key", "'-1'", {
        "location_city": "'Unknown'", "location_zip": "'Unknown'", "location_state": "'Unknown'",
        "location_lon": "CAST(-1 AS DECIMAL(18,3))", "location_lat": "CAST(-1 AS DECIMAL(18,3))"}),
    "int_dim_date": ("date_key", "DATE '1970-01-01'", {
        "day_of_week": "-1", "day_name": "'Unknown'", "day_of_month": "-1", "day_of_year": "-1",
        "week_of_year": "-1", "iso_year_number": "-1", "month_number": "-1",
        "month_name": "'Unknown'", "quarter_number": "-1", "year_number": "-1",
        "is_weekend": "FALSE"}),
    "int_dim_time": ("time_key", "-1", {
        "time_value": "'00:00:00'", "hour_number": "-1", "minute_number": "-1",
        "second_number": "-1", "hour_12": "-1", "am_pm": "'Unknown'", "minute_of_day": "-1",
        "second_of_day": "-1", "time_period": "'Unknown'"}),
}

for _name, (_k, _reserved, _values) in _DEFAULTS.items():
    _filled = ", ".join(f"COALESCE({c}, {v}) AS {c}" for c, v in _values.items())
    _unknown = ", ".join(f"{v} AS {c}" for c, v in _values.items())
    _STEPS[_name.removeprefix("int_") + "_unknown"] = ([_name], f"""
        SELECT {_k}, {_filled} FROM (SELECT DISTINCT * FROM {_name})
        UNION ALL SELECT {_reserved} AS {_k}, {_unknown}""")
    _STEPS[_name.removeprefix("int_")] = (
        [_name.removeprefix("int_") + "_unknown"],
        f"SELECT *, {_audit(RUN_TS)} FROM {_name.removeprefix('int_')}_unknown")

_FK = """* REPLACE (COALESCE(user_key, '-1') AS user_key, COALESCE(song_key, '-1') AS song_key,
    COALESCE(session_key, '-1') AS session_key, COALESCE(location_key, '-1') AS location_key,
    COALESCE(play_date_key, DATE '1970-01-01') AS play_date_key,
    COALESCE(play_time_key, -1) AS play_time_key)"""
_LABEL = "COALESCE(NULLIF(TRIM({}), ''), 'Unknown')"
_FACT = ["user_id", "session_id", "item_in_session", "user_key", "song_key", "session_key",
         "location_key", "play_date_key", "play_time_key", "play_started_at", "play_ended_at",
         "listened_seconds"]

_STEPS |= {
    "defaulted": (["int_fact"], f"SELECT {_FK} FROM int_fact"),
    "mart_fact": (["defaulted"], f"SELECT *, {_audit(RUN_TS)} FROM defaulted"),
    "earlier_mart": (["earlier_fact"], f"SELECT {_FK}, {_audit(RUN_TS)} FROM earlier_fact"),
    "changed": (["defaulted", "earlier_mart"], f"""
        SELECT n.* FROM defaulted n LEFT JOIN earlier_mart o ON o.play_key = n.play_key
        WHERE o.play_key IS NULL OR {" OR ".join(f"n.{c} IS DISTINCT FROM o.{c}" for c in _FACT)}"""),
    "upserted": (["changed", "earlier_mart"], f"""
        SELECT * FROM earlier_mart WHERE play_key NOT IN (SELECT play_key FROM changed)
        UNION ALL SELECT *, {_audit(NEXT_RUN_TS)} FROM changed"""),
    "song_plays": (["mart_fact", "dim_location", "dim_user", "dim_song"], f"""
        SELECT f.play_key, f.user_id, f.song_key, f.location_key, f.play_started_at, f.listened_seconds,
            {_LABEL.format("l.location_state")} AS state, {_LABEL.format("u.user_gender")} AS gender,
            {_LABEL.format("s.song_name")} AS song, {_LABEL.format("s.song_artist_name")} AS artist,
            CAST(f.play_started_at AS DATE) AS play_date,
            CAST(isodow(f.play_started_at) AS INTEGER) AS weekday,
            CAST(hour(f.play_started_at) AS INTEGER) AS hour, f.updated_time
        FROM mart_fact f LEFT JOIN dim_location l USING (location_key)
        LEFT JOIN dim_user u USING (user_key) LEFT JOIN dim_song s USING (song_key)"""),
    "filter_options": (["dim_location", "dim_user"], f"""
        SELECT DISTINCT 'states' AS filter_name, {_LABEL.format("location_state")} AS filter_value FROM dim_location
        UNION ALL SELECT DISTINCT 'genders', {_LABEL.format("user_gender")} FROM dim_user"""),
    "plays": (["song_plays"], f"""
        SELECT play_key, user_id, song_key, location_key, play_started_at, listened_seconds, state,
            gender, song, artist, weekday, hour
        FROM song_plays WHERE play_started_at >= {_ts(START)}
            AND play_started_at < {_ts(END)} + INTERVAL 1 DAY"""),
    "chosen": (["plays"], f"""
        SELECT * FROM plays WHERE state IN {_in(STATES)} AND gender IN {_in(GENDERS)}"""),
}

_KNOWN = "CAST(COALESCE(SUM(CAST(listened_seconds AS DECIMAL(18,6))), 0) AS DOUBLE)"


def _summary(source: str) -> str:
    return f"""SELECT count(*) AS plays,
        count(DISTINCT user_id) FILTER (WHERE user_id <> -1) AS listeners,
        count(DISTINCT song_key) FILTER (WHERE song_key <> '-1') AS songs,
        {_KNOWN} AS known_seconds, count(*) - count(listened_seconds) AS duration_missing,
        count(*) FILTER (WHERE state = 'Unknown') AS unknown_location,
        count(*) FILTER (WHERE song_key = '-1') AS unknown_song,
        count(*) FILTER (WHERE gender = 'Unknown') AS unknown_gender FROM {source}"""


def _top_states(source: str) -> str:
    return f"""SELECT state, count(*) AS plays FROM {source} WHERE state <> 'Unknown'
        GROUP BY state ORDER BY plays DESC, state LIMIT 5"""


def _top_songs(source: str) -> str:
    return f"""SELECT song_key, song, artist, count(*) AS plays FROM {source} WHERE song_key <> '-1'
        GROUP BY ALL ORDER BY plays DESC, song, artist, song_key LIMIT 5"""


def _gender_songs(source: str) -> str:
    return f"""SELECT gender, song_key, song, artist, plays FROM (
        SELECT gender, song_key, song, artist, count(*) AS plays FROM {source}
        WHERE song_key <> '-1' GROUP BY ALL)
        QUALIFY row_number() OVER (PARTITION BY gender ORDER BY plays DESC, song, artist, song_key) = 1"""


def _heatmap(source: str) -> str:
    return f"""SELECT CAST(w AS INTEGER) AS weekday, CAST(h AS INTEGER) AS hour,
        count(play_key) AS plays, {_KNOWN} AS known_seconds, count(listened_seconds) AS measured_plays
        FROM range(1, 8) a(w) CROSS JOIN range(0, 24) b(h)
        LEFT JOIN {source} p ON p.weekday = w AND p.hour = h GROUP BY w, h"""


def _daily(source: str) -> str:
    return f"""SELECT CAST(d AS DATE) AS date, count(play_key) AS plays, {_KNOWN} / 3600 AS hours
        FROM generate_series({_ts(START)}, {_ts(END)}, INTERVAL 1 DAY) g(d)
        LEFT JOIN {source} p ON CAST(p.play_started_at AS DATE) = CAST(d AS DATE) GROUP BY d"""


def _top_artists(source: str) -> str:
    return f"""SELECT artist, count(*) AS plays FROM {source}
        WHERE song_key <> '-1' AND artist <> 'Unknown'
        GROUP BY artist ORDER BY plays DESC, artist LIMIT 5"""


_PLAY = "userId, sessionId, itemInSession, ts"
_PAGE_FIELDS = EVENT_SCHEMAS["page_view_events"].fieldNames()


def _surplus(left: str, right: str, columns: str) -> str:
    """Copies more on the left (negative: on the right), per row."""
    return f"""SELECT {columns}, sum(n) AS surplus FROM (
        SELECT {columns}, count(*) AS n FROM (SELECT {columns} FROM {left}
            EXCEPT ALL SELECT {columns} FROM {right}) GROUP BY ALL
        UNION ALL SELECT {columns}, -count(*) FROM (SELECT {columns} FROM {right}
            EXCEPT ALL SELECT {columns} FROM {left}) GROUP BY ALL) GROUP BY {columns}"""


def _cast_bigint(sql: str, *columns: str) -> str:
    replaced = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in columns)
    return f"SELECT * REPLACE ({replaced}) FROM ({sql})"


def _reconcile(left: str, right: str, columns: str) -> str:
    return f"""SELECT source_rows, target_rows, missing_rows, extra_rows, '' AS schema_differences,
        source_rows = target_rows AND missing_rows = 0 AND extra_rows = 0 AS passed FROM (SELECT
        (SELECT count(*) FROM {left}) AS source_rows, (SELECT count(*) FROM {right}) AS target_rows,
        (SELECT count(*) FROM (SELECT {columns} FROM {left} EXCEPT ALL SELECT {columns} FROM {right})) AS missing_rows,
        (SELECT count(*) FROM (SELECT {columns} FROM {right} EXCEPT ALL SELECT {columns} FROM {left})) AS extra_rows)"""


def _decoded(topic: str) -> str:
    changed = {"ts": "make_timestamp_ms(ts) AS ts", "sessionId": "CAST(sessionId AS BIGINT) AS sessionId"}
    fields = ", ".join(changed.get(c, c) for c in EVENT_SCHEMAS[topic].fieldNames())
    parts = ", ".join(
        f"CAST({p}(make_timestamp_ms(ts)) AS INTEGER) AS {p}" for p in ("year", "month", "day", "hour")
    )
    return f"""SELECT '{topic}' AS topic, "partition", "offset", make_timestamp_ms(ts) AS kafka_timestamp,
        {fields}, {parts}, CAST(ts AS BIGINT) AS raw_ts, city AS raw_city FROM land_{topic}"""


def _bundle(source: str) -> str:
    figures = ["plays", "listeners", "songs", "known_seconds", "duration_missing", "unknown_location",
               "unknown_song", "unknown_gender"]
    names = ", ".join(f"'{f}'" for f in figures)
    values = ", ".join(f"CAST({f} AS DOUBLE)" for f in figures)
    return f"""
        SELECT 'summary' AS report, unnest([{names}]) AS figure, unnest([{values}]) AS value
            FROM ({_summary(source)})
        UNION ALL BY NAME SELECT 'states' AS report, state, plays FROM ({_top_states(source)})
        UNION ALL BY NAME SELECT 'songs' AS report, * FROM ({_top_songs(source)})
        UNION ALL BY NAME SELECT 'gender_songs' AS report, * FROM ({_gender_songs(source)})
        UNION ALL BY NAME SELECT 'hourly' AS report, * RENAME (known_seconds AS value) FROM ({_heatmap(source)})
        UNION ALL BY NAME SELECT 'daily' AS report, * RENAME (hours AS value) FROM ({_daily(source)})
        UNION ALL BY NAME SELECT 'artists' AS report, * FROM ({_top_artists(source)})"""


_STEP_FOR = {"int_fact_song_play": "int_fact", "fact_song_play": "mart_fact"}


def _sql_value(value) -> str:
    return f"'{value}'" if isinstance(value, str) else str(value).upper()


def _declared(checks) -> tuple[list[str], str]:
    """Each check as a count of its own, a table's checks of single rows side by side."""
    steps, parts, rows = [], [], {}
    for check in checks:
        step, column = _STEP_FOR.get(check.table, check.table), check.columns[0]
        steps.append(step)
        if check.kind == declared.UNIQUE:
            columns = ", ".join(check.columns)
            some = " OR ".join(f"{c} IS NOT NULL" for c in check.columns)
            parts.append(f"""SELECT '{check.name}' AS name, count(*) AS violations FROM (
                SELECT {columns} FROM {step} WHERE {some} GROUP BY ALL HAVING count(*) > 1)""")
        elif check.kind == declared.REFERENCE:
            parent, key = check.what
            parent = _STEP_FOR.get(parent, parent)
            steps.append(parent)
            parts.append(f"""SELECT '{check.name}' AS name, count(DISTINCT {column}) AS violations
                FROM {step} WHERE {column} NOT IN (SELECT {key} FROM {parent} WHERE {key} IS NOT NULL)""")
        else:
            wrong = {
                declared.NOT_NULL: f"{column} IS NULL",
                declared.ACCEPTED: f"{column} NOT IN ({', '.join(map(_sql_value, check.what))})",
                declared.EXPRESSION: f"NOT ({check.what and check.what[0]})",
            }[check.kind]
            rows.setdefault(step, []).append((check.name, wrong))
    for step, found in rows.items():
        names = ", ".join(f"'{name}'" for name, _ in found)
        counts = ", ".join(f"count(*) FILTER (WHERE {wrong})" for _, wrong in found)
        parts.append(f"SELECT unnest([{names}]) AS name, unnest([{counts}]) AS violations FROM {step}")
    return list(dict.fromkeys(steps)), " UNION ALL ".join(parts)


_LANDED = ", ".join(f'"{c}"' for c in ["partition", "offset", *_PAGE_FIELDS])
_DAY_COUNTS = " UNION ALL ".join(
    f"""SELECT '{t}' AS topic, CAST(year(heard) AS INTEGER) AS year, CAST(month(heard) AS INTEGER) AS month,
        CAST(day(heard) AS INTEGER) AS day, count(*) AS n, count(DISTINCT userId) AS users
        FROM (SELECT *, make_timestamp_ms(ts) AS heard FROM land_{t}) GROUP BY ALL"""
    for t in TOPICS
)
_LAND = [f"land_{t}" for t in TOPICS]
_FACT_KEPT = "play_key, user_id, session_id, item_in_session, play_started_at, play_ended_at, listened_seconds"
_BOARD_KEPT = "play_key, user_id, song_key, location_key, play_started_at, listened_seconds, updated_time"

# name: (steps it reads, final SELECT)
_FINAL: dict[str, tuple[list[str], str]] = {
    "s2_decode": (_LAND, " UNION ALL BY NAME ".join(_decoded(t) for t in TOPICS)),
    "s4_stream_sink": (_LAND, _DAY_COUNTS),
    "s5_topic_states": (_LAND, " UNION ALL ".join(
        f"SELECT '{t}' AS topic, 'ended' AS state, count(*) AS n FROM land_{t}" for t in TOPICS[:-1])
        + f" UNION ALL SELECT '{TOPICS[-1]}', 'failed', NULL"),
    "s6_committed_files": (_LAND, " UNION ALL ".join(
        f"SELECT '{t}' AS topic, count(*) AS n FROM land_{t}" for t in TOPICS)),
    "s7_ledger_new_files": (_LAND, " UNION ALL ".join(
        f"SELECT '{t}' AS topic, count(*) AS n, '{'loaded' if t in TOPICS[:2] else 'pending'}' AS state "
        f"FROM land_{t}" for t in TOPICS)),
    "s8_landing_rows": (_LAND, " UNION ALL ".join(
        f"""SELECT '{t}' AS topic, count(*) AS n, count(DISTINCT "offset") AS offsets FROM land_{t}"""
        for t in TOPICS)),
    "s9_ingestion": (_LAND, " UNION ALL ".join(
        f"""SELECT '{t}' AS topic, count(*) AS first_run, CAST(0 AS BIGINT) AS second_run,
            CAST(1 AS BIGINT) AS loads FROM land_{t}""" for t in TOPICS)),
    "s10_inventory": (_LAND, " UNION ALL ".join(
        f"""SELECT '{t}' AS topic, CAST(day(heard) AS INTEGER) AS day, count(*) AS n,
            bool_or(month(heard) = 1 AND day(heard) BETWEEN 1 AND 3) AS wrong
            FROM (SELECT make_timestamp_ms(ts) AS heard FROM land_{t}) GROUP BY ALL"""
        for t in TOPICS)),
    "s11_keyed_messages": (["described"], """
        SELECT CASE WHEN k <> 97 THEN CAST(user_id AS VARCHAR) ELSE '' END AS key, count(*) AS n,
            CAST(sum(ts) AS BIGINT) AS ts_sum
        FROM described WHERE event_type = 'signup' AND k NOT IN (3, 4) GROUP BY 1"""),
    "t5_epoch_ms": (["described"],
                    "SELECT event_id, ts, make_timestamp_ms(ts) AS happened_at FROM described"),
    "t6_exact_dedupe": (["land_page_view_events"], f"""
        SELECT page, count(*) AS delivered, (SELECT count(*) FROM (SELECT DISTINCT
            {", ".join(_PAGE_FIELDS)} FROM land_page_view_events) d WHERE d.page = l.page) AS kept
        FROM land_page_view_events l GROUP BY page"""),
    "t7_exact_decimal": ([], """
        SELECT event_id, CAST(CAST(value / 7 AS FLOAT) AS DECIMAL(18,3)) AS from_float FROM events"""),
    "t8_surrogate_key": (["stg_listen_events"], f"""
        SELECT userId, sessionId, ts, song, duration, state,
            {_key("userId", "sessionId", "ts", "song", "duration", "state")} AS hash_key
        FROM stg_listen_events"""),
    "d3_day_part": ([], """
        SELECT CAST(hour(ts) AS INTEGER) AS hour, CASE WHEN hour(ts) < 5 OR hour(ts) > 20 THEN 'Night'
            WHEN hour(ts) < 12 THEN 'Morning' WHEN hour(ts) < 17 THEN 'Afternoon' ELSE 'Evening' END AS part,
            count(*) AS n FROM events GROUP BY ALL"""),
    "d10_version_starts": (["version_starts"], "SELECT * EXCLUDE (version_number) FROM version_starts"),
    "f3_end_time": (["ended"], f"SELECT {_PLAY}, play_ended_at FROM ended"),
    "f4_date_lookup": (["stg_listen_events", "int_dim_date"], f"""
        SELECT {_PLAY}, date_key AS play_date_key FROM stg_listen_events
        LEFT JOIN int_dim_date ON date_key = CAST(ts AS DATE)"""),
    "f5_time_lookup": (["stg_listen_events", "int_dim_time"], f"""
        SELECT {_PLAY}, time_key AS play_time_key FROM stg_listen_events
        LEFT JOIN int_dim_time ON time_key = CAST(floor(epoch(ts)) AS BIGINT) % 86400"""),
    "f6_scd2_lookup": (["stg_listen_events", "int_dim_user"], f"""
        SELECT {_PLAY}, user_key FROM stg_listen_events
        LEFT JOIN int_dim_user ON user_id = userId AND ts >= start_time AND ts < end_time"""),
    "f7_song_lookup": (["stg_listen_events", "int_dim_song"], f"""
        SELECT {_PLAY}, artist, song, duration, song_key FROM stg_listen_events
        LEFT JOIN int_dim_song ON artist IS NOT DISTINCT FROM song_artist_name
            AND song IS NOT DISTINCT FROM song_name
            AND duration IS NOT DISTINCT FROM song_duration_seconds"""),
    "f8_location_lookup": (["stg_listen_events", "int_dim_location"], f"""
        SELECT {_PLAY}, city, zip, state, lon, lat, location_key FROM stg_listen_events
        LEFT JOIN int_dim_location ON city IS NOT DISTINCT FROM location_city
            AND zip IS NOT DISTINCT FROM location_zip AND state IS NOT DISTINCT FROM location_state
            AND lon IS NOT DISTINCT FROM location_lon AND lat IS NOT DISTINCT FROM location_lat"""),
    "f9_session_lookup": (["stg_listen_events", "int_dim_session"], f"""
        SELECT {_PLAY}, session_key FROM stg_listen_events LEFT JOIN int_dim_session
            ON user_id = userId AND session_id = sessionId AND session_started_time = ts
            AND session_number = itemInSession"""),
    "f10_pruned_lookup": (["int_dim_session"], "SELECT DISTINCT user_id, session_id FROM int_dim_session"),
    "f11_listened_seconds": (["ended"], f"""
        SELECT {_PLAY}, {_SECONDS.format(start="ts", end="play_ended_at")} AS listened_seconds FROM ended"""),
    "f13_timeline_conflicts": (["stg_listen_events", "stg_page_view_events"], """
        SELECT userId, sessionId, itemInSession, min(ts) AS first_ts, max(ts) AS last_ts FROM (
            SELECT userId, sessionId, itemInSession, ts FROM stg_listen_events UNION ALL
            SELECT userId, sessionId, itemInSession,
                CASE WHEN state = 'NATION_3' THEN ts + INTERVAL 1 SECOND ELSE ts END
            FROM stg_page_view_events)
        GROUP BY ALL HAVING count(DISTINCT ts) > 1"""),
    "m7_distinct_before_defaults": (["int_dim_song"], """
        SELECT * FROM int_dim_song
        UNION SELECT * REPLACE (COALESCE(song_name, 'Unknown') AS song_name) FROM int_dim_song"""),
    "m8_bad_keys": (["int_dim_location"], """
        SELECT * FROM (SELECT * REPLACE (CASE WHEN location_state IS NULL THEN '-1'
            WHEN location_city <> 'ASIA' THEN location_key END AS location_key) FROM int_dim_location)
        WHERE location_key IS NULL OR location_key = '-1'"""),
    "m9_with_unknown": (["dim_location_unknown"], "SELECT * FROM dim_location_unknown"),
    "m10_audit": (["int_dim_date"], f"SELECT date_key, {_audit(RUN_TS)} FROM int_dim_date"),
    "m11_source_identity": (["int_fact"], """
        SELECT count(*) AS row_count, count(DISTINCT play_key) AS key_count,
            count(*) = count(DISTINCT play_key) AS is_valid FROM int_fact"""),
    "m13_changed_rows": (["changed"], "SELECT * FROM changed"),
    "m14_upsert": (["upserted"], "SELECT * FROM upserted"),
    "m15_schema_guard": (["mart_fact"], """
        SELECT incoming, CASE WHEN column_name = '' THEN 'accepted'
            ELSE 'schema of the stored fact differs in: ' || column_name END AS verdict, plays
        FROM (SELECT count(*) AS plays FROM mart_fact), (VALUES ('as stored', ''),
            ('without a column', 'song_key'), ('of another type', 'user_id')) v(incoming, column_name)"""),
    "r0_reader_guard": (["song_plays"], """
        SELECT count(*) AS row_count, count(DISTINCT play_key) AS key_count,
            count(*) = count(DISTINCT play_key) AS is_valid FROM song_plays"""),
    "r1_metadata": (["song_plays"], """
        SELECT count(*) AS total_rows, count(*) - count(play_started_at) AS missing_timestamp,
            min(play_date) AS min_date, max(play_date) AS max_date, max(updated_time) AS updated_at,
            max(play_started_at) AS latest_event FROM song_plays"""),
    "r1_filter_values": (["filter_options"], """
        SELECT filter_value FROM filter_options WHERE filter_name = 'states' ORDER BY 1"""),
    "r2_select_plays": (["chosen"], "SELECT * FROM chosen"),
    "r3_summary": (["plays"], _summary("plays")),
    "r4_top_states": (["plays"], _top_states("plays")),
    "r5_top_songs": (["plays"], _top_songs("plays")),
    "r6_top_song_per_gender": (["plays"], _gender_songs("plays")),
    "r7_heatmap": (["plays"], _heatmap("plays")),
    "r8_daily_trend": (["plays"], _daily("plays")),
    "r9_top_artists": (["plays"], _top_artists("plays")),
    "r10_derived_figures": (["plays"], f"""
        SELECT plays, (plays - duration_missing) / plays * 100 AS coverage_percent,
            known_seconds / 3600 AS hours FROM ({_summary("plays")})"""),
    "r11_peak_hour": (["plays"], f"""
        SELECT weekday, hour, plays, plays / (SELECT count(*) FROM plays) AS share
        FROM ({_heatmap("plays")}) ORDER BY plays DESC, weekday, hour LIMIT 1"""),
    "r12_leading_songs": (["plays"], f"""
        SELECT CAST(place AS INTEGER) AS place, place || '. ' || song || ' — ' || artist AS label, plays,
            plays / (SELECT count(*) FROM plays) AS share
        FROM (SELECT *, row_number() OVER (ORDER BY plays DESC, song, artist, song_key) AS place
            FROM ({_top_songs("plays")}))"""),
    "r13_report_bundle": (["chosen"], _bundle("chosen")),
    "q1_not_null": (["int_fact"], "SELECT play_key, session_key FROM int_fact WHERE session_key IS NULL"),
    "q2_unique": (["int_fact"], """
        SELECT song_key, count(*) AS n FROM int_fact WHERE song_key IS NOT NULL
        GROUP BY song_key HAVING n > 1"""),
    "q3_accepted_values": (["stg_page_view_events"], """
        SELECT page, count(*) AS n FROM stg_page_view_events
        WHERE page NOT IN ('NextSong', 'Home') GROUP BY page"""),
    "q4_relationships": (["mart_fact", "int_dim_user"], f"""
        SELECT user_key, count(*) AS n FROM mart_fact f WHERE NOT EXISTS (SELECT 1 FROM int_dim_user u
            WHERE u.user_key = f.user_key AND u.start_time < {_ts(CUTOFF)}) GROUP BY user_key"""),
    "q5_unique_together": (["int_dim_session"], """
        SELECT user_id, session_id, count(*) AS n FROM int_dim_session
        WHERE user_id IS NOT NULL OR session_id IS NOT NULL GROUP BY ALL HAVING n > 1"""),
    "q6_expression_is_true": (["mart_fact"], """
        SELECT play_key, play_time_key FROM mart_fact
        WHERE NOT (play_time_key + 21600 = -1 OR play_time_key + 21600 BETWEEN 0 AND 86399)"""),
    "q7_bad_durations": (["int_fact"], f"""
        SELECT play_key FROM (SELECT * REPLACE (CASE WHEN session_key IS NULL THEN floor(listened_seconds)
            WHEN location_key IS NOT NULL THEN listened_seconds END AS listened_seconds) FROM int_fact)
        WHERE (play_ended_at IS NULL) <> (listened_seconds IS NULL) OR play_ended_at < play_started_at
            OR listened_seconds < 0 OR listened_seconds IS DISTINCT FROM
                {_SECONDS.format(start="play_started_at", end="play_ended_at")}"""),
    "q8_bad_audit": (["upserted"], f"""
        SELECT 'fact_by_hand' AS model_name, count(*) AS n FROM upserted
        WHERE play_started_at >= {_ts(CUTOFF)}"""),
    "q9_fact_not_preserved": (["int_fact", "earlier_mart"], _cast_bigint(
        _surplus("int_fact", "earlier_mart", _FACT_KEPT), "surplus")),
    "q10_bad_unknown_member": (["int_dim_location", "dim_session", "int_dim_user"], """
        SELECT problem, n FROM (
            SELECT 'dim_location: missing/duplicate Unknown' AS problem,
                CAST(count(*) FILTER (WHERE location_key = '-1') <> 1 AS BIGINT) AS n FROM int_dim_location
            UNION ALL SELECT 'dim_session: wrong defaults', count(*) FROM dim_session
                WHERE session_key = '-1' AND session_number <> 0
            UNION ALL SELECT 'dim_user: reserved source key', count(*) FROM int_dim_user
                WHERE user_id % 10 = 3) WHERE n > 0"""),
    "q11_dashboard_not_preserved": (["earlier_mart", "song_plays"], _cast_bigint(
        _surplus("earlier_mart", "song_plays", _BOARD_KEPT), "surplus")),
    "q12_reconcile_rows": (["land_page_view_events"], f"""
        SELECT *, 'landing' AS pair FROM ({_reconcile("land_page_view_events", "land_page_view_events", _LANDED)})
        UNION ALL SELECT *, 'deduped' AS pair FROM ({_reconcile(
            "(SELECT " + ", ".join(_PAGE_FIELDS) + " FROM land_page_view_events)",
            "(SELECT DISTINCT " + ", ".join(_PAGE_FIELDS) + " FROM land_page_view_events)",
            ", ".join(_PAGE_FIELDS))})"""),
    "q12_reconcile_lineitem": ([], _reconcile(
        "lineitem", """(SELECT * REPLACE (CASE WHEN l_returnflag = 'R' THEN 'X' ELSE l_linestatus END
            AS l_linestatus) FROM lineitem)""", "*")),
    "q13_reconcile_files": (_LAND, " UNION ALL ".join(
        f"""SELECT "case", '{t}' AS topic, ledger_lacks * early AS rows_not_in_ledger,
            lake_lacks * early AS rows_not_in_lake, (ledger_lacks + lake_lacks) * early = 0 AS passed
            FROM (SELECT count(*) FILTER (WHERE month(heard) = 1 AND day(heard) < 10) AS early
                FROM (SELECT make_timestamp_ms(ts) AS heard FROM land_{t})),
            (VALUES ('as loaded', 0, 0), ('ledger lacks days', 1, 0), ('lake lacks days', 0, 1))
                v("case", ledger_lacks, lake_lacks)"""
        for t in TOPICS)),
    "q13_audit_topics": (_LAND, " UNION ALL ".join(
        f"""SELECT '{warehouse}' AS warehouse, '{t}' AS topic, count(*) AS source_rows,
            count(*) * {there} AS target_rows, count(*) * {1 - there} AS missing_rows,
            CAST(0 AS BIGINT) AS extra_rows, '' AS schema_differences, {there} = 1 AS same_files,
            {there} = 1 AS passed FROM land_{t}"""
        for warehouse in ("whole", "half") for t in TOPICS
        for there in [int(warehouse == "whole" or t in TOPICS[:2])])),
    "q14_missing_dimensions": (["int_fact"], """
        SELECT count(*) AS play_count, count(*) - count(user_key) AS missing_user,
            count(*) - count(song_key) AS missing_song, count(*) - count(session_key) AS missing_session,
            count(*) - count(location_key) AS missing_location,
            count(*) - count(play_date_key) AS missing_date,
            count(*) - count(play_time_key) AS missing_time FROM int_fact"""),
}

# Queries that are one step as it stands.
_STEP_OF = {
    "t1_stg_auth_events": "stg_auth_events", "t2_stg_listen_events": "stg_listen_events",
    "t3_stg_page_view_events": "stg_page_view_events",
    "t4_stg_status_change_events": "stg_status_change_events",
    "d1_int_dim_date": "int_dim_date", "d2_int_dim_time": "int_dim_time",
    "d4_int_dim_location": "int_dim_location", "d5_int_dim_session": "int_dim_session",
    "d6_int_dim_song": "int_dim_song", "d7_user_observations": "observations",
    "d8_change_flags": "change_flags", "d9_version_numbers": "version_numbers",
    "d11_int_dim_user": "int_dim_user", "f1_timeline": "timeline", "f2_next_event": "next_event",
    "f12_int_fact_song_play": "int_fact", "m1_dim_user": "dim_user", "m2_dim_song": "dim_song",
    "m3_dim_session": "dim_session", "m4_dim_location": "dim_location", "m5_dim_date": "dim_date",
    "m6_dim_time": "dim_time", "m12_default_foreign_keys": "defaulted",
    "p1_song_plays": "song_plays", "p2_filter_options": "filter_options",
    "s14_stored_fact": "upserted", "t6_two_loads": "stg_page_view_events",
    "d11_extended_history": "int_dim_user",
}

_FINAL |= {
    "q1_declared_intermediate": _declared(declared.INTERMEDIATE),
    "q1_declared_marts": _declared(declared.MARTS),
    "q1_declared_dashboard": _declared(declared.DASHBOARD),
}


def _with(steps: list[str], final: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in _STEPS[name][0]:
            visit(needed)
        if name not in ordered:
            ordered.append(name)

    for step in steps:
        visit(step)
    if not ordered:
        return final
    parts = ",\n".join(f"{name} AS ({_STEPS[name][1]})" for name in ordered)
    return f"WITH {parts}\n{final}"


def oracle_sql() -> dict[str, str]:
    named = {q: ([step], f"SELECT * FROM {step}") for q, step in _STEP_OF.items()}
    return {name: _with(*spec) for name, spec in (named | _FINAL).items()}
