"""ANSI SQL that gives each query's rows, for DuckDB over the same tables.

Written on its own, from FIXTURES.md, and not from the Spark expressions.
"""

from __future__ import annotations

from ..sources.dims import BASELINES, DEFAULT_BASELINE, DEFAULT_PATH, PATHS, ROUTES, VEHICLES
from .batch import KEEP_AGE, KEEP_BYTES, ONE_ROUTE, TOPIC_PATTERN
from .streams import DELIVERIES, LAG, LATE, LATE_CUT, WRONG
from .views import AS_OF


def _values(rows) -> str:
    def cell(x):
        if isinstance(x, str):
            return "'" + x.replace("'", "''") + "'"
        if isinstance(x, float):
            return f"cast({x!r} AS DOUBLE)"
        if isinstance(x, list):
            return "[" + ", ".join(cell(y) for y in x) + "]"
        return str(x)

    return ", ".join("(" + ", ".join(cell(x) for x in row) + ")" for row in rows)


def _round2(x: str) -> str:
    """Half up on the shortest decimal text of a double."""
    return f"cast(round(cast(cast({x} AS VARCHAR) AS DECIMAL(38, 16)), 2) AS DOUBLE)"


CTE = {
    "t": """
        SELECT event_id, ts, event_type,
               concat('Route_',
                      CASE user_id % 7 WHEN 0 THEN 'G' WHEN 1 THEN 'X' ELSE '' END,
                      user_id % 40,
                      CASE WHEN user_id % 3 = 0 THEN 'A' ELSE '' END) AS route_id,
               cast(floor(value * 20) AS INTEGER) - 400 AS delay_seconds
        FROM events""",
    "c": r"""
        SELECT event_id, ts, regexp_extract(route_id, '(\d+[a-zA-Z]?)', 1) AS route_id, delay_seconds
        FROM t WHERE delay_seconds BETWEEN -300 AND 3600""",
    "slid": """
        SELECT route_id, delay_seconds, event_id,
               unnest(generate_series(date_trunc('minute', ts) - INTERVAL 4 MINUTE,
                                      date_trunc('minute', ts), INTERVAL 1 MINUTE)) AS window_start
        FROM c""",
    "w": """
        SELECT route_id, window_start, window_start + INTERVAL 5 MINUTE AS window_end,
               cast(sum(delay_seconds) AS DOUBLE) / count(delay_seconds) AS average_delay_seconds
        FROM slid GROUP BY route_id, window_start""",
    "cur": """
        SELECT route_id, window_start, window_end, average_delay_seconds FROM (
            SELECT *, row_number() OVER (PARTITION BY route_id ORDER BY window_end DESC) AS rn FROM w)
        WHERE rn = 1""",
    # Parsed payloads: the form of event i is i % 10.
    "p": """
        SELECT event_id, event_type, event_id % 10 AS form,
               CASE WHEN event_id % 10 IN (3, 5) THEN NULL
                    WHEN event_id % 10 = 4 THEN 'depot' ELSE route_id END AS route_id,
               CASE WHEN event_id % 10 IN (3, 5, 6) THEN NULL ELSE delay_seconds END AS delay_seconds,
               CASE WHEN event_id % 10 IN (3, 5) OR event_id % 100 IN (10, 20, 30) THEN NULL
                    WHEN event_id % 10 = 2 THEN date_trunc('second', ts) + INTERVAL 500 MILLISECOND
                    ELSE date_trunc('second', ts) END AS ts
        FROM t""",
    "text": """
        SELECT event_id, ts, CASE event_id % 10
            WHEN 1 THEN concat('{"route_id":"', route_id, '","timestamp":"',
                               strftime(ts, '%Y-%m-%d %H:%M:%S'), '","delay_seconds":', delay_seconds, '.0}')
            WHEN 2 THEN concat('{"timestamp":', cast(floor(epoch(ts)) AS BIGINT), '.5,"route_id":"',
                               route_id, '","delay_seconds":', delay_seconds, '}')
            WHEN 3 THEN 'not json'
            WHEN 4 THEN concat('{"timestamp":', cast(floor(epoch(ts)) AS BIGINT),
                               ',"route_id":"depot","delay_seconds":', delay_seconds, '}')
            WHEN 5 THEN '[1]'
            WHEN 6 THEN concat('{"timestamp":', cast(floor(epoch(ts)) AS BIGINT), ',"route_id":"', route_id, '"}')
            WHEN 7 THEN concat('{"timestamp":', cast(floor(epoch(ts)) AS BIGINT), ',"route_id":"', route_id,
                               '","delay_seconds":"', delay_seconds, '"}')
            ELSE concat('{"timestamp":', CASE event_id % 100 WHEN 10 THEN cast(floor(epoch(ts)) AS BIGINT) * 1000000
                            WHEN 20 THEN cast(floor(epoch(ts)) AS BIGINT) * 1000
                            WHEN 30 THEN -99999999999999 ELSE cast(floor(epoch(ts)) AS BIGINT) END,
                        ',"route_id":"', route_id, '","delay_seconds":', delay_seconds, '}') END AS payload
        FROM t""",
    "l0": """
        SELECT event_id, ts, delay_seconds, event_id % 4 AS kind,
               CASE event_id % 50 WHEN 1 THEN NULL WHEN 2 THEN '' ELSE route_id END AS route_id
        FROM t""",
    "lake": """
        SELECT event_id,
               CASE WHEN kind IN (1, 2) THEN replace(route_id, 'Route_', '') ELSE route_id END AS route_id,
               CASE WHEN kind = 0 THEN delay_seconds END AS delay_seconds,
               CASE WHEN kind = 0 THEN ts END AS ts,
               CASE WHEN kind <> 0 THEN date_trunc('minute', ts) END AS window_start,
               CASE WHEN kind <> 0 THEN date_trunc('minute', ts) + INTERVAL 5 MINUTE END AS window_end,
               CASE WHEN kind <> 0 THEN cast(delay_seconds AS DOUBLE) END AS average_delay_seconds
        FROM l0""",
    "mlake": r"""
        SELECT regexp_extract(route_id, '(\d+[a-zA-Z]?)', 1) AS route_id, average_delay_seconds FROM lake""",
    "routes": f"SELECT * FROM (VALUES {_values(enumerate(ROUTES, 1))}) AS v(pos, route)",
    "base": f"SELECT * FROM (VALUES {_values(BASELINES.items())}) AS v(route, baseline_minutes)",
    "store": """
        SELECT r.pos, r.route, r.pos % 8 AS form, cur.average_delay_seconds AS s
        FROM routes r LEFT JOIN cur ON cur.route_id = r.route""",
    "merged": f"""
        SELECT s.route, coalesce(b.baseline_minutes, {DEFAULT_BASELINE}) AS baseline_minutes,
               greatest(0.0, least(15.0, CASE
                   WHEN s.s IS NULL OR form IN (0, 5) THEN coalesce(b.baseline_minutes, {DEFAULT_BASELINE})
                   WHEN form = 1 THEN s.s / 60.0
                   WHEN form IN (2, 7) THEN CASE WHEN s.s > 30 THEN s.s / 60.0 ELSE s.s END
                   WHEN form = 3 THEN CASE WHEN s.s / 60 > 30 THEN s.s / 60 / 60.0 ELSE s.s / 60 END
                   WHEN form = 4 THEN 30.0
                   ELSE 0.0 END)) AS delay_minutes
        FROM store s LEFT JOIN base b ON b.route = s.route""",
}

# What each common table reads.
NEEDS = {
    "c": ["t"],
    "slid": ["c"],
    "w": ["slid"],
    "cur": ["w"],
    "p": ["t"],
    "text": ["t"],
    "l0": ["t"],
    "lake": ["l0"],
    "mlake": ["lake"],
    "store": ["routes", "cur"],
    "merged": ["store", "base"],
}


def _query(tables: str, body: str) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in order:
            order.append(name)

    for name in tables.split():
        add(name)
    return "WITH " + ", ".join(f"{n} AS ({CTE[n]})" for n in order) + body


_WINDOWED = "SELECT route_id, window_start, window_end, average_delay_seconds FROM w"
_CURRENT = "SELECT route_id, window_start, window_end, average_delay_seconds FROM cur"
_TOP = f"""
    SELECT route_id, {_round2("average_delay_seconds")} AS avg_delay_sec, window_start, window_end
    FROM w ORDER BY average_delay_seconds DESC NULLS LAST, route_id, window_start LIMIT 10"""
_PARSED = "SELECT event_id, route_id, delay_seconds, ts FROM p"


# The board of the routes and delays of ``merged``.
_BOARD = f""" , n AS (SELECT route, cast(round_even(delay_minutes, 0) AS INTEGER) AS delay_mins,
                        TIMESTAMP '{AS_OF}' + INTERVAL 1 HOUR AS local_now FROM merged)
         , e AS (SELECT *, time_bucket(INTERVAL 10 MINUTE, local_now) + INTERVAL 10 MINUTE AS sched FROM n)
         , f AS (SELECT *, sched + delay_mins * INTERVAL 1 MINUTE AS expect FROM e)
        SELECT route, delay_mins,
               CASE WHEN delay_mins <= 1 THEN 'ON TIME'
                    WHEN delay_mins <= 3 THEN concat('MINOR DELAY (+', delay_mins, ' MINS)')
                    ELSE concat('HEAVY DELAY (+', delay_mins, ' MINS)') END AS status,
               CASE WHEN delay_mins <= 1 THEN 'green' WHEN delay_mins <= 3 THEN 'yellow' ELSE 'red' END AS level,
               strftime(sched, '%H:%M') AS scheduled_time, strftime(expect, '%H:%M') AS expected_time,
               greatest(1, cast(floor((epoch(expect) - epoch(local_now)) / 60) AS INTEGER)) AS next_arrival_mins
        FROM f"""


def _history(source: str) -> str:
    return f"""
    SELECT route_id, {_round2("sum(average_delay_seconds) / count(average_delay_seconds)")}
               AS historical_avg_delay,
           count(*) AS total_window_batches_analyzed
    FROM {source} GROUP BY route_id"""


_LATENCY = {share: f"min(CASE WHEN up_to >= {share} * total THEN latency_seconds END)" for share in (0.5, 0.95, 0.99)}

_PARSED_CLEAN = r"""
    , pc AS (SELECT event_id, ts, regexp_extract(route_id, '(\d+[a-zA-Z]?)', 1) AS route_id, delay_seconds
             FROM p WHERE delay_seconds BETWEEN -300 AND 3600)
    , ps AS (SELECT route_id, delay_seconds,
                    unnest(generate_series(date_trunc('minute', ts) - INTERVAL 4 MINUTE,
                                           date_trunc('minute', ts), INTERVAL 1 MINUTE)) AS window_start
             FROM pc WHERE route_id <> '' AND ts IS NOT NULL)
    SELECT route_id, window_start, window_start + INTERVAL 5 MINUTE AS window_end,
           cast(sum(delay_seconds) AS DOUBLE) / count(delay_seconds) AS average_delay_seconds
    FROM ps GROUP BY route_id, window_start"""

ORACLE = {
    "telemetry_parse": _query("p", _PARSED),
    "telemetry_parse_s1": _query(
        "p",
        """ SELECT event_id, route_id, CASE WHEN form NOT IN (1, 7) THEN delay_seconds END AS delay_seconds,
                   CASE WHEN form = 1 THEN NULL ELSE ts END AS ts FROM p""",
    ),
    "telemetry_parse_s2": _query(
        "p",
        """ SELECT event_id, route_id,
                   CASE WHEN form <> 7 THEN cast(delay_seconds AS DOUBLE) END AS delay_seconds,
                   CASE WHEN form = 2 THEN NULL ELSE ts END AS ts FROM p""",
    ),
    "telemetry_clean": _query("c", "SELECT event_id, route_id, delay_seconds, ts FROM c"),
    "telemetry_clean_full": _query(
        "t",
        r""" SELECT event_id, regexp_extract(route_id, '([A-Z]?\d+[A-Za-z]?)', 1) AS route_id, delay_seconds, ts
             FROM t WHERE delay_seconds BETWEEN -300 AND 3600""",
    ),
    "telemetry_rejects": _query(
        "p",
        """ SELECT event_id, reason FROM (
                SELECT event_id, CASE WHEN form IN (3, 5) THEN 'unparsed' WHEN ts IS NULL THEN 'no event time' WHEN form = 4 THEN 'no route code'
                    WHEN form = 6 THEN 'no delay'
                    WHEN delay_seconds < -300 OR delay_seconds > 3600 THEN 'delay out of range' END AS reason
                FROM p) WHERE reason IS NOT NULL""",
    ),
    "sliding_delay": _query("w", _WINDOWED),
    "sliding_delay_expand": _query("w", _WINDOWED),
    "sliding_delay_raw": _query(
        "p",
        """ , rs AS (SELECT route_id, CASE WHEN form <> 7 THEN delay_seconds END AS delay_seconds,
                       unnest(generate_series(date_trunc('minute', ts) - INTERVAL 4 MINUTE,
                                              date_trunc('minute', ts), INTERVAL 1 MINUTE)) AS window_start
                     FROM p WHERE ts IS NOT NULL AND form <> 2)
            SELECT route_id, window_start, window_start + INTERVAL 5 MINUTE AS window_end,
                   CASE WHEN count(delay_seconds) > 0
                        THEN cast(sum(delay_seconds) AS DOUBLE) / count(delay_seconds) END AS average_delay_seconds
            FROM rs GROUP BY route_id, window_start""",
    ),
    "lake_rows": _query(
        "w",
        """ SELECT route_id, strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start,
                   strftime(window_end, '%Y-%m-%d %H:%M:%S') AS window_end, average_delay_seconds FROM w""",
    ),
    "top_delays": _query("w", _TOP),
    "lake_union": _query(
        "lake",
        """ SELECT event_id, route_id, delay_seconds, ts, window_start, window_end, average_delay_seconds
            FROM lake""",
    ),
    "historical_avg": _query("lake", _history("lake")),
    "historical_avg_merged": _query("mlake", _history("mlake")),
    "historical_first20": _query("lake", _history("lake") + " ORDER BY route_id NULLS FIRST LIMIT 20"),
    "route_avg_strict": _query(
        "lake",
        f""" SELECT route_id, {_round2("sum(average_delay_seconds) / count(*)")} AS average_delay FROM lake
             WHERE event_id % 17 <> 0 AND event_id % 19 <> 0 AND event_id % 23 <> 0 AND event_id % 29 <> 0
               AND route_id <> ''
               AND average_delay_seconds IS NOT NULL GROUP BY route_id""",
    ),
    "pairs_avg": _query(
        "t",
        f""" SELECT route_id, {_round2("cast(sum(delay_seconds) AS DOUBLE) / count(*)")} AS average_delay FROM t
             WHERE event_id % 20 <> 0 AND event_id % 21 <> 0 AND event_id % 23 <> 0 GROUP BY route_id""",
    ),
    "pairs_text": _query("t", "SELECT concat(route_id, chr(9), delay_seconds) AS value FROM t"),
    "latest_snapshot": _query(
        "c",
        """ , b AS (SELECT x.batch_id, c.route_id, date_trunc('minute', c.ts) AS window_start,
                           cast(sum(c.delay_seconds) AS DOUBLE) / count(*) AS average_delay_seconds
                    FROM c JOIN (VALUES (0), (1), (2)) AS x(batch_id) ON c.event_id % 3 <= x.batch_id
                    GROUP BY ALL)
            SELECT route_id, window_start, window_start + INTERVAL 1 MINUTE AS window_end, average_delay_seconds
            FROM (SELECT *, row_number() OVER (PARTITION BY route_id, window_start ORDER BY batch_id DESC) AS rn
                  FROM b) WHERE rn = 1""",
    ),
    "feed_flatten": """
        WITH stops AS (
            SELECT cast(floor(epoch(l_shipdate)) AS BIGINT) AS timestamp,
                   concat(l_suppkey % 500, '_', l_partkey) AS route_id, cast(l_orderkey AS VARCHAR) AS trip_id,
                   cast(trunc(l_quantity) AS INTEGER) AS q,
                   CASE WHEN l_linenumber > 1 THEN cast(trunc(l_quantity) AS INTEGER) ELSE 0 END AS q1,
                   l_linestatus = 'O' AS leaves, l_returnflag <> 'N' AS arrives, l_partkey, l_suppkey
            FROM lineitem)
        SELECT timestamp, route_id, trip_id, cast(l_partkey AS VARCHAR) AS stop_id,
               CASE WHEN leaves THEN q1 * 60 WHEN arrives THEN q * 30 ELSE 0 END AS delay_seconds FROM stops
        UNION ALL
        SELECT timestamp, route_id, trip_id, cast(l_suppkey AS VARCHAR),
               CASE WHEN arrives THEN q * 20 WHEN leaves THEN q1 * 10 ELSE 0 END FROM stops""",
    "polls_count": """
        SELECT time_bucket(INTERVAL 30 SECOND, ts) AS poll_ts, count(*) AS records FROM events GROUP BY 1""",
    "serving_current": _query("cur", _CURRENT),
    "serving_from_panes": _query("cur", _CURRENT),
    "merge_layers": _query("merged", "SELECT route, baseline_minutes, delay_minutes FROM merged"),
    "serving_coverage": _query(
        "store",
        """ SELECT count(*) AS routes, cast(sum(live) AS BIGINT) AS covered,
                   cast(sum(live) AS DOUBLE) / count(*) AS hit_ratio
            FROM (SELECT CASE WHEN s IS NOT NULL AND form <> 0 THEN 1 ELSE 0 END AS live FROM store)""",
    ),
    "lambda_view": _query(
        "mlake cur",
        f""" , h AS ({_history("mlake")})
            SELECT coalesce(h.route_id, cur.route_id) AS route_id, historical_avg_delay,
                   total_window_batches_analyzed, average_delay_seconds AS live_delay, window_end,
                   average_delay_seconds - historical_avg_delay AS live_minus_historical
            FROM h FULL JOIN cur ON h.route_id = cur.route_id""",
    ),
    "arrival_board": _query("merged", _BOARD),
    "hourly_profile": _query(
        "merged c",
        """ , hours AS (SELECT cast(unnest(generate_series(0, 23)) AS INTEGER) AS hour)
            , seen AS (SELECT route_id, cast(hour(ts) AS INTEGER) AS hour,
                              cast(sum(delay_seconds) AS DOUBLE) / count(*) AS mean_seconds
                       FROM c GROUP BY 1, 2)
            SELECT m.route, concat(lpad(cast(h.hour AS VARCHAR), 2, '0'), ':00') AS hour_label,
                   greatest(1, cast(trunc(coalesce(mean_seconds / 60.0, m.delay_minutes)) AS INTEGER)) AS delay_mins,
                   h.hour BETWEEN 7 AND 9 OR h.hour BETWEEN 17 AND 19 AS peak
            FROM merged m CROSS JOIN hours h LEFT JOIN seen s ON s.route_id = m.route AND s.hour = h.hour""",
    ),
    "vehicle_positions": _query(
        "c routes",
        f""" , seen AS (SELECT c.route_id AS route, count(*) AS reports FROM c
                        WHERE c.route_id IN (SELECT route FROM routes) GROUP BY 1)
             , paths AS (SELECT * FROM (VALUES {_values(PATHS.items())}) AS v(route, path))
             , veh AS (SELECT * FROM (VALUES {_values(VEHICLES)}) AS v(pos, suffix, speed, status))
             , full_path AS (SELECT seen.route, reports, coalesce(path, {_values([[DEFAULT_PATH]])[1:-1]}) AS path
                             FROM seen LEFT JOIN paths ON paths.route = seen.route)
            SELECT route, reports, concat('Bus-', route, '-', suffix) AS vehicle_id,
                   path[pos + 1][1] AS lon, path[pos + 1][2] AS lat, speed, status
            FROM full_path JOIN veh ON pos < len(path)""",
    ),
    "ingest_rate": """
        SELECT date_trunc('minute', ts) AS window_start, count(*) AS messages, count(*) / 60.0::DOUBLE AS per_second
        FROM events GROUP BY 1""",
    "ingest_peak": """
        WITH r AS (SELECT date_trunc('minute', ts) AS m, count(*) AS n FROM events GROUP BY 1)
        SELECT max(n) / 60.0::DOUBLE AS peak_per_second,
               (SELECT m FROM r ORDER BY n DESC, m LIMIT 1) AS peak_window,
               cast(sum(n) AS BIGINT) AS messages, count(*) AS windows FROM r""",
    "latency_exact": f"""
        WITH x AS (
            SELECT 'speed' AS layer, date_trunc('minute', ts) + INTERVAL 1 MINUTE AS o, ts FROM events
            UNION ALL
            SELECT 'batch', date_trunc('day', ts) + INTERVAL 1 DAY, ts FROM events)
        , s AS (SELECT layer, cast(floor((epoch_us(o) - epoch_us(ts)) / 1000000) AS BIGINT) AS latency_seconds FROM x)
        , r AS (SELECT layer, latency_seconds,
                       row_number() OVER (PARTITION BY layer ORDER BY latency_seconds) AS up_to,
                       count(*) OVER (PARTITION BY layer) AS total FROM s)
        SELECT layer, {_LATENCY[0.5]} AS p50, {_LATENCY[0.95]} AS p95, {_LATENCY[0.99]} AS p99,
               max(latency_seconds) AS worst, count(*) AS events FROM r GROUP BY layer""",
    "retain_recent": _query(
        "text",
        f""" , b AS (SELECT event_id, ts, octet_length(encode(payload)) AS bytes,
                            time_bucket(INTERVAL 2 MINUTE, ts) AS seg FROM text)
             , s AS (SELECT seg, sum(bytes) AS bytes, max(ts) AS newest FROM b GROUP BY seg)
             , y AS (SELECT * FROM s WHERE newest >= TIMESTAMP '{AS_OF}' - INTERVAL '{KEEP_AGE}')
             , n AS (SELECT seg, coalesce(sum(bytes) OVER (ORDER BY seg DESC
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS newer FROM y)
            SELECT event_id, ts, bytes FROM b WHERE seg IN (SELECT seg FROM n WHERE newer < {KEEP_BYTES})""",
    ),
    "route_topics": _query(
        "p",
        f""" SELECT event_id, concat('A.', event_type) AS topic,
                    CASE WHEN event_id % 26 <> 0 THEN route_id END AS route_id,
                    CASE WHEN event_id % 26 <> 0 THEN delay_seconds END AS delay_seconds,
                    CASE WHEN event_id % 26 <> 0 THEN ts END AS ts FROM p
             WHERE regexp_full_match(event_type, '{TOPIC_PATTERN}')""",
    ),
    "payload_json": _query(
        "t",
        """ SELECT concat('{"event_id":', event_id, ',"route_id":"', route_id, '","delay_seconds":',
                          coalesce(cast(d AS VARCHAR), 'null'), '}') AS value, route_id, d AS delay_seconds
            FROM (SELECT *, CASE WHEN event_id % 13 <> 0 THEN delay_seconds END AS d FROM t)""",
    ),
    "stream_sliding_delay": _query("w", _WINDOWED),
    "stream_upsert_delay": _query("w", _WINDOWED),
    "stream_panes": _query("w", _WINDOWED),
    "stream_speed_layer": _query("p", _PARSED_CLEAN),
    "stream_late_drop": _query(
        "slid c",
        f""" , x AS (SELECT c.event_id, c.ts < TIMESTAMP '{LATE_CUT}' AND c.event_id % 3 <> 0 AS on_time, c.ts FROM c)
             , marks AS (SELECT max(CASE WHEN on_time THEN ts END) - INTERVAL '{LATE}' AS first_mark,
                                max(ts) - INTERVAL '{LATE}' AS last_mark FROM x)
             , kept AS (SELECT s.* FROM slid s JOIN x ON x.event_id = s.event_id, marks
                        WHERE x.on_time OR s.window_start + INTERVAL 5 MINUTE > first_mark)
            SELECT route_id, window_start, window_start + INTERVAL 5 MINUTE AS window_end,
                   cast(sum(delay_seconds) AS DOUBLE) / count(*) AS average_delay_seconds
            FROM kept, marks WHERE window_start + INTERVAL 5 MINUTE <= last_mark
            GROUP BY route_id, window_start""",
    ),
    "stream_serving": _query("cur", _CURRENT),
    "stream_named_top": _query("w", _TOP),
    "stream_two_sinks": _query(
        "cur",
        """ SELECT w.*, cur.route_id IS NOT NULL AS is_current
            FROM w LEFT JOIN cur ON cur.route_id = w.route_id AND cur.window_start = w.window_start""",
    ),
    "raw_landing": _query("text", "SELECT payload AS value FROM text"),
    "text_tail": _query("text", "SELECT payload AS value FROM text"),
}
ORACLE["stream_rerun"] = ORACLE["stream_two_sinks"]
ORACLE["stream_dated_lake"] = _query("w", "SELECT *, cast(window_start AS DATE) AS event_date FROM w")
ORACLE["stream_snapshot_lake"] = _query(
    "slid",
    """ SELECT cast(b.batch_id AS BIGINT) AS batch_id, route_id, window_start,
               window_start + INTERVAL 5 MINUTE AS window_end,
               cast(sum(delay_seconds) AS DOUBLE) / count(*) AS average_delay_seconds
        FROM slid JOIN (VALUES (0), (1), (2)) AS b(batch_id) ON slid.event_id % 3 <= b.batch_id
        GROUP BY b.batch_id, route_id, window_start""",
)
ORACLE["route_board"] = f"SELECT * FROM ({ORACLE['arrival_board']}) WHERE route = '{ONE_ROUTE}'"
ORACLE["sql_board"] = ORACLE["arrival_board"]
ORACLE["stream_board"] = _query(
    "routes cur base",
    f""" , merged AS (
            SELECT r.route, greatest(0.0, least(15.0, coalesce(cur.average_delay_seconds / 60.0, b.baseline_minutes,
                                                               {DEFAULT_BASELINE}))) AS delay_minutes
            FROM routes r LEFT JOIN cur ON cur.route_id = r.route LEFT JOIN base b ON b.route = r.route)"""
    + _BOARD,
)
ORACLE["sql_clean"] = _query("c", " SELECT route_id AS route, count(*) AS reports FROM c GROUP BY 1")
ORACLE["route_baselines"] = _query(
    "c base",
    f""" SELECT route_id AS route, count(*) AS reports, coalesce(any_value(baseline_minutes), {DEFAULT_BASELINE}::DOUBLE)
                AS baseline_minutes
         FROM c LEFT JOIN base ON base.route = route_id GROUP BY 1""",
)
ORACLE["events_so_far"] = """
    SELECT event_type, count(*) FILTER (epoch(ts) <= epoch(now())) AS so_far,
           count(*) FILTER (epoch(ts) > epoch(now())) AS to_come FROM events GROUP BY 1"""
ORACLE["feed_from_bytes"] = ORACLE["feed_flatten"]
ORACLE["feed_rejects"] = """
    SELECT cast(l_orderkey AS VARCHAR) AS "order", 'broken message' AS problem FROM lineitem WHERE l_linenumber = 1"""
ORACLE["stream_empty_batch"] = _query(
    "t",
    """ SELECT cast(event_id % 2 * 2 AS BIGINT) AS batch_id, count(*) AS reports FROM t
        WHERE delay_seconds BETWEEN -300 AND 3600 GROUP BY 1""",
)
ORACLE["strict_from_lines"] = ORACLE["route_avg_strict"]
ORACLE["feed_from_json"] = ORACLE["feed_flatten"]
ORACLE["historical_from_json"] = _query(
    "lake",
    """ , read AS (SELECT CASE WHEN event_id % 17 <> 0 THEN route_id END AS route_id,
                          CASE WHEN event_id % 17 <> 0 THEN average_delay_seconds END AS average_delay_seconds
                   FROM lake WHERE event_id % 17 = 0 OR event_id % 19 <> 0)"""
    + _history("read"),
)
ORACLE["historical_from_documents"] = ORACLE["historical_from_json"]
ORACLE["feed_from_documents"] = ORACLE["feed_flatten"]
ORACLE["document_families"] = _query(
    "lake",
    """ , read AS (SELECT event_id, CASE WHEN event_id % 17 = 0 THEN 'broken' WHEN delay_seconds IS NULL THEN 'windowed'
                                       ELSE 'raw' END AS family
                   FROM lake WHERE event_id % 17 = 0 OR event_id % 19 <> 0)
        SELECT family, count(*) AS rows, count(*) FILTER (family <> 'broken' AND event_id % 5 = 0) AS with_others,
               cast(sum(event_id) FILTER (family <> 'broken' AND event_id % 5 = 0) AS BIGINT) AS vehicles
        FROM read GROUP BY 1
        UNION ALL SELECT 'feed', count(*), 0, NULL FROM lineitem""",
)
ORACLE["lake_footprint"] = """
    SELECT cast(ts AS DATE) AS event_date, count(*) AS rows, true AS has_files, true AS has_bytes FROM events GROUP BY 1"""
ORACLE["latency_report"] = ORACLE["latency_exact"].replace(
    "SELECT layer, min(", ", e AS (SELECT layer, min(", 1
) + """)
    SELECT layer, share, worst, events, true AS within FROM e, (VALUES ('p50'), ('p95'), ('p99')) AS s(share)"""
ORACLE["stream_quarantine"] = ORACLE["telemetry_rejects"]
ORACLE["stream_two_runs"] = ORACLE["stream_panes"]
ORACLE["latency_sketched"] = ORACLE["latency_report"]
ORACLE["stream_state_serving"] = ORACLE["stream_serving"]
ORACLE["history_refresh"] = _query(
    "w",
    f""" SELECT route_id, {_round2("avg(average_delay_seconds)")} AS historical_avg_delay,
                count(*) AS total_window_batches_analyzed FROM w GROUP BY route_id""",
)
ORACLE["stream_progress"] = _query(
    "t",
    """ SELECT cast(event_id % 3 AS BIGINT) AS batch_id, count(*) AS rows_in,
               count(*) FILTER (delay_seconds BETWEEN -300 AND 3600) AS good,
               count(*) FILTER (delay_seconds NOT BETWEEN -300 AND 3600) AS rejected, 0::BIGINT AS late, true AS timed
        FROM t GROUP BY 1""",
)
ORACLE["stream_late_split"] = _query(
    "t",
    rf""" , due AS (
            SELECT event_id, route_id, delay_seconds,
                   least(CASE WHEN ts < '{DELIVERIES[0]}' THEN 0 WHEN ts < '{DELIVERIES[1]}' THEN 1 ELSE 2 END
                         + CASE WHEN event_id % {LAG} = 0 THEN 1 ELSE 0 END, 2) AS k,
                   CASE WHEN event_id % {WRONG} = 5 THEN ts + INTERVAL 365 DAY ELSE ts END AS ts FROM t),
        judged AS (
            SELECT *, CASE WHEN ts > ['{DELIVERIES[0]}', '{DELIVERIES[1]}', '{DELIVERIES[2]}'][k + 1]::TIMESTAMP + INTERVAL 1 HOUR
                               THEN 'event time ahead'
                           WHEN delay_seconds NOT BETWEEN -300 AND 3600 THEN 'delay out of range' END AS reason FROM due),
        marks AS (
            SELECT d.k, max(j.ts) - INTERVAL {LATE} AS mark FROM (VALUES (1), (2)) AS d(k)
            JOIN judged j ON j.k < d.k AND j.reason IS NULL GROUP BY d.k),
        split AS (
            SELECT event_id, regexp_extract(route_id, '(\d+[a-zA-Z]?)', 1) AS route_id, delay_seconds, ts,
                   coalesce(reason, CASE WHEN date_trunc('minute', ts) + INTERVAL 1 MINUTE <= mark THEN 'late' END) AS reason
            FROM judged LEFT JOIN marks USING (k)),
        spread AS (
            SELECT route_id, delay_seconds,
                   unnest(generate_series(date_trunc('minute', ts) - INTERVAL 4 MINUTE,
                                          date_trunc('minute', ts), INTERVAL 1 MINUTE)) AS window_start
            FROM split WHERE reason IS NULL)
        SELECT route_id, window_start, window_start + INTERVAL 5 MINUTE AS window_end,
               cast(sum(delay_seconds) AS DOUBLE) / count(*) AS average_delay_seconds,
               NULL::BIGINT AS event_id, NULL::VARCHAR AS reason
        FROM spread GROUP BY route_id, window_start
        UNION ALL
        SELECT NULL, NULL, NULL, NULL, event_id, reason FROM split WHERE reason IS NOT NULL""",
)
