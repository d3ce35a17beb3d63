"""The registered queries in plain SQL, for checking against another engine.

The SQL follows the counting rules in its own way: a run's next counted sighting is found with a
range window, and a recursive query walks from one counted sighting to the next.
"""

from __future__ import annotations

from footfall.schemas import HOUR_COLUMNS, HOURS

EVENTS = """SELECT event_id AS seq, CAST(user_id AS VARCHAR) AS dev_id, event_type AS station_id,
  date_trunc('second', ts) AS event_ts, CAST(ts AS DATE) AS event_date FROM events"""
DENSE = """SELECT event_id AS seq, event_type AS dev_id,
  'band-' || CAST(CAST(floor(value / 100) AS BIGINT) AS VARCHAR) AS station_id,
  date_trunc('second', ts) AS event_ts, CAST(ts AS DATE) AS event_date FROM events"""
ORDERS = """SELECT o_orderkey AS seq, o_orderstatus AS dev_id,
  o_orderpriority AS station_id, o_orderdate AS event_ts,
  CAST(o_orderdate AS DATE) AS event_date FROM orders"""


def text(column: str) -> str:
    """A timestamp as text."""
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


def day(column: str) -> str:
    """A date as text."""
    return f"strftime({column}, '%Y-%m-%d')"


def with_visits(base: str, body: str) -> str:
    """``body`` over the relations s (sightings), visits and flows."""
    return f"""WITH RECURSIVE s AS ({base}),
lagged AS (SELECT *, lag(station_id) OVER w AS prev_station_id FROM s
  WINDOW w AS (PARTITION BY dev_id, event_date ORDER BY event_ts, seq)),
runs AS (SELECT *, sum(CASE WHEN prev_station_id = station_id THEN 0 ELSE 1 END) OVER
  (PARTITION BY dev_id, event_date ORDER BY event_ts, seq ROWS UNBOUNDED PRECEDING) AS run
  FROM lagged),
jumps AS (SELECT *, min(event_ts) OVER (PARTITION BY dev_id, event_date, run ORDER BY event_ts
  RANGE BETWEEN INTERVAL 1801 SECOND FOLLOWING AND UNBOUNDED FOLLOWING) AS next_ts,
  row_number() OVER (PARTITION BY dev_id, event_date, run, event_ts ORDER BY seq) AS nth,
  row_number() OVER (PARTITION BY dev_id, event_date, run ORDER BY event_ts, seq) AS pos
  FROM runs),
points AS (SELECT * FROM jumps WHERE nth = 1),
counted AS (
  SELECT dev_id, event_date, run, event_ts, seq, station_id, prev_station_id, next_ts,
    CASE WHEN prev_station_id IS NULL THEN 'first' ELSE 'move' END AS kind
  FROM points WHERE pos = 1
  UNION ALL
  SELECT p.dev_id, p.event_date, p.run, p.event_ts, p.seq, p.station_id, p.prev_station_id,
    p.next_ts, 'revisit' AS kind
  FROM counted c JOIN points p ON p.dev_id = c.dev_id AND p.event_date = c.event_date
    AND p.run = c.run AND p.event_ts = c.next_ts),
visits AS (SELECT dev_id, station_id, prev_station_id, event_ts, seq, event_date AS stat_date,
  CAST(hour(event_ts) AS INTEGER) AS hour, kind FROM counted),
flows AS (SELECT dev_id, prev_station_id AS src_station_id, station_id AS dst_station_id, event_ts,
  seq, stat_date, hour FROM visits WHERE kind = 'move')
{body}"""


VISIT_COLUMNS = "dev_id, station_id, prev_station_id, event_ts, seq, stat_date, hour, kind"
FLOW_COLUMNS = "dev_id, src_station_id, dst_station_id, event_ts, seq, stat_date, hour"
SIGHTING_COLUMNS = "seq, station_id, dev_id, event_ts, event_date"
WIDE = ", ".join(
    f"CAST(count(*) FILTER (WHERE hour = {h}) AS BIGINT) AS {c}" for h, c in zip(HOURS, HOUR_COLUMNS)
)
ZEROS = ", ".join(f"CAST(0 AS BIGINT) AS {c}" for c in HOUR_COLUMNS)
ALL_HOURS = ", ".join(HOUR_COLUMNS)
PAIR = "src_station_id, dst_station_id"
STATIONS = "SELECT DISTINCT event_type AS station_id FROM events UNION ALL SELECT 'kiosk'"
STATE = (
    "SELECT dev_id, stat_date AS start_date, arg_max(event_ts, (event_ts, seq)) AS last_datetime, "
    "arg_max(station_id, (event_ts, seq)) AS station_id FROM visits GROUP BY dev_id, stat_date"
)

# Where the watermark of a stream over all sightings ends: four days behind the newest.
WATERMARK = "(SELECT max(event_ts) - INTERVAL 4 DAY FROM s)"


def shown(body: str, dates: str = "", times: str = "") -> str:
    """``body`` with the named date and timestamp columns as text."""
    columns = [f"{day(c)} AS {c}" for c in dates.split()] + [f"{text(c)} AS {c}" for c in times.split()]
    return f"SELECT * REPLACE ({', '.join(columns)}) FROM ({body})"


def days(first: str, last: str) -> str:
    """All days from first to last."""
    return (
        f"SELECT CAST(d AS DATE) AS stat_date FROM "
        f"generate_series(DATE '{first}', DATE '{last}', INTERVAL 1 DAY) g(d)"
    )


def station_grid(first: str, last: str) -> str:
    """Each station on each day."""
    return f"SELECT station_id, stat_date FROM ({STATIONS}) st, ({days(first, last)}) d"


def flow_grid(first: str, last: str) -> str:
    """Each pair of different stations on each day."""
    return (
        f"SELECT a.station_id AS src_station_id, b.station_id AS dst_station_id, stat_date "
        f"FROM ({STATIONS}) a, ({STATIONS}) b, ({days(first, last)}) d "
        f"WHERE a.station_id <> b.station_id"
    )


def wide(keys: str, facts: str) -> str:
    """Facts to the wide hourly form."""
    return f"SELECT {keys}, stat_date, {WIDE} FROM {facts} GROUP BY {keys}, stat_date"


def missing(keys: str, facts: str, grid: str) -> str:
    """Zeros for the grid keys without any fact."""
    return f"SELECT {keys}, stat_date, {ZEROS} FROM ({grid}) g ANTI JOIN {facts} f USING ({keys}, stat_date)"


def dense(keys: str, facts: str, grid: str) -> str:
    """Wide rows, and zeros for grid keys without any."""
    return f"{wide(keys, facts)} UNION ALL {missing(keys, facts, grid)}"


def month_totals(keys: str, facts: str) -> str:
    """Facts per key and month, dated with the first day that has one."""
    return (
        f"SELECT {keys}, CAST(date_trunc('month', stat_date) AS DATE) AS month, "
        f"min(stat_date) AS stat_date, count(*) AS count FROM {facts} "
        f"GROUP BY {keys}, date_trunc('month', stat_date)"
    )


def first_half(facts: str) -> str:
    """Facts of the first fifteen days of each month."""
    return f"(SELECT * FROM {facts} WHERE day(stat_date) <= 15)"


def upserted(keys: str, facts: str) -> str:
    """Totals of the first half of each month, updated and completed by those of the whole."""
    names = ", ".join(f"coalesce(o.{k}, n.{k}) AS {k}" for k in keys.split(", "))
    on = " AND ".join(f"o.{k} = n.{k}" for k in [*keys.split(", "), "month"])
    return (
        f"SELECT {names}, coalesce(o.stat_date, n.stat_date) AS stat_date, "
        f"coalesce(n.count, o.count) AS count FROM ({month_totals(keys, first_half(facts))}) o "
        f"FULL JOIN ({month_totals(keys, facts)}) n ON {on}"
    )


# The rule that decides which messages are bad, and the text of each message.
K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
CUT = f"(event_type = 'error' AND {K} < 20)"
NUMERIC = f"(event_type = 'click' AND {K} < 10)"
LATE_T = f"(event_type = 'view' AND {K} >= 90)"
WORDS = f"(event_type = 'signup' AND {K} < 5)"
BAD = f"({CUT} OR {NUMERIC} OR {LATE_T})"
SENSOR = "CAST(CAST(floor(value) AS BIGINT) AS VARCHAR)"


def messages(log: bool) -> str:
    """(seq, value, problem) of each event; problem only covers what both messages check."""
    name, sensor = "", SENSOR
    if log:
        sensor = f"CASE WHEN {WORDS} THEN 'north-gate' ELSE {SENSOR} END"
        name = "|| CASE WHEN event_type = 'purchase' THEN '\"stationName\":\"PURCHASE\",' ELSE '' END "
    station = f"CASE WHEN {NUMERIC} THEN CAST({K} AS VARCHAR) ELSE '\"' || event_type || '\"' END"
    when = f"CASE WHEN {LATE_T} THEN replace({text('ts')}, ' ', 'T') ELSE {text('ts')} END"
    body = (
        f"'{{\"sensorID\":\"' || {sensor} || '\",\"stationID\":' || {station} || "
        f"',\"sensorType\":\"gate\",' {name}|| '\"deviceID\":\"' || user_id || '\",\"power\":' || "
        f"(-{K}) || ',\"dsStatus\":1,\"datetime\":\"' || {when} || '\"}}'"
    )
    problem = (
        f"CASE WHEN {CUT} THEN 'not_json' WHEN {NUMERIC} THEN 'bad_field' "
        f"WHEN {LATE_T} THEN 'bad_datetime' END"
    )
    return (
        f"SELECT seq, CASE WHEN cut THEN left(body, length(body) - 2) ELSE body END AS value, problem "
        f"FROM (SELECT event_id AS seq, {body} AS body, {CUT} AS cut, {problem} AS problem FROM events)"
    )


LOG_ROWS = (
    f'SELECT event_id AS seq, CAST({SENSOR} AS INTEGER) AS "SensorId", '
    f'CAST(user_id AS VARCHAR) AS "Mac", CAST(-{K} AS INTEGER) AS "Rssi", '
    f"date_trunc('second', ts) AS \"TimeNow\" FROM events WHERE NOT ({BAD} OR {WORDS})"
)
FIRST_STRAY = (
    f"(SELECT * FROM events WHERE event_type = 'view' AND {K} < 90 ORDER BY event_id LIMIT 1)"
)
WITH_STRAYS = (
    "FROM (SELECT event_id, ts, user_id, event_type, value, props FROM events "
    "UNION ALL SELECT -1, ts + INTERVAL 7 YEAR, user_id, event_type, value, props "
    f"FROM {FIRST_STRAY} UNION ALL SELECT -2, ts - INTERVAL 10 DAY, user_id, event_type, value, props "
    f"FROM {FIRST_STRAY})"
)


def first_log_rows(rows: str) -> str:
    """The first row of each log key."""
    return (
        'SELECT "SensorId", "Mac", arg_min("Rssi", seq) AS "Rssi", "TimeNow" '
        f'FROM ({rows}) GROUP BY "SensorId", "Mac", "TimeNow"'
    )


def decoded(log: bool) -> str:
    """Fields of the accepted messages."""
    name = "CASE WHEN event_type = 'purchase' THEN 'PURCHASE' END AS \"stationName\", " if log else ""
    bad = f"({BAD} OR {WORDS})" if log else BAD
    return (
        f'SELECT event_id AS seq, {SENSOR} AS "sensorID", \'gate\' AS "sensorType", '
        f'event_type AS "stationID", {name}CAST(user_id AS VARCHAR) AS "deviceID", '
        f'CAST(-{K} AS INTEGER) AS power, CAST(1 AS INTEGER) AS "dsStatus", '
        f"{text('ts')} AS datetime FROM events WHERE NOT {bad}"
    )


def _scalars() -> dict[str, str]:
    offsets = ", ".join(
        f"{day(f'CAST(o_orderdate AS DATE) + ({n})')} AS day_{'plus' if n > 0 else 'minus'}_{abs(n)}"
        for n in (1, -1, -2, -3, -4)
    )
    before = "o_orderdate - INTERVAL 1 MONTH"
    return {
        "parse_datetime": f"SELECT event_id, CASE WHEN event_type <> 'view' THEN {text('ts')} END "
        "AS parsed FROM events",
        "format_datetime": f"SELECT event_id, {text('ts')} AS datetime, {day('ts')} AS date FROM events",
        "to_date": f"SELECT o_orderkey, {day('o_orderdate')} AS event_date FROM orders",
        "hour_of": "SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour FROM events",
        "hour_column": "SELECT event_id, 'hour_' || lpad(CAST(hour(ts) AS VARCHAR), 2, '0') "
        "AS hour_column FROM events",
        "partition_name": "SELECT o_orderkey, strftime(o_orderdate, 'p%Y_%m_%d') AS name, "
        "strftime(o_orderdate, 'p%y%m%d') AS short_name FROM orders",
        "year_month": "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, "
        "CAST(month(o_orderdate) AS INTEGER) AS month FROM orders",
        "shift_hours": f"SELECT event_id, {text('ts + INTERVAL 3 HOUR')} AS shifted FROM events",
        "last_month": f"SELECT o_orderkey, CAST(year({before}) AS INTEGER) AS year, "
        f"CAST(month({before}) AS INTEGER) AS month FROM orders",
        "day_offset": f"SELECT o_orderkey, {offsets} FROM orders",
        "to_int": "SELECT o_orderkey, CAST(left(o_orderpriority, 1) AS INTEGER) AS digit, "
        "CAST(NULL AS INTEGER) AS words FROM orders",
        "json_decode": f"SELECT event_id, {K} AS k FROM events",
        "row_sum24": with_visits(
            EVENTS,
            shown(
                "SELECT station_id, stat_date, count(*) AS total FROM visits "
                "GROUP BY station_id, stat_date",
                "stat_date",
            ),
        ),
    }


def _messages() -> dict[str, str]:
    return {
        "src_station_dim": "SELECT CAST(n_nationkey AS VARCHAR) AS station_id, "
        "n_name AS station_name FROM nation",
        "src_sightings": f"SELECT seq, value FROM ({messages(False)})",
        "src_device_log": f"SELECT seq, value FROM ({messages(True)})",
        "decode_sighting": decoded(False),
        "decode_device_log": decoded(True),
        "quarantine_bad": f"SELECT * FROM ({messages(False)}) WHERE problem IS NOT NULL",
        "project_sighting": f"SELECT event_id AS seq, {SENSOR} AS sensor_id, event_type AS station_id, "
        f"CAST(user_id AS VARCHAR) AS dev_id, {text('ts')} AS event_ts, {day('ts')} AS event_date "
        f"FROM events WHERE NOT {BAD}",
        "project_device_log": shown(LOG_ROWS, times='"TimeNow"'),
        "dedup_device_log": shown(first_log_rows(LOG_ROWS), times='"TimeNow"'),
        "snk_device_log": shown(
            first_log_rows(LOG_ROWS.replace("FROM events", WITH_STRAYS)), times='"TimeNow"'
        ),
        "snk_device_log_rejected": "SELECT m.* REPLACE (coalesce(problem, 'bad_sensor') AS problem) "
        f"FROM ({messages(True)}) m JOIN events ON seq = event_id, generate_series(1, 2) "
        f"WHERE problem IS NOT NULL OR {WORDS}",
    }


def _rules() -> dict[str, str]:
    def visits(base: str, condition: str = "true") -> str:
        body = f"SELECT {VISIT_COLUMNS} FROM visits WHERE {condition}"
        return with_visits(base, shown(body, "stat_date", "event_ts"))

    def sightings(base: str, source: str) -> str:
        body = f"SELECT {SIGHTING_COLUMNS} FROM {source}"
        return with_visits(base, shown(body, "event_date", "event_ts"))

    def state(condition: str = "true") -> str:
        body = f"SELECT * FROM ({STATE}) WHERE {condition}"
        return with_visits(EVENTS, shown(body, "start_date", "last_datetime"))

    def writes(kind: str, write: str) -> str:
        body = (
            "SELECT dev_id, stat_date AS start_date, event_ts AS last_datetime, station_id, seq, "
            f"'{write}' AS write FROM visits WHERE kind = '{kind}'"
        )
        return with_visits(DENSE, shown(body, "start_date", "last_datetime"))

    found = (
        "SELECT a.*, st.last_datetime AS stored_ts, st.station_id AS stored_station_id "
        f"FROM (SELECT {SIGHTING_COLUMNS} FROM ({EVENTS}) WHERE hour(event_ts) >= 12) a "
        f"LEFT JOIN ({STATE}) st ON st.dev_id = a.dev_id AND st.start_date = a.event_date"
    )
    lookup = with_visits(
        f"SELECT * FROM ({EVENTS}) WHERE hour(event_ts) < 12",
        shown(found, "event_date", "event_ts stored_ts"),
    )
    flows = with_visits(EVENTS, shown(f"SELECT {FLOW_COLUMNS} FROM flows", "stat_date", "event_ts"))
    horizon = "DATE '2024-01-18' AND DATE '2024-01-21'"

    def outside(condition: str, reason: str) -> str:
        body = f"SELECT {SIGHTING_COLUMNS}, '{reason}' AS reason FROM ({EVENTS}) WHERE event_date {condition}"
        return shown(body, "event_date", "event_ts")

    return {
        "visit_first": visits(EVENTS, "kind = 'first'"),
        "visit_revisit": visits(DENSE, "kind = 'revisit'"),
        "visit_move": visits(EVENTS, "kind = 'move'"),
        "visit_ignore": sightings(DENSE, "s ANTI JOIN visits USING (seq)"),
        "count_visits": visits(EVENTS),
        "count_visits_dense": visits(DENSE),
        "count_visits_split": visits(DENSE),
        "st_visits": visits(EVENTS),
        "st_visits_from_state": visits(EVENTS, "hour >= 12"),
        "st_device_state": state(f"start_date + INTERVAL 1 DAY > {WATERMARK}"),
        "st_microbatch": visits(DENSE),
        "st_visits_dropped": shown(
            f"SELECT {SIGHTING_COLUMNS}, 'future' AS reason FROM ({EVENTS.replace('FROM events', WITH_STRAYS)}) "
            f"WHERE seq = -1 UNION ALL SELECT {SIGHTING_COLUMNS}, 'late' AS reason "
            f"FROM ({EVENTS.replace('FROM events', WITH_STRAYS)}) WHERE seq = -2",
            "event_date",
            "event_ts",
        ),
        "st_microbatch_dropped": shown(
            f"SELECT {SIGHTING_COLUMNS}, CASE WHEN event_date < DATE '2024-01-18' THEN 'late' ELSE 'future' END "
            f"AS reason FROM ({DENSE}) WHERE event_date NOT BETWEEN {horizon}",
            "event_date",
            "event_ts",
        ),
        "join_prev_state": visits(EVENTS, "hour >= 12"),
        "lookup_state": lookup,
        "filter_same_station": sightings(DENSE, "lagged WHERE prev_station_id = station_id"),
        "filter_gap30": sightings(DENSE, "s WHERE seq IN (SELECT seq FROM visits WHERE kind = 'revisit')"),
        "flow_move": flows,
        "device_state": state(),
        "src_device_state": state("start_date = DATE '2024-01-15'"),
        "expire_state": state("start_date > DATE '2024-01-20' - 3"),
        "snk_device_state_insert": writes("first", "insert"),
        "snk_device_state_touch": writes("revisit", "touch"),
        "snk_device_state_move": writes("move", "move"),
        "filter_horizon": shown(
            f"SELECT {SIGHTING_COLUMNS} FROM ({EVENTS}) WHERE event_date BETWEEN {horizon}",
            "event_date",
            "event_ts",
        ),
        "late_drop": outside("< DATE '2024-01-18'", "late"),
        "future_drop": outside("> DATE '2024-01-21'", "future"),
    }


def _hourly() -> dict[str, str]:
    def shape(body: str) -> str:
        return with_visits(EVENTS, shown(body, "stat_date"))

    def counts(keys: str, facts: str, condition: str = "true") -> str:
        return shape(
            f"SELECT {keys}, stat_date, hour, count(*) AS count FROM {facts} "
            f"WHERE {condition} GROUP BY {keys}, stat_date, hour"
        )

    passed = f"stat_date + to_hours(hour + 1) <= {WATERMARK}"

    stations, flows = wide("station_id", "visits"), wide(PAIR, "flows")
    january = ("2024-01-01", "2024-01-31")
    all_stations = dense("station_id", "visits", station_grid(*january))
    all_flows = dense(PAIR, "flows", flow_grid(*january))
    two_days = ("2024-01-30", "2024-01-31")
    return {
        "station_hourly": counts("station_id", "visits"),
        "flows_hourly": counts(PAIR, "flows"),
        "st_station_hourly": counts("station_id", "visits", passed),
        "st_flows_hourly": counts(PAIR, "flows", passed),
        "pivot_hours_station": shape(stations),
        "pivot_hours_flow": shape(flows),
        "snk_station_hour": shape(stations),
        "snk_flow_hour": shape(flows),
        "densify_station": shape(all_stations),
        "densify_flows": shape(all_flows),
        "snk_station_hour_ensure": shape(all_stations),
        "snk_flow_hour_ensure": shape(all_flows),
        "insert_missing": shape(missing(PAIR, "flows", flow_grid(*january))),
        "filter_no_self_pair": shown(flow_grid(*january), "stat_date"),
        "filter_key_date": shape(
            f"SELECT * FROM ({stations}) WHERE station_id = 'view' AND stat_date = DATE '2024-01-15'"
        ),
        "hourly_refresh": shape(
            "SELECT station_id AS src_station_id, station_id AS dst_station_id, stat_date, "
            f"{ALL_HOURS} FROM ({dense('station_id', 'visits', station_grid(*two_days))}) "
            f"UNION ALL {dense(PAIR, 'flows', flow_grid(*two_days))}"
        ),
    }


def _months() -> dict[str, str]:
    def shape(body: str, dates: str = "stat_date") -> str:
        return with_visits(ORDERS, shown(body, dates))

    stations, flows = month_totals("station_id", "visits"), month_totals(PAIR, "flows")
    july = "stat_date >= DATE '1998-07-01' AND stat_date < DATE '1998-08-01'"
    everything = (
        "SELECT station_id AS src_station_id, station_id AS dst_station_id, stat_date, count "
        f"FROM ({stations}) UNION ALL SELECT {PAIR}, stat_date, count FROM ({flows})"
    )
    return {
        "station_monthly": shape(f"SELECT * EXCLUDE (month) FROM ({stations})"),
        "flows_monthly": shape(f"SELECT * EXCLUDE (month) FROM ({flows})"),
        "station_monthly_null_hours": shape(
            null_hours("station_id", "visits", " + ".join(f"sum({c})" for c in HOUR_COLUMNS))
        ),
        "flows_monthly_null_hours": shape(null_hours(PAIR, "flows", f"sum({' + '.join(HOUR_COLUMNS)})")),
        "snk_station_month_update_or_insert": shape(updated_or_inserted("station_id", "visits")),
        "snk_flows_month_update_or_insert": shape(updated_or_inserted(PAIR, "flows")),
        "representative_date": shape(f"SELECT station_id, stat_date FROM ({stations})"),
        "distinct_by_group": shape(f"SELECT {PAIR}, month FROM ({flows})", "month"),
        "exists_month": shape(f"SELECT DISTINCT month FROM ({stations})", "month"),
        "filter_month": shape(f"SELECT * FROM ({wide('station_id', 'visits')}) WHERE {july}"),
        "src_station_month": shape(f"SELECT * FROM ({wide('station_id', 'visits')}) WHERE {july}"),
        "src_flows_month": shape(f"SELECT * FROM ({wide(PAIR, 'flows')}) WHERE {july}"),
        "snk_station_month_upsert": shape(upserted("station_id", "visits")),
        "snk_flows_month_upsert": shape(upserted(PAIR, "flows")),
        "update_existing": shape(
            f"SELECT o.src_station_id, o.dst_station_id, o.stat_date, n.count "
            f"FROM ({month_totals(PAIR, first_half('flows'))}) o "
            f"JOIN ({flows}) n USING (src_station_id, dst_station_id, month)"
        ),
        "monthly_refresh": with_visits(EVENTS, shown(everything, "stat_date")),
    }


def null_hours(keys: str, facts: str, total: str) -> str:
    """Monthly totals of wide rows with NULL hours; a total that comes out NULL is 0."""
    rows = (
        f"SELECT * REPLACE (CASE WHEN day(stat_date) % 3 <> 0 THEN hour_00 END AS hour_00, "
        f"CASE WHEN month(stat_date) % 2 <> 0 THEN hour_07 END AS hour_07) FROM ({wide(keys, facts)})"
    )
    return (
        f"SELECT {keys}, min(stat_date) AS stat_date, CAST(coalesce({total}, 0) AS BIGINT) AS count "
        f"FROM ({rows}) GROUP BY {keys}, date_trunc('month', stat_date)"
    )


def updated_or_inserted(keys: str, facts: str) -> str:
    """Totals up to 1996 updated from whole months, and the months that were missing."""
    early = f"(SELECT * FROM {first_half(facts)} WHERE stat_date < DATE '1997-01-01')"
    old, new = month_totals(keys, early), month_totals(keys, facts)
    return (
        f"SELECT {keys}, o.stat_date, n.count FROM ({old}) o JOIN ({new}) n USING ({keys}, month) "
        f"UNION ALL SELECT {keys}, stat_date, count FROM ({new}) WHERE month NOT IN (SELECT month FROM ({old}))"
    )


def oracle_sql() -> dict[str, str]:
    """SQL per registered query."""
    return _scalars() | _messages() | _rules() | _hourly() | _months()
