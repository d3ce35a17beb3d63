import datetime as dt
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from footfall.functions import times
from footfall.operators import decode, devicelog, grid, horizon, monthly, sinks, skew, state, stats
from footfall.plans.refresh import grid_days
from footfall.schemas import (
    DEVICE_LOG,
    FLOW_KEY,
    HOUR_COLUMNS,
    MESSAGE,
    SIGHTING,
    STATION_KEY,
    hourly_wide,
)
from footfall.schemas import monthly as monthly_schema
from footfall.sources import tables
from footfall.streaming.visits import epoch_seconds, from_epoch_seconds

D = dt.date
GOOD = {
    "sensorID": "0419", "sensorType": "door", "stationID": "harbour-east",
    "deviceID": "device-0b1c", "power": -41, "dsStatus": 3,
    "datetime": "2021-11-07 06:05:09",
}


def changed(**fields):
    body = {**GOOD, **fields}
    return json.dumps({k: v for k, v in body.items() if v != "absent"})


SIGHTING_CASES = [
    (json.dumps(GOOD), None),
    (changed(extra={"stationID": 5}), None),
    (changed(power=-41.0), None),
    (changed(sensorID="gate"), None),
    ("{", "not_json"),
    ("", "not_json"),
    (json.dumps(GOOD)[:-2], "not_json"),
    ("[1, 2]", "bad_field"),
    ("7", "bad_field"),
    ("{}", "bad_field"),
    (changed(stationID=5), "bad_field"),
    (changed(stationID=None), "bad_field"),
    (changed(stationID={"id": "x"}), "bad_field"),
    (changed(deviceID="absent"), "bad_field"),
    (changed(power="-41"), None),
    (changed(power="-41.0"), None),
    (changed(power=" -41"), "bad_field"),
    (json.dumps(GOOD)[:-1] + ', "power": -7}', None),
    (json.dumps(GOOD) + " x", "not_json"),
    (changed(power="loud"), "bad_field"),
    (changed(power=1.5), "bad_field"),
    (changed(power=True), "bad_field"),
    (changed(dsStatus=99999999999), "bad_field"),
    (changed(datetime="2021-11-07T06:05:09"), "bad_datetime"),
    (changed(datetime="2021-11-07 06:05"), "bad_datetime"),
    (changed(datetime="2021-02-30 06:05:09"), "bad_datetime"),
    (changed(datetime="2021-11-07 24:00:00"), "bad_datetime"),
]
LOG_CASES = [
    (changed(sensorID="518", stationName="Harbour"), None),
    (changed(sensorID="518"), None),
    (changed(sensorID="518", stationName=None), None),
    (changed(sensorID="-7"), None),
    (changed(sensorID="518", stationName=5), "bad_field"),
    (changed(sensorID="gate-7"), "bad_sensor"),
    (changed(sensorID="7.0"), "bad_sensor"),
    (changed(sensorID="99999999999"), "bad_sensor"),
    (changed(sensorID="7", power=-129), "bad_power"),
]


@pytest.mark.parametrize(
    "read,cases", [(decode.decode_sighting, SIGHTING_CASES), (decode.decode_device_log, LOG_CASES)]
)
def test_decode(spark, read, cases):
    messages = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(cases)], MESSAGE)
    decoded = read(messages)
    found = {r.seq: r.problem for r in decoded.collect()}
    assert {i: found[i] for i in found} == {i: problem for i, (_, problem) in enumerate(cases)}
    bad = {r.seq: (r.value, r.problem) for r in decode.quarantine_bad(decoded).collect()}
    assert bad == {i: case for i, case in enumerate(cases) if case[1]}


def test_decoded_values(spark):
    messages = spark.createDataFrame([(1, json.dumps(GOOD)), (2, changed(sensorID="518"))], MESSAGE)
    row = decode.project_sighting(decode.decode_sighting(messages)).where("seq = 1").collect()[0]
    assert row.asDict() == {
        "seq": 1, "sensor_id": "0419", "station_id": "harbour-east", "dev_id": "device-0b1c",
        "event_ts": dt.datetime(2021, 11, 7, 6, 5, 9), "event_date": D(2021, 11, 7),
    }
    logs = decode.project_device_log(decode.decode_device_log(messages)).orderBy("seq").collect()
    assert [(r.SensorId, r.Rssi) for r in logs] == [(419, -41), (518, -41)]


def test_parsing_happens_once_per_message(spark):
    """A filter on the verdict must not drag copies of the parse below it."""
    messages = spark.createDataFrame([(1, "{}")], MESSAGE)
    rows = decode.project_sighting(decode.decode_sighting(messages))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parse_json") + plan.count("parseJson") == 1


def test_times_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "Asia/Tokyo", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", name)
            text = F.lit("2018-03-11 02:30:00")  # a skipped hour in New York
            ts = times.parse_datetime(text)
            row = spark.range(1).select(
                times.format_datetime(ts).alias("same"),
                times.hour_of(ts).alias("hour"),
                times.event_date(ts).cast("string").alias("day"),
                times.hour_column(times.hour_of(ts)).alias("column"),
                times.format_datetime(times.shift_hours(ts, 22)).alias("later"),
                times.partition_name(times.event_date(ts)).alias("name"),
                times.short_partition_name(times.event_date(ts)).alias("short"),
                epoch_seconds(ts).alias("seconds"),
                from_epoch_seconds(epoch_seconds(ts)).cast("string").alias("back"),
            ).collect()[0]
            assert tuple(row) == (
                "2018-03-11 02:30:00", 2, "2018-03-11", "hour_02", "2018-03-12 00:30:00",
                "p2018_03_11", "p180311", 1520735400, "2018-03-11 02:30:00",
            )
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_calendar_arguments():
    assert times.month_before(dt.datetime(2018, 1, 1, 0, 30)) == (2017, 12)
    assert times.month_before(dt.datetime(2018, 1, 31, 22, 0), 3) == (2018, 1)
    assert times.month_range(2018, 12) == (D(2018, 12, 1), D(2019, 1, 1))
    assert grid_days(dt.datetime(2018, 1, 30, 22, 0), 3) == [D(2018, 1, 31), D(2018, 2, 1)]


def wide(spark, keys, rows):
    """Rows of (key..., date, {hour: count}); hours not named are 0."""
    data = [(*row[:-1], *[row[-1].get(h, 0) for h in range(24)]) for row in rows]
    return spark.createDataFrame(data, hourly_wide(keys))


def test_null_hours_in_both_rollups(spark):
    days = [D(2018, 1, d) for d in (3, 4)]
    stations = wide(spark, STATION_KEY, [
        ("a", days[0], {1: 10, 5: None}), ("a", days[1], {5: 7}),  # one cell skipped
        ("b", days[0], {1: 10, 5: None}), ("b", days[1], {5: None, 2: 1}),  # hour 5 all NULL
        ("c", days[0], {}),
    ])
    got = {r.station_id: (r.stat_date, r["count"]) for r in monthly.station_monthly(stations).collect()}
    assert got == {"a": (days[0], 17), "b": (days[0], 0), "c": (days[0], 0)}
    flows = wide(spark, FLOW_KEY, [
        ("a", "b", days[0], {1: 10, 5: None}), ("a", "b", days[1], {5: 7}),  # row skipped
        ("b", "a", days[0], {1: None}),
    ])
    got = {r.src_station_id: r["count"] for r in monthly.flows_monthly(flows).collect()}
    assert got == {"a": 7, "b": 0}


def month_rows(spark, rows):
    return spark.createDataFrame(rows, monthly_schema(STATION_KEY))


def test_upsert_modes(spark):
    old = month_rows(spark, [("a", D(2018, 1, 5), 1), ("gone", D(2018, 1, 2), 9)])
    new = month_rows(
        spark, [("a", D(2018, 1, 1), 3), ("new", D(2018, 1, 1), 4), ("a", D(2018, 2, 1), 5)]
    )
    known = {("a", D(2018, 1, 5), 3), ("gone", D(2018, 1, 2), 9), ("a", D(2018, 2, 1), 5)}

    def rows(frame):
        return {tuple(r) for r in frame.collect()}

    assert rows(monthly.upsert(old, new, STATION_KEY, "update_or_insert")) == known
    merged = monthly.upsert(old, new, STATION_KEY)
    assert rows(merged) == known | {("new", D(2018, 1, 1), 4)}
    assert rows(monthly.upsert(merged, new, STATION_KEY)) == rows(merged)
    assert monthly.exists_month(old, 2018, 1) and not monthly.exists_month(old, 2018, 2)
    with pytest.raises(ValueError):
        monthly.upsert(old, new, STATION_KEY, "other")


def test_adding_to_a_null_counter_keeps_null(spark):
    day = D(2018, 1, 3)
    table = wide(spark, STATION_KEY, [("a", day, {1: 1, 2: None}), ("b", day, {3: 3})])
    delta = wide(spark, STATION_KEY, [("a", day, {1: 4, 2: 4}), ("c", day, {5: 5})])
    got = {r.station_id: (r.hour_01, r.hour_02, r.hour_03, r.hour_05)
           for r in stats.add_hours(table, delta, STATION_KEY).collect()}
    assert got == {"a": (5, None, 0, 0), "b": (0, 0, 3, 0), "c": (0, 0, 0, 5)}


def test_wide_and_long_forms(spark):
    day = D(2018, 1, 3)
    rows = [("a", day, 0, 2), ("a", day, 23, 5), ("a", day, 23, 1), ("b", day, 7, 1)]
    counts = spark.createDataFrame(rows, "station_id string, stat_date date, hour int, count long")
    table = stats.widen(counts, STATION_KEY)
    assert table.schema == hourly_wide(STATION_KEY) or table.columns == ["station_id", "stat_date", *HOUR_COLUMNS]
    back = stats.lengthen(table, STATION_KEY).where("count > 0").collect()
    assert {tuple(r) for r in back} == {("a", day, 0, 2), ("a", day, 23, 6), ("b", day, 7, 1)}


def test_grids(spark):
    stations = spark.createDataFrame([(s,) for s in ["1", "2", "3", "4", "4"]], "station_id string")
    days = [D(2018, 1, 1), D(2018, 1, 2)]
    pairs = [tuple(r) for r in grid.flow_grid(stations, days).collect()]
    assert len(pairs) == len(set(pairs)) == 4 * 3 * 2
    assert all(src != dst for src, dst, _ in pairs)
    table = wide(spark, STATION_KEY, [("1", days[0], {4: 2}), ("unlisted", days[0], {5: 1}),
                                      ("2", days[0], {4: None})])
    dense = grid.densify_station(table, stations, days).collect()
    assert len(dense) == 4 * 2 + 1
    cells = {(r.station_id, r.stat_date): r.hour_04 for r in dense}
    assert cells["1", days[0]] == 2 and cells["3", days[1]] == 0 and cells["2", days[0]] is None
    plan = grid.flow_grid(stations, days)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_horizon_and_expiry(spark):
    today = D(2018, 1, 10)
    days = [today + dt.timedelta(days=n) for n in range(-5, 5)]
    rows = [(i, "1", "a", "x", dt.datetime(d.year, d.month, d.day), d) for i, d in enumerate(days)]
    sightings = spark.createDataFrame(rows, SIGHTING)

    def offsets(frame):
        return sorted((r.event_date - today).days for r in frame.collect())

    assert offsets(horizon.filter_horizon(sightings, today)) == [-2, -1, 0, 1]
    assert offsets(horizon.late_drop(sightings, today)) == [-5, -4, -3]
    assert offsets(horizon.future_drop(sightings, today)) == [2, 3, 4]
    kept = state.expire_state(sightings.withColumnRenamed("event_date", "start_date"), today)
    assert min(r.start_date for r in kept.collect()) == today - dt.timedelta(days=2)


def test_device_log_keeps_the_first_of_equal_keys(spark):
    t = dt.datetime(2021, 6, 8, 17, 2, 33)
    rows = [(3, 7, "m", -1, t), (1, 7, "m", -20, t), (2, 8, "m", None, t), (9, 8, "m", 5, t)]
    log = spark.createDataFrame(rows, "seq long, SensorId int, Mac string, Rssi byte, TimeNow timestamp_ntz")
    got = {(r.SensorId, r.Rssi) for r in devicelog.dedup_device_log(log).collect()}
    assert got == {(7, -20), (8, None)}
    stored = spark.createDataFrame([(7, "m", 0, t)], DEVICE_LOG)
    assert [r.SensorId for r in devicelog.new_log_rows(log, stored).collect()] == [8]


def test_device_log_is_decoded_once_and_merged_by_hash(spark):
    """Checks are not computed again by the filter on them; NULL strengths are kept, and nothing is sorted."""
    messages = spark.createDataFrame([(1, json.dumps(GOOD))], MESSAGE)
    project = decode.project_device_log(decode.decode_device_log(messages))
    plan = devicelog.dedup_device_log(project)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert filters and not any("variant_get" in line or "schemaOfVariant" in line for line in filters)
    schema = "seq long, SensorId int, Mac string, Rssi byte, TimeNow timestamp_ntz"
    rows = spark.createDataFrame([(2, 1, "m", 5, dt.datetime(2021, 6, 8, 17, 2, 33)), (1, 1, "m", None, dt.datetime(2021, 6, 8, 17, 2, 33))], schema)
    assert [r.Rssi for r in devicelog.dedup_device_log(rows).collect()] == [None]


def test_hot_device_days_are_found_exactly(spark):
    """Two million small device-days, and two hundred of just enough rows, many in one bucket of 64."""
    small = spark.range(2_000_000).select(F.concat(F.lit("s"), "id").alias("dev_id"))
    hot = spark.range(200 * 60).select(F.concat(F.lit("h"), (F.col("id") % 200).cast("string")).alias("dev_id"))
    less = spark.range(50 * 59).select(F.concat(F.lit("l"), (F.col("id") % 50).cast("string")).alias("dev_id"))
    rows = small.union(hot).union(less).withColumn("event_date", F.lit(D(2018, 1, 1)))
    found = {r.day_key: r["rows"] for r in skew.find_hot_device_days(rows, 60).collect()}
    want = hot.distinct().withColumn("event_date", F.lit(D(2018, 1, 1))).select(skew.device_day_hash())
    assert found == {r[0]: 60 for r in want.collect()}
    assert skew.find_hot_device_days(rows, 61).isEmpty()


def test_grid_of_many_stations_is_written_by_several_tasks(spark, tmp_path):
    stations = spark.range(400).select(F.concat(F.lit("st"), "id").alias("station_id"))
    day = D(2018, 1, 1)
    pairs = grid.flow_grid(stations, [day])
    assert pairs.count() == pairs.distinct().count() == 400 * 399
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "64k")  # at which these few rows are many
    grid.zero_rows(pairs).repartition(8).write.parquet(f"{tmp_path}/rows")  # eight tasks have rows
    sinks.append_rows(spark.read.parquet(f"{tmp_path}/rows"), f"{tmp_path}/flows", ["stat_date"])
    spark.conf.set(size, before)
    table = spark.read.schema(hourly_wide(FLOW_KEY)).parquet(f"{tmp_path}/flows")
    assert table.count() == 400 * 399
    assert len(list((tmp_path / "flows" / "stat_date=2018-01-01").glob("part-*"))) > 3


def test_hourly_counts_are_added_once(spark, tmp_path):
    def rows(key, day, n):
        data = [(key, day, *[n if h == 3 else 0 for h in range(24)])]
        return spark.createDataFrame(data, hourly_wide(STATION_KEY))

    path, one, two = f"{tmp_path}/hourly", D(2018, 1, 1), D(2018, 1, 2)
    sinks.add_hourly(rows("a", one, 5), path, STATION_KEY, 0)
    both = rows("a", one, 2).unionByName(rows("b", two, 4))
    # The first run was lost after the first day's partition.
    sinks.add_hourly(rows("a", one, 2), path, STATION_KEY, 1)
    for _ in range(2):
        sinks.add_hourly(both, path, STATION_KEY, 1)
    table = spark.read.schema(hourly_wide(STATION_KEY)).parquet(path)
    assert {(r.station_id, r.stat_date, r.hour_03) for r in table.collect()} == {("a", one, 7), ("b", two, 4)}


def rows_scanned(frame):
    """Rows that the only scan of a collected frame has handed on."""
    (leaf,) = [frame._jdf.queryExecution().executedPlan().collectLeaves().apply(0)]
    return leaf.metrics().apply("numOutputRows").value()


def test_state_look_up_reads_few_of_the_rows(spark, tmp_path):
    """Ten devices, one of them unknown, among six million rows of two days."""
    ids = F.sha2(F.col("id").cast("string"), 256).substr(1, 20)
    day = F.date_add(F.lit("2024-05-01").cast("date"), (F.col("id") % 2).cast("int"))
    state = spark.range(6_000_000).select(
        ids.alias("dev_id"), day.alias("start_date"), F.col("id").cast("string").alias("station_id"),
        F.lit("2024-05-01 10:00:00").cast("timestamp_ntz").alias("last_datetime"),
    )
    sinks.save_state(state, f"{tmp_path}/state")
    wanted = [hashlib.sha256(str(n).encode()).hexdigest()[:20] for n in [*range(0, 5_400_000, 600_000), -1]]
    found = tables.device_state(spark, f"{tmp_path}/state", dev_id=wanted)
    assert sorted(int(r.station_id) for r in found.collect()) == list(range(0, 5_400_000, 600_000))
    assert 0 < rows_scanned(found) < 0.05 * 6_000_000
    many = tables.device_state(spark, f"{tmp_path}/state", dev_id=[*wanted, *map(str, range(40))])
    assert many.count() == 9
    assert tables.device_state(spark, f"{tmp_path}/state", dev_id=[]).count() == 0
