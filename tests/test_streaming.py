import datetime as dt
import json
import os
import random
import shutil
import subprocess
import sys
import time
import uuid
from pathlib import Path

import pytest
from compare import TESTDATA
from fold import as_set, as_sightings, as_state, at, fold_visits
from pyspark.sql import functions as F
from test_visits import random_sightings

from footfall.operators.decode import decode_device_log, decode_sighting, project_device_log, project_sighting
from footfall.operators.horizon import batch_day
from footfall.operators.state import device_state
from footfall.operators.visits import count_visits
from footfall.plans import registry
from footfall.schemas import MESSAGE, SIGHTING, VISIT_FACT
from footfall.sources import folders
from footfall.sources.messages import message_file_stream
from footfall.streaming.devicelog import DeviceLog
from footfall.streaming.ingest import Ingest
from footfall.streaming.metrics import BatchCounts, observe_decoded
from footfall.operators.sinks import replace_whole
from footfall.operators.stats import flows_hourly, station_hourly, widen
from footfall.operators.visits import flows_from_visits
from footfall.schemas import FLOW_KEY, STATION_KEY
from footfall.streaming import visits as visit_stream
from footfall.streaming.visits import (
    count_visits_stream,
    hourly_stream,
    read_judged,
    stored_state,
    write_facts,
    write_judged,
)

ROOT = Path(__file__).resolve().parent.parent


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Each state partition starts a Python worker in every batch; two show all that eight do."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def land(spark, rows, path, part, make):
    make(spark, rows).coalesce(1).write.parquet(f"{path}/{part}")


def run_facts(spark, source, base):
    stream = spark.readStream.schema(SIGHTING).option("recursiveFileLookup", "true")
    stream = stream.option("maxFilesPerTrigger", 1).parquet(source)
    query = write_facts(
        count_visits_stream(stream), f"{base}/facts", f"{base}/ckpt", availableNow=True
    )
    query.awaitTermination()
    return spark.read.schema(VISIT_FACT).parquet(f"{base}/facts")


def test_stream_equals_fold_over_restarts(spark, tmp_path):
    """Batches in arrival order, with late rows, and a restart from the checkpoint between."""
    rows = random_sightings(21, ["x", "y", "z"], "AAAB", 1800, 86_400)
    state, want = {}, set()
    source = f"{tmp_path}/in"
    for part in range(3):
        chunk = rows[part * 600 : (part + 1) * 600]
        counted, state = fold_visits(chunk, state)
        want |= counted
        land(spark, chunk, source, part, as_sightings)
        facts = run_facts(spark, source, tmp_path)
        assert as_set(facts) == want


def test_stream_of_ordered_batches_equals_batch(spark, tmp_path):
    rows = random_sightings(22, ["x", "y"], "AAB", 1200, 86_400)
    rows.sort(key=lambda r: (r[3], r[0]))
    source = f"{tmp_path}/in"
    for part in range(4):
        land(spark, rows[part * 300 : (part + 1) * 300], source, part, as_sightings)
    facts = run_facts(spark, source, tmp_path)
    assert as_set(facts) == as_set(count_visits(as_sightings(spark, rows)))


def messages(spark, rows):
    data = []
    for seq, station, dev, ts in rows:
        body = {
            "sensorID": "7", "sensorType": "gate", "stationID": station, "deviceID": dev,
            "power": -60, "dsStatus": 1, "datetime": ts.strftime("%Y-%m-%d %H:%M:%S"),
        }
        data.append((seq, json.dumps(body)))
    return spark.createDataFrame(data, MESSAGE)


def test_ingest_batches_are_repeatable(spark, tmp_path):
    """Three micro-batches with a snapshot every two; the last one is run a second time."""
    rows = random_sightings(23, ["x", "x", "y"], "AAB", 900, 86_400)
    job = Ingest(str(tmp_path), close_every=2)
    state, want = {}, set()
    for batch in range(3):
        chunk = rows[batch * 300 : (batch + 1) * 300]
        counted, state = fold_visits(chunk, state)
        want |= counted
        job.run_batch(messages(spark, chunk), batch)
    job.run_batch(messages(spark, rows[600:]), 2)
    assert as_set(job.visits(spark)) == want
    stored = {(r.dev_id, r.start_date): (r.last_datetime, r.station_id)
              for r in job.state(spark, 3).collect()}
    assert stored == state
    total = job.hourly(spark, "station_hourly").selectExpr(
        "sum(" + "+".join(f"hour_{h:02d}" for h in range(24)) + ") as n"
    ).collect()[0].n
    assert total == len(want)


def test_ingest_stream_sets_bad_late_and_future_rows_aside(spark, tmp_path):
    today = at("12:00").date()
    days = [-3, -2, -1, 0, 1, 2]
    rows = [(i, "A", "x", at("10:00") + dt.timedelta(days=d)) for i, d in enumerate(days)]
    bad = spark.createDataFrame([(99, "{")], MESSAGE)
    messages(spark, rows).unionByName(bad).write.parquet(f"{tmp_path}/in")
    job = Ingest(f"{tmp_path}/out", today=lambda: today)
    query = job.start(
        message_file_stream(spark, f"{tmp_path}/in"), f"{tmp_path}/ckpt", availableNow=True
    )
    query.awaitTermination()
    assert {r.seq for r in job.visits(spark).collect()} == {1, 2, 3, 4}
    dropped = spark.read.parquet(job.table("dropped")).collect()
    assert {(r.seq, r.reason) for r in dropped} == {(0, "late"), (5, "future")}
    rejected = spark.read.parquet(job.table("rejected")).collect()
    assert [(r.seq, r.problem) for r in rejected] == [(99, "not_json")]


def test_state_after_batch(spark):
    rows = random_sightings(24, ["x", "y"], "AAB", 800, 86_400)
    first, second = rows[:400], rows[400:]
    _, state = fold_visits(first)
    prior = as_state(spark, state)
    _, want = fold_visits(second, state)
    visits = count_visits(as_sightings(spark, second), prior)
    got = {(r.dev_id, r.start_date): (r.last_datetime, r.station_id)
           for r in device_state(visits, prior).collect()}
    assert got == want


def test_state_is_cleared_once_its_day_is_over(spark, tmp_path):
    """Ten days later the first day's state is gone."""
    later = dt.timedelta(days=10)
    parts = [
        [(1, "A", "x", at("10:00")), (2, "A", "y", at("11:00"))],
        [(3, "A", "x", at("10:00") + later)],
        [(4, "B", "x", at("10:05") + later)],
        [(6, "A", "x", at("10:10") + later)],
    ]
    source, progress = f"{tmp_path}/in", []
    for part, rows in enumerate(parts):
        land(spark, rows, source, part, as_sightings)
        stream = spark.readStream.schema(SIGHTING).option("recursiveFileLookup", "true")
        query = write_facts(
            count_visits_stream(stream.parquet(source)),
            f"{tmp_path}/facts", f"{tmp_path}/ckpt", availableNow=True,
        )
        query.awaitTermination()
        progress.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    facts = spark.read.schema(VISIT_FACT).parquet(f"{tmp_path}/facts").collect()
    assert {(r.seq, r.kind) for r in facts} == {
        (1, "first"), (2, "first"), (3, "first"), (4, "move"), (6, "move"),
    }
    assert progress[-1] < max(progress)


def test_a_bad_clock_does_not_stop_the_stream(spark, tmp_path):
    """Rows from far ahead and long ago go to the side table; all others count, in every batch."""
    today = at("00:00").date()
    rows = [
        [(1, "A", "x", at("10:00")), (2, "A", "x", at("10:00") + dt.timedelta(days=2500))],
        [(3, "A", "y", at("10:00")), (4, "A", "x", at("10:00") - dt.timedelta(days=10))],
        [(5, "B", "y", at("10:00") - dt.timedelta(days=2)), (6, "B", "x", at("09:00") + dt.timedelta(days=1))],
    ]
    source = f"{tmp_path}/in"
    for part, some in enumerate(rows):
        land(spark, some, source, part, as_sightings)
        stream = spark.readStream.schema(SIGHTING).option("recursiveFileLookup", "true").parquet(source)
        counted = count_visits_stream(stream, today=F.lit(today))
        write_judged(counted, f"{tmp_path}/out", f"{tmp_path}/c", availableNow=True).awaitTermination()
    facts = read_judged(spark, f"{tmp_path}/out", True).collect()
    assert {r.seq for r in facts} == {1, 3, 5, 6}
    aside = read_judged(spark, f"{tmp_path}/out", False).collect()
    assert {(r.seq, r.reason, r.sensor_id) for r in aside} == {(2, "future", "1"), (4, "late", "1")}


def arriving(spark, rows, path, part, judged_on):
    as_sightings(spark, rows).withColumn("judged_on", F.lit(judged_on)).coalesce(1).write.parquet(f"{path}/{part}")


def test_every_sighting_is_in_one_table_when_batches_cross_midnight(spark, tmp_path):
    """Each batch is judged by its own day; the same old sighting is accepted before and set aside after."""
    today = at("00:00").date()
    old = [(dt.timedelta(days=-2), "x"), (dt.timedelta(days=-3), "y"), (dt.timedelta(days=2), "z"), (dt.timedelta(days=1), "w")]
    seq, source = 0, f"{tmp_path}/in"
    want = {}
    for part in range(4):
        day = today + dt.timedelta(days=part // 2)
        rows = []
        for shift, station in old:
            seq += 1
            moment = at("10:00") + shift
            rows.append((seq, f"{station}{seq}", f"d{seq}", moment))
            gap = (moment.date() - day).days
            want[seq] = "late" if gap < -2 else "future" if gap > 1 else "first"
        arriving(spark, rows, source, part, day)
        schema = SIGHTING.jsonValue()
        stream = spark.readStream.schema(type(SIGHTING).fromJson(schema).add("judged_on", "date"))
        stream = stream.option("recursiveFileLookup", "true").parquet(source)
        rows = count_visits_stream(stream, today=F.col("judged_on"))
        write_judged(rows, f"{tmp_path}/out", f"{tmp_path}/c", availableNow=True).awaitTermination()
    facts = [(r.seq, r.kind) for r in read_judged(spark, f"{tmp_path}/out", True).collect()]
    aside = [(r.seq, r.reason) for r in read_judged(spark, f"{tmp_path}/out", False).collect()]
    assert len(facts) + len(aside) == len(want) and dict(facts + aside) == want
    assert {kind for _, kind in facts} == {"first"} and {r for _, r in aside} == {"late", "future"}


def test_a_stream_goes_on_from_stored_state_and_shows_its_own(spark, tmp_path):
    """Mornings in batch, afternoons streamed over a restart; the state read from the checkpoint is the batch's."""
    rows = random_sightings(31, ["x", "y", "z"], "AAB", 900, 86_400)
    rows.sort(key=lambda r: (r[3], r[0]))
    half = len(rows) // 3
    counted, state = fold_visits(rows[:half])
    prior = device_state(count_visits(as_sightings(spark, rows[:half])))
    assert {(r.dev_id, r.start_date): (r.last_datetime, r.station_id) for r in prior.collect()} == state
    want, source = set(), f"{tmp_path}/in"
    for part in (1, 2):
        chunk = rows[part * half : (part + 1) * half] if part == 1 else rows[2 * half :]
        found, state = fold_visits(chunk, state)
        want |= found
        land(spark, chunk, source, part, as_sightings)
        stream = spark.readStream.schema(SIGHTING).option("recursiveFileLookup", "true").parquet(source)
        rows_out = count_visits_stream(stream, prior=prior)
        write_judged(rows_out, f"{tmp_path}/out", f"{tmp_path}/c", availableNow=True).awaitTermination()
        shown = {(r.dev_id, r.start_date): (r.last_datetime, r.station_id) for r in stored_state(spark, f"{tmp_path}/c").collect()}
        assert shown == state
    assert as_set(read_judged(spark, f"{tmp_path}/out", True)) == want


def test_devices_of_a_day_share_few_state_keys(spark, tmp_path, monkeypatch):
    """Keys are bounded by buckets and days, whatever the number of devices; state and visits are the fold's."""
    monkeypatch.setattr(visit_stream, "BUCKETS", 2)
    rows = [(i, "xyz"[i % 3], f"d{i % 40}", at("08:00") + dt.timedelta(minutes=7 * i, days=i % 2)) for i in range(120)]
    rows.sort(key=lambda r: (r[3], r[0]))
    counted, state = fold_visits(rows[:40])
    prior = device_state(count_visits(as_sightings(spark, rows[:40])))
    want, state = fold_visits(rows[40:], state)
    land(spark, rows[40:], f"{tmp_path}/in", 0, as_sightings)
    stream = spark.readStream.schema(SIGHTING).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    write_judged(count_visits_stream(stream, prior=prior), f"{tmp_path}/out", f"{tmp_path}/c", availableNow=True).awaitTermination()
    shown = {(r.dev_id, r.start_date): (r.last_datetime, r.station_id) for r in stored_state(spark, f"{tmp_path}/c").collect()}
    assert shown == state and as_set(read_judged(spark, f"{tmp_path}/out", True)) == want
    keys = spark.read.format("statestore").option("stateVarName", "last_counted").load(f"{tmp_path}/c").count()
    assert keys <= 2 * len({day for _, day in state}) < len(state)


def test_state_partitions_follow_the_cluster_and_stay(spark, tmp_path, monkeypatch):
    """A session that shuffles into many partitions gives the stream no more state tasks than cores."""
    shuffles = "spark.sql.shuffle.partitions"
    cores = spark.sparkContext.defaultParallelism
    rows = random_sightings(33, ["x", "y", "z"], "AAB", 300, 86_400)
    rows.sort(key=lambda r: (r[3], r[0]))
    source, found = f"{tmp_path}/in", []
    for part, number in enumerate((3 * cores, cores + 1)):
        spark.conf.set(shuffles, str(number))
        land(spark, rows[part * 150 : (part + 1) * 150], source, part, as_sightings)
        stream = spark.readStream.schema(SIGHTING).option("recursiveFileLookup", "true").parquet(source)
        query = write_facts(count_visits_stream(stream), f"{tmp_path}/facts", f"{tmp_path}/c", availableNow=True)
        query.awaitTermination()
        found.append(query.lastProgress["stateOperators"][0]["numShufflePartitions"])
        assert spark.conf.get(shuffles) == str(number)
        monkeypatch.setattr(visit_stream, "_state_partitions", lambda spark: 1, raising=False)
    assert found == [cores, cores]
    want, _ = fold_visits(rows)
    assert as_set(spark.read.schema(VISIT_FACT).parquet(f"{tmp_path}/facts")) == want


@pytest.mark.parametrize("pack_rows", [1 << 18, 100])
def test_few_rows_reach_the_counter(spark, tmp_path, monkeypatch, pack_rows):
    """A key's sightings of an hour come as one row per pack, whatever their number; the rules are the fold's."""
    monkeypatch.setattr(visit_stream, "BUCKETS", 2)
    monkeypatch.setattr(visit_stream, "PACK_ROWS", pack_rows, raising=False)
    came = tmp_path / "came"
    came.mkdir()

    class Watched(visit_stream.VisitCounter):
        def handleInputRows(self, key, rows, timerValues):
            rows = list(rows)
            (came / uuid.uuid4().hex).write_text(str(len(rows)))
            return super().handleInputRows(key, iter(rows), timerValues)

    monkeypatch.setattr(visit_stream, "VisitCounter", Watched)
    at_batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(at_batch)
    spark.conf.set(at_batch, min(pack_rows, int(before)))
    try:
        # Long sequence numbers, which no float can hold; strays in between that are set aside.
        rows = [(2**60 + i, "AAB"[i * 7 % 3], f"d{i % 40}", at("08:00") + dt.timedelta(seconds=17 * i)) for i in range(600)]
        strays = [(2**60 + 600 + i, "A", f"d{i}", at("08:00") + dt.timedelta(days=20 * (i % 2) - 10)) for i in range(50)]
        land(spark, rows + strays, f"{tmp_path}/in", 0, as_sightings)
        stream = spark.readStream.schema(SIGHTING).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
        counted = count_visits_stream(stream, today=F.lit(at("08:00").date()))
        write_judged(counted, f"{tmp_path}/out", f"{tmp_path}/c", availableNow=True).awaitTermination()
    finally:
        spark.conf.set(at_batch, before)
    want, state = fold_visits(rows)
    assert as_set(read_judged(spark, f"{tmp_path}/out", True)) == want
    aside = {(r.seq, r.reason, r.dev_id, r.event_ts) for r in read_judged(spark, f"{tmp_path}/out", False).collect()}
    assert aside == {(seq, "late" if ts < at("08:00") else "future", dev, ts) for seq, _, dev, ts in strays}
    shown = {(r.dev_id, r.start_date): (r.last_datetime, r.station_id) for r in stored_state(spark, f"{tmp_path}/c").collect()}
    assert shown == state
    hours = {ts.replace(minute=0, second=0) for _, _, _, ts in rows}
    keys_and_hours = 2 * (len(hours) + 2)
    packs = -(-650 // pack_rows)
    assert sum(int(file.read_text()) for file in came.iterdir()) <= keys_and_hours * packs


@pytest.mark.parametrize("keys", [STATION_KEY, FLOW_KEY])
def test_hours_behind_the_keyed_operator(spark, tmp_path, keys):
    """Once the watermark has passed them, the hours are those of the batch operators."""
    rows = random_sightings(32, ["x", "y", "z"], "AAB", 600, 86_400)
    rows.sort(key=lambda r: (r[3], r[0]))
    end = [(10_000, "E", "x", rows[-1][3] + dt.timedelta(days=9)), (10_001, "E", "x", rows[-1][3] + dt.timedelta(days=9, hours=2))]
    source = f"{tmp_path}/in"
    for part, chunk in enumerate((rows[:300], rows[300:], end[:1], end[1:])):
        land(spark, chunk, source, part, as_sightings)
        stream = spark.readStream.schema(SIGHTING).option("recursiveFileLookup", "true").parquet(source)
        hours = hourly_stream(count_visits_stream(stream), keys)
        write_facts(hours, f"{tmp_path}/hours", f"{tmp_path}/c", availableNow=True).awaitTermination()
    visits = count_visits(as_sightings(spark, rows))
    want = station_hourly(visits) if keys == STATION_KEY else flows_hourly(flows_from_visits(visits))
    got = spark.read.parquet(f"{tmp_path}/hours").select(want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_replayed_tables_of_many_files_take_several_batches(spark, tmp_path):
    events = spark.read.parquet(f"{TESTDATA}/sf0.001/events.parquet")
    events.repartition(8).write.parquet(f"{tmp_path}/events.parquet")
    queries = registry.queries()
    base = registry._counted_stream(spark, str(tmp_path))
    assert len(folders.children(spark, f"{base}/checkpoint/commits")) > 2
    want = queries["count_visits"](spark, f"{TESTDATA}/sf0.001")
    got = registry._shown(read_judged(spark, f"{base}/judged", True)).select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert {r.reason for r in read_judged(spark, f"{base}/judged", False).collect()} == {"late", "future"}


def test_a_day_in_several_batches_is_counted_in_order(spark, tmp_path, monkeypatch):
    """Events that lie in no order, a day of them in several files and micro-batches, count as in one."""
    monkeypatch.setattr(registry.samples, "REPLAY_FILES", 1)
    pick = random.Random(34)
    rows = [
        (n, at("00:00") + dt.timedelta(seconds=pick.randrange(2 * 86_400)), n % 4, pick.choice(["view", "click"]), 1.0, '{"k": 1}')
        for n in range(4000)
    ]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).repartition(8).write.parquet(f"{tmp_path}/events.parquet")
    small = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "6",
    }
    before = {name: spark.conf.get(name) for name in small}
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        base = registry._counted_stream(spark, str(tmp_path))
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    days = [day for day in folders.children(spark, f"{base}/in") if day.startswith("arrived=")]
    assert len(folders.children(spark, f"{base}/checkpoint/commits")) > len(days) + 1
    want, _ = fold_visits([(seq, station, str(dev), ts) for seq, ts, dev, station, _, _ in rows])
    assert as_set(read_judged(spark, f"{base}/judged", True)) == want


def test_batch_day_is_the_local_day(spark):
    row = spark.range(1).select(
        batch_day(0).alias("day"), batch_day(24).alias("next"), F.unix_timestamp(F.current_timestamp()).alias("now")
    ).first()
    assert row.day == dt.datetime.fromtimestamp(row.now, dt.timezone.utc).date()
    assert row.next == row.day + dt.timedelta(days=1)


@pytest.mark.parametrize("files", [3, 8])
def test_microbatches_do_not_depend_on_files(spark, tmp_path, files):
    events = spark.read.parquet(f"{TESTDATA}/sf0.001/events.parquet")
    events.repartition(files).write.parquet(f"{tmp_path}/events.parquet")
    names = [f.name for f in (tmp_path / "events.parquet").iterdir() if f.name.startswith("part")]
    assert len(names) == files
    queries = registry.queries()
    want = queries["count_visits_dense"](spark, f"{TESTDATA}/sf0.001")
    got = queries["st_microbatch"](spark, str(tmp_path)).select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def stored(spark, job):
    tables = {"visits": job.visits(spark), "state": job.state(spark, 9)}
    tables |= {n: job.hourly(spark, n) for n in ("station_hourly", "flows_hourly")}
    tables |= {n: spark.read.parquet(job.table(n)).drop("batch_id") for n in ("dropped", "rejected")}
    return {n: sorted(map(str, t.collect())) for n, t in tables.items()}


def test_a_batch_run_again_on_another_day_changes_nothing(spark, tmp_path):
    rows = random_sightings(25, ["x", "y"], "AB", 200, 5 * 86_400)
    days = iter([at("00:00").date(), at("00:00").date() + dt.timedelta(days=1)] * 9)
    once = Ingest(f"{tmp_path}/once", today=lambda: at("00:00").date())
    twice = Ingest(f"{tmp_path}/twice", today=lambda: next(days))
    once.run_batch(messages(spark, rows), 0)
    for _ in range(2):
        twice.run_batch(messages(spark, rows), 0)
    assert stored(spark, twice) == stored(spark, once)


def test_a_batch_replaces_all_it_wrote(spark, tmp_path):
    job = Ingest(str(tmp_path))
    job.run_batch(messages(spark, [(1, "A", "x", at("10:00"))]), 0)
    job.run_batch(messages(spark, []), 0)
    assert job.visits(spark).isEmpty() and job.state(spark, 1).isEmpty()


def test_closing_keeps_every_row_once(spark, tmp_path):
    rows = random_sightings(26, ["x", "y", "z"], "AB", 240, 86_400)
    plain, closing = Ingest(f"{tmp_path}/a", close_every=99), Ingest(f"{tmp_path}/b", close_every=2)
    for batch in range(6):
        for job in (plain, closing):
            job.run_batch(messages(spark, rows[batch * 40 : batch * 40 + 40]), batch)
            if job is closing and batch == 4:  # a loss after the closing, before the commit
                job.run_batch(messages(spark, rows[batch * 40 : batch * 40 + 40]), batch)
    for make in (lambda j: j.visits(spark), lambda j: j.state(spark, 6), lambda j: j.hourly(spark, "flows_hourly")):
        assert sorted(map(str, make(closing).collect())) == sorted(map(str, make(plain).collect()))
    assert folders.numbers(spark, closing.table("device_state") + "/open") == [4, 5]
    assert folders.numbers(spark, closing.table("device_state") + "/snapshot") == [3]
    assert folders.numbers(spark, closing.table("visits") + "/closed") == [1, 3]


def test_levels_bound_the_folders_and_keep_every_row_once(spark, tmp_path):
    """Closings of one batch each, merged in pairs; then a loss before the deletions of the highest merge."""
    visits = count_visits(as_sightings(spark, random_sightings(27, ["x", "y"], "AB", 120, 40_000))).cache()
    job = Ingest(str(tmp_path), merge_every=2)
    tables = {"visits": visits, "station_hourly": widen(station_hourly(visits), STATION_KEY)}
    for name, rows in tables.items():
        for n in range(7):
            part = visits.where(F.col("seq") % 7 == n)
            part = part if name == "visits" else widen(station_hourly(part), STATION_KEY)
            replace_whole(part, job._open(name, n), ["stat_date"])
            job._gather(spark, name, [job._open(name, n)], f"closed/through={n}")
            job._merge(spark, name)
        paths = job._paths(spark, name)
        assert [len(paths[k]) for k in ("level-2", "level-1", "closed", "open")] == [1, 1, 1, 0]

    def shown():
        return [
            sorted(map(str, rows.select(sorted(rows.columns)).collect()))
            for rows in (job.visits(spark), job.hourly(spark, "station_hourly"))
        ]

    want = [sorted(map(str, rows.select(sorted(rows.columns)).collect())) for rows in tables.values()]
    assert shown() == want
    again = f"{job.table('visits')}/closed/through=3"
    spark.read.parquet(job._paths(spark, "visits")["level-2"][0]).write.partitionBy("stat_date").parquet(again)
    assert shown() == want
    job._merge(spark, "visits")
    assert shown() == want and not folders.exists(spark, again)


def test_many_closings_are_read_from_few_folders(spark, tmp_path):
    """What 400 closings of 50 batches leave, folder by folder, without running them."""
    job = Ingest(str(tmp_path), merge_every=8)
    row = spark.createDataFrame([(1, "1", "A", "x", at("10:00"), at("10:00").date(), "late")], "seq long, sensor_id string, station_id string, dev_id string, event_ts timestamp_ntz, event_date date, reason string").coalesce(1)
    row.write.parquet(f"{tmp_path}/one")
    source = Path(tmp_path, "one")
    for n in range(400):
        target = Path(job.table("dropped"), "closed", f"through={n}")
        target.parent.mkdir(parents=True, exist_ok=True)
        shutil.copytree(source, target)
        if (n + 1) % 8 == 0:
            job._merge(spark, "dropped")
    paths = sum(job._paths(spark, "dropped").values(), [])
    assert len(paths) <= 8 * 3
    rows = job.dropped(spark)
    assert rows.count() == 400
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("Relation") <= 4


def test_state_is_filtered_before_it_is_grouped(spark, tmp_path):
    job = Ingest(str(tmp_path))
    job.run_batch(messages(spark, [(i, "A", f"d{i}", at("10:00") + dt.timedelta(days=i % 3)) for i in range(30)]), 0)
    touched = spark.createDataFrame([("d3", at("10:00").date())], "dev_id string, start_date date")
    rows = job.state(spark, 1, touched)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("LeftSemi")
    assert "start_date" in rows._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:60]


LOG_FIELDS = {"sensorType": "gate", "stationID": "A", "power": -3, "dsStatus": 1}


def log_messages(spark, rows):
    bodies = [
        (seq, json.dumps({**LOG_FIELDS, "sensorID": sensor, "deviceID": "m", "datetime": when}))
        for seq, sensor, when in rows
    ]
    return spark.createDataFrame(bodies, MESSAGE)


def test_batches_report_what_they_accept_and_set_aside(spark, tmp_path):
    """Messages to the judged table in three micro-batches; the listener's counts equal the rows."""
    today = dt.date(2024, 5, 10)
    plain = [(n, "x", f"d{n}", dt.datetime(2024, 5, 10, 9)) for n in range(12)]
    late = [(20 + n, "x", "d", dt.datetime(2024, 5, 1)) for n in range(3)]
    future = [(30 + n, "x", "d", dt.datetime(2031, 5, 1)) for n in range(2)]
    parts = [plain[:6] + late[:1], plain[6:] + late[1:], future]
    for part, rows in enumerate(parts):
        broken = spark.createDataFrame([(90 + part, "{"), (95 + part, "x")][: part + 1], MESSAGE)
        messages(spark, rows).unionByName(broken).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    counts = BatchCounts()
    spark.streams.addListener(counts)
    try:
        decoded = observe_decoded(decode_sighting(message_file_stream(spark, f"{tmp_path}/in", 1)))
        rows = count_visits_stream(project_sighting(decoded), today=F.lit(today))
        query = write_judged(rows, f"{tmp_path}/judged", f"{tmp_path}/ckpt", availableNow=True)
        query.awaitTermination()
        deadline = time.monotonic() + 30  # reports come after the fact
        while len(counts.of("sightings")) < 3 and time.monotonic() < deadline:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(counts)

    def total(name):
        batches = counts.of(name).values()
        return {k: sum(b[k] for b in batches) for k in next(iter(batches))}

    assert total("messages") == {"accepted": 17, "rejected": 5}
    assert total("sightings") == {"accepted": 12, "late": 3, "future": 2}
    aside = read_judged(spark, f"{tmp_path}/judged", False).groupBy("reason").count().collect()
    assert {r[0]: r[1] for r in aside} == {"late": 3, "future": 2}


def test_device_log_keeps_every_row_once(spark, tmp_path):
    job = DeviceLog(str(tmp_path))
    first = log_messages(spark, [(1, "7", "2024-05-01 10:00:00"), (2, "8", "2031-01-01 00:00:00"), (3, "x", "2024-05-01 10:00:00")])
    second = log_messages(spark, [(4, "7", "2024-05-01 10:00:00"), (5, "9", "2024-04-01 10:00:00"), (6, "9", "2024-04-01 10:00:00")])
    job.run_batch(first, 0)
    for _ in range(2):
        job.run_batch(second, 1)
    assert sorted((r.SensorId, r.TimeNow.year) for r in job.rows(spark).collect()) == [(7, 2024), (8, 2031), (9, 2024)]
    assert [(r.seq, r.problem) for r in job.rejected(spark).collect()] == [(3, "bad_sensor")]


def test_device_log_is_gathered_in_buckets_and_compared_without_a_shuffle(spark, tmp_path):
    """Random batches with repeats of all ages, closed and merged often, against a plain set of keys."""
    rng = random.Random(5)
    job = DeviceLog(str(tmp_path), buckets=4, close_every=2, merge_every=2)
    want, seq = set(), 0
    for batch in range(6):
        rows = []
        for _ in range(30):
            seq += 1
            key = (str(rng.randrange(4)), f"2024-05-0{rng.randrange(1, 4)} 10:00:{rng.randrange(20):02d}")
            want.add(key)
            rows.append((seq, *key))
        for _ in range(1 + (batch == 4)):  # a batch run again, also one that closes others
            job.run_batch(log_messages(spark, rows), batch)
        got = [(str(r.SensorId), str(r.TimeNow)) for r in job.rows(spark).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    assert [x.split('/')[-2:] for x in job._log.gathered(spark)] == [["level-1", "through=3"]]
    assert len(job._log.pending(spark)) == 2
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("footfall_log_")]

    again = project_device_log(decode_device_log(log_messages(spark, rows + [(seq + 1, "99", "2024-05-01 10:00:00")])))
    fresh = job.new_rows(again, 6, "footfall_log_plan")
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert [r.SensorId for r in fresh.collect()] == [99]
    spark.sql("DROP TABLE footfall_log_plan")
    # What the bucketed scan goes through up to the join: no exchange.
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
    depth, above = lines[scan].index("- "), []
    for line in reversed(lines[:scan]):
        if "- " in line and line.index("- ") < depth:
            depth = line.index("- ")
            above.append(line[depth + 2 :].split()[0])
    assert above[: above.index("SortMergeJoin")] == ["Filter", "Project", "Sort"], plan


def test_device_log_survives_a_loss_between_merging_and_deleting(spark, tmp_path, monkeypatch):
    job = DeviceLog(str(tmp_path), buckets=2, close_every=100, merge_every=2)
    for batch in range(2):
        job.run_batch(log_messages(spark, [(batch, str(batch), "2024-05-01 10:00:00")]), batch)
        with monkeypatch.context() as patch:
            patch.setattr(folders, "remove", lambda *_: None)
            job.close(spark, batch)
        assert sorted(r.SensorId for r in job.rows(spark).collect()) == list(range(batch + 1))
    job.run_batch(log_messages(spark, [(5, "1", "2024-05-01 10:00:00"), (6, "x", "")]), 2)
    job.close(spark, 2)
    assert sorted(r.SensorId for r in job.rows(spark).collect()) == [0, 1]
    assert job.rejected(spark).count() == 1
    assert len(folders.numbers(spark, f"{tmp_path}/log/open")) == 0


def test_package_reaches_workers_from_another_folder(tmp_path):
    """A session started elsewhere, with nothing on the workers' path, runs batch and stream."""
    script = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
import __spark_entry__ as entry
from footfall.session import local_session
spark = local_session("2", "elsewhere", "2g")
print("rows", entry.queries()["st_visits"](spark, "{TESTDATA}/sf0.001").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert "rows " in run.stdout, run.stderr[-2000:]
