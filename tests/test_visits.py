import datetime as dt
import random

import pytest
from fold import DAY, as_set, as_sightings, as_state, at, fold_visits

from footfall.operators.skew import find_hot_device_days
from footfall.operators.visits import (
    count_visits,
    flows_from_visits,
    ignored_sightings,
    same_station_sightings,
)

NEXT = DAY + dt.timedelta(days=1)
CASES = {
    "first": ([("A", at("10:00"))], [("A", "10:00:00")], []),
    "within gap": ([("A", at("10:00")), ("A", at("10:29:59"))], [("A", "10:00:00")], []),
    "exactly 30": ([("A", at("10:00")), ("A", at("10:30:00"))], [("A", "10:00:00")], []),
    "over 30": (
        [("A", at("10:00")), ("A", at("10:30:01"))],
        [("A", "10:00:00"), ("A", "10:30:01")],
        [],
    ),
    "anchor, not session": (
        [("A", DAY + dt.timedelta(hours=10, minutes=10 * i)) for i in range(13)],
        [("A", "10:00:00"), ("A", "10:40:00"), ("A", "11:20:00"), ("A", "12:00:00")],
        [],
    ),
    "move": (
        [("A", at("10:00:00")), ("B", at("10:00:01"))],
        [("A", "10:00:00"), ("B", "10:00:01")],
        [("A", "B")],
    ),
    "there and back": (
        [("A", at("10:00")), ("B", at("10:05")), ("A", at("10:10"))],
        [("A", "10:00:00"), ("B", "10:05:00"), ("A", "10:10:00")],
        [("A", "B"), ("B", "A")],
    ),
    "midnight, same station": (
        [("A", at("23:59")), ("A", at("00:01", NEXT))],
        [("A", "23:59:00"), ("A", "00:01:00")],
        [],
    ),
    "midnight, other station": (
        [("A", at("23:59")), ("B", at("00:01", NEXT))],
        [("A", "23:59:00"), ("B", "00:01:00")],
        [],
    ),
    "tie": (
        [("A", at("10:00")), ("B", at("10:00"))],
        [("A", "10:00:00"), ("B", "10:00:00")],
        [("A", "B")],
    ),
}


def random_sightings(seed, devices, stations, rows, span_seconds, days=2):
    rng = random.Random(seed)
    out = []
    for seq in range(rows):
        ts = DAY + dt.timedelta(
            days=rng.randrange(days), seconds=rng.randrange(span_seconds)
        )
        out.append((seq * 7, rng.choice(stations), rng.choice(devices), ts))
    return out


def test_rule_cases(spark):
    """All hand-made cases in one job, one device per case."""
    rows, seq = [], 0
    for name, (sightings, _, _) in CASES.items():
        for station, ts in sightings:
            rows.append((seq, station, name, ts))
            seq += 1
    visits = count_visits(as_sightings(spark, rows)).cache()
    seen = visits.collect()
    flows = flows_from_visits(visits).collect()
    for name, (_, want_visits, want_flows) in CASES.items():
        got = [
            (v.station_id, v.event_ts.strftime("%H:%M:%S"))
            for v in sorted(seen, key=lambda v: (v.event_ts, v.seq))
            if v.dev_id == name
        ]
        assert got == want_visits, name
        moved = sorted((f.event_ts, f.seq, f.src_station_id, f.dst_station_id)
                       for f in flows if f.dev_id == name)
        assert [m[2:] for m in moved] == want_flows, name
    assert all(v.hour == v.event_ts.hour and v.stat_date == v.event_ts.date() for v in seen)
    visits.unpersist()


@pytest.mark.parametrize(
    "seed,stations,span", [(1, "AB", 86_400), (2, "AAAAAAAB", 86_400), (3, "ABC", 40)]
)
def test_equals_fold(spark, seed, stations, span):
    rows = random_sightings(seed, ["x", "y", "z"], stations, 3000, span)
    want, _ = fold_visits(rows)
    assert as_set(count_visits(as_sightings(spark, rows))) == want


@pytest.mark.parametrize(
    "seed,stations,span,block",
    [(4, "AB", 86_400, 100), (5, "AAAAAAAAAAAB", 86_400, 5000), (6, "AAB", 30, 50), (7, "A", 9000, 9)],
)
def test_hot_device_days_equal_fold(spark, seed, stations, span, block):
    """Device x holds most rows; it is split by second and seq block, the others are not."""
    rows = random_sightings(seed, ["x"] * 8 + ["y", "z"], stations, 3000, span)
    sightings = as_sightings(spark, rows)
    hot = find_hot_device_days(sightings, 1000)
    assert hot.count() == 2
    want, _ = fold_visits(rows)
    assert as_set(count_visits(sightings, hot=hot, seq_block=block)) == want
    assert as_set(count_visits(sightings, hot_rows=1000, seq_block=block)) == want


@pytest.mark.parametrize("hot_rows", [10**9, 500])
def test_continues_from_stored_state(spark, hot_rows):
    """Two batches, the second with late rows, counted through the stored state."""
    rows = random_sightings(8, ["x", "x", "x", "y"], "AAAB", 4000, 86_400)
    first, second = rows[:2000], rows[2000:]
    want1, state = fold_visits(first)
    want2, _ = fold_visits(second, state)
    got = count_visits(
        as_sightings(spark, second), as_state(spark, state), hot_rows=hot_rows, seq_block=64
    )
    assert as_set(got) == want2


def test_gap_is_a_parameter(spark):
    rows = random_sightings(9, ["x"], "AAB", 2000, 20_000)
    want, _ = fold_visits(rows, gap=5)
    assert as_set(count_visits(as_sightings(spark, rows), gap_minutes=5)) == want


def test_every_sighting_is_counted_or_ignored(spark):
    rows = random_sightings(10, ["x", "y"], "AAB", 1500, 86_400)
    sightings = as_sightings(spark, rows)
    visits = count_visits(sightings)
    assert visits.count() + ignored_sightings(sightings, visits).count() == len(rows)
    moves = visits.where("kind <> 'revisit'").count()
    assert same_station_sightings(sightings, visits).count() == len(rows) - moves
