"""The counting rules as a plain loop over one device-day: the brute-force check."""

import datetime as dt

DAY = dt.datetime(2024, 1, 5)


def at(text, day=DAY):
    """'10:00:01' or '10:00' on the given day."""
    parts = [int(p) for p in text.split(":")] + [0]
    return day + dt.timedelta(hours=parts[0], minutes=parts[1], seconds=parts[2])


def fold_visits(sightings, prior=None, gap=30):
    """(seq, station, dev, ts) rows to the set of (dev, ts, seq, station, before, kind)."""
    state = dict(prior or {})
    out = set()
    for seq, station, dev, ts in sorted(sightings, key=lambda s: (s[3], s[0])):
        key = (dev, ts.date())
        if key not in state:
            out.add((dev, ts, seq, station, None, "first"))
        else:
            last, before = state[key]
            if station != before:
                out.add((dev, ts, seq, station, before, "move"))
            elif ts > last + dt.timedelta(minutes=gap):
                out.add((dev, ts, seq, station, before, "revisit"))
            else:
                continue
        state[key] = (ts, station)
    return out, state


def as_sightings(spark, rows):
    from footfall.schemas import SIGHTING

    data = [(seq, "1", station, dev, ts, ts.date()) for seq, station, dev, ts in rows]
    return spark.createDataFrame(data, SIGHTING)


def as_set(visits):
    return {
        (r.dev_id, r.event_ts, r.seq, r.station_id, r.prev_station_id, r.kind)
        for r in visits.collect()
    }


def as_state(spark, state):
    from footfall.schemas import DEVICE_STATE

    rows = [(dev, day, last, station) for (dev, day), (last, station) in state.items()]
    return spark.createDataFrame(rows, DEVICE_STATE)


__all__ = ["DAY", "as_set", "as_sightings", "as_state", "at", "fold_visits"]
