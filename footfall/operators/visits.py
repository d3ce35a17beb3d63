"""Counting visits and flows.

Rules, per device and event date, in the order (event_ts, seq):

* first      no sighting before: a visit.
* move       another station than the sighting before: a visit and a flow, at any time distance.
* revisit    same station, strictly more than 30 minutes after the last *counted* sighting.
* otherwise  ignored, and the last counted time stays where it is.

After each sighting the device's station is that sighting's station, so the station before is
``lag(station_id)`` and only the 30-minute anchor needs a fold. The fold runs inside one *run*
(a stretch of sightings at one station, starting at ``run_ts``) over those few sightings that lie
more than the gap after the run's start; a run takes at most one sighting per second into it.

A device-day is one sort group. Device-days found to be hot are not given to one task: they are
cut into (second, block of seq) pieces, whose first and last stations are then linked second by
second (``_hot_starts``). Both ways give the same rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.times import hour_of
from footfall.operators.skew import HOT_ROWS, device_day_hash, find_hot_device_days
from footfall.operators.staging import staged
from footfall.schemas import DEVICE_DAY, GAP_MINUTES

# Width, in seq numbers, of one piece of a hot second. seq is unique, so a piece has at most
# this many rows.
SEQ_BLOCK = 1_000_000

_START = ["event_ts", "seq", "station_id", "prev_station_id"]
# Key of a device-day. The hash comes first: sorting compares 8-byte numbers before anything
# else, while device ids such as MAC addresses mostly share their first characters.
_DAY = ["day_key", *DEVICE_DAY]


def _gap(minutes: int) -> Column:
    return F.make_dt_interval(mins=F.lit(minutes))


def _prior_rows(prior_state: DataFrame) -> DataFrame:
    """Stored device state as the sighting that was last counted; it is not live."""
    return prior_state.select(
        F.lit(None).cast("long").alias("seq"),
        "station_id",
        "dev_id",
        F.col("last_datetime").alias("event_ts"),
        F.col("start_date").alias("event_date"),
        F.lit(False).alias("live"),
    ).withColumn("day_key", device_day_hash())


def _moved() -> Column:
    before = F.col("prev_station_id")
    return before.isNull() | (before != F.col("station_id"))


def _past_gap(minutes: int) -> Column:
    """Later than the run's start by strictly more than the gap."""
    return F.col("event_ts") > F.col("run_ts") + _gap(minutes)


def _counted(candidates: Column, run_ts: Column, minutes: int) -> Column:
    """Fold time-ordered candidates of one run: keep each that passes the last kept one."""

    def step(state: Column, row: Column) -> Column:
        taken = F.struct(
            row["event_ts"].alias("last"),
            F.concat(state["hits"], F.array(row)).alias("hits"),
        )
        return F.when(row["event_ts"] > state["last"] + _gap(minutes), taken).otherwise(state)

    none_yet = F.array().cast("array<struct<event_ts:timestamp_ntz,seq:bigint>>")
    start = F.struct(run_ts.alias("last"), none_yet.alias("hits"))
    return F.aggregate(candidates, start, step, lambda state: state["hits"])


def _revisit_rows(minutes: int) -> Column:
    """Counted candidates of a run as start rows; the station before is the same station."""
    hits = _counted(F.col("later"), F.col("run_ts"), minutes)
    return F.transform(
        hits,
        lambda hit: F.struct(
            hit["event_ts"].alias("event_ts"),
            hit["seq"].alias("seq"),
            F.col("run_station").alias("station_id"),
            F.col("run_station").alias("prev_station_id"),
        ),
    )


def _facts(rows: DataFrame) -> DataFrame:
    kind = (
        F.when(F.col("prev_station_id").isNull(), "first")
        .when(F.col("prev_station_id") != F.col("station_id"), "move")
        .otherwise("revisit")
    )
    return rows.select(
        "dev_id",
        "station_id",
        "prev_station_id",
        "event_ts",
        "seq",
        F.col("event_date").alias("stat_date"),
        hour_of(F.col("event_ts")).alias("hour"),
        kind.alias("kind"),
    )


def _single_task_visits(rows: DataFrame, minutes: int) -> DataFrame:
    """Device-days of ordinary size: one shuffle and one sort.

    The windows share one order. Grouping by run extends the device-day key, so it needs no
    shuffle, and finds its rows already in order. A run is known by its device-day and start time:
    of several runs that start in one second only the last goes on and has candidates.
    """
    live = "live" in rows.columns
    order = Window.partitionBy(*_DAY).orderBy(*["live"][:live], "event_ts", "seq")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = (
        rows.withColumns(
            {
                "prev_station_id": F.lag("station_id").over(order),
                "prev_ts": F.lag("event_ts").over(order),
            }
        )
        .withColumn("moved", _moved())
        .withColumn("start_ts", F.when(F.col("moved"), F.col("event_ts")))
        .withColumn("run_ts", F.last("start_ts", ignorenulls=True).over(so_far))
    )
    start = F.col("moved") & F.col("live") if live else F.col("moved")
    # At one second a run needs only its first sighting: the rest cannot pass the gap.
    candidate = ~F.col("moved") & _past_gap(minutes) & (F.col("prev_ts") != F.col("event_ts"))
    runs = (
        marked.where(start | candidate)
        .groupBy(*_DAY, "run_ts")
        .agg(
            F.collect_list(F.when(F.col("moved"), F.struct(*_START))).alias("starts"),
            F.sort_array(
                F.collect_list(F.when(~F.col("moved"), F.struct("event_ts", "seq")))
            ).alias("later"),
            F.max(F.when(~F.col("moved"), F.col("station_id"))).alias("run_station"),
        )
    )
    counted = F.concat("starts", _revisit_rows(minutes))
    return _facts(runs.select(*DEVICE_DAY, F.inline(counted)))


def _whole(window):
    return window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def _hot_starts(rows: DataFrame, prior: DataFrame | None, block: int) -> tuple:
    """Run starts, and per-second revisit candidates, of hot device-days.

    Level 1 works inside a piece (device-day, second, block of seq), level 2 links the pieces of
    a second, level 3 links the at most 86,400 seconds of a day. Only level 1 sees single
    sightings; level 2 sees the first of each piece and level 3 the first of each second, with
    the last station of theirs (``tail``) and whether stations changed in between (``mixed``).
    """
    columns = [*DEVICE_DAY, *_START]
    second = [*_DAY, "event_ts"]
    before = F.col("prev_station_id")

    in_piece = Window.partitionBy(*second, "block").orderBy("seq")
    pieces = rows.withColumn("block", F.floor(F.col("seq") / F.lit(block))).withColumns(
        {
            "prev_station_id": F.lag("station_id").over(in_piece),
            "tail": F.last("station_id").over(_whole(in_piece)),
            "mixed": F.min("station_id").over(_whole(in_piece))
            != F.max("station_id").over(_whole(in_piece)),
        }
    )
    inner = pieces.where(before.isNotNull() & _moved())

    in_second = Window.partitionBy(*second).orderBy("block")
    heads = (
        pieces.where(before.isNull())
        .withColumn("prev_station_id", F.lag("tail").over(in_second))
        .withColumn("change", F.col("mixed") | F.coalesce(before != F.col("station_id"), F.lit(False)))
        .withColumns(
            {
                "tail": F.last("tail").over(_whole(in_second)),
                "mixed": F.max("change").over(_whole(in_second)),
            }
        )
    )
    between = heads.where(before.isNotNull() & _moved())

    seconds = heads.where(before.isNull()).select(*second, "seq", "station_id", "tail", "mixed")
    seconds = seconds.withColumn("live", F.lit(True))
    if prior is not None:
        seconds = seconds.unionByName(
            prior.withColumns({"tail": F.col("station_id"), "mixed": F.lit(False)})
        )
    in_day = Window.partitionBy(*_DAY).orderBy("live", "event_ts")
    earlier = in_day.rowsBetween(Window.unboundedPreceding, -1)
    by_second = (
        seconds.withColumn("prev_station_id", F.lag("tail").over(in_day))
        .withColumn("moved", _moved())
        .withColumn("start_ts", F.when(F.col("moved") | F.col("mixed"), F.col("event_ts")))
        .withColumn("run_ts", F.last("start_ts", ignorenulls=True).over(earlier))
    )
    firsts = by_second.where(F.col("moved") & F.col("live"))
    starts = reduce(
        DataFrame.unionByName, [part.select(*columns) for part in (inner, between, firsts)]
    )
    return starts, by_second.where(~F.col("moved"))


def _split_task_visits(
    rows: DataFrame, prior: DataFrame | None, minutes: int, block: int
) -> DataFrame:
    """Hot device-days: exact counting without ever sorting one of them in one task."""
    starts, others = _hot_starts(rows, prior, block)
    runs = (
        others.where(_past_gap(minutes))
        .groupBy(*_DAY, "run_ts")
        .agg(
            F.sort_array(F.collect_list(F.struct("event_ts", "seq"))).alias("later"),
            F.max("station_id").alias("run_station"),
        )
    )
    revisits = runs.select(*DEVICE_DAY, F.inline(_revisit_rows(minutes)))
    return _facts(starts.unionByName(revisits.select(*starts.columns)))


def _with_prior(rows: DataFrame, prior: DataFrame | None) -> DataFrame:
    return rows if prior is None else rows.withColumn("live", F.lit(True)).unionByName(prior)


def count_visits(
    sightings: DataFrame,
    prior_state: DataFrame | None = None,
    gap_minutes: int = GAP_MINUTES,
    hot: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    seq_block: int = SEQ_BLOCK,
) -> DataFrame:
    """Visit facts of a batch of sightings; moves carry the station they came from.

    ``prior_state`` continues device-days counted before. ``hot`` has the hashes (``day_key``) of
    device-days to be split over many tasks; left out, they are found from the data. Sightings
    should be a stored table (not raw JSON), as they are read once more to look for hot device-days.
    """
    rows = sightings.select("seq", "station_id", *DEVICE_DAY, "event_ts")
    prior = None if prior_state is None else _prior_rows(prior_state)
    if hot is None:
        hot = find_hot_device_days(rows, hot_rows)
    rows = rows.withColumn("day_key", device_day_hash())
    if hot.isEmpty():
        return _single_task_visits(_with_prior(rows, prior), gap_minutes)

    # Written first, so that its size on disk decides between broadcast and shuffle.
    hot = staged(hot.select("day_key"), "hot")
    ordinary = _with_prior(rows, prior).join(hot, "day_key", "left_anti")
    hot_rows_only = rows.join(hot, "day_key", "left_semi")
    hot_prior = None if prior is None else prior.join(hot, "day_key", "left_semi")
    return _single_task_visits(ordinary, gap_minutes).unionByName(
        _split_task_visits(hot_rows_only, hot_prior, gap_minutes, seq_block)
    )


def visits_of_kind(visits: DataFrame, kind: str) -> DataFrame:
    """Facts made by one rule: first, move or revisit."""
    return visits.where(F.col("kind") == kind)


def ignored_sightings(sightings: DataFrame, visits: DataFrame) -> DataFrame:
    """Sightings that no rule counted (seq is unique, so the anti join spreads evenly)."""
    return sightings.join(visits.select("seq"), "seq", "left_anti")


def flows_from_visits(visits: DataFrame) -> DataFrame:
    """Flow facts: each move, from the station before to the new one."""
    return visits_of_kind(visits, "move").select(
        "dev_id",
        F.col("prev_station_id").alias("src_station_id"),
        F.col("station_id").alias("dst_station_id"),
        "event_ts",
        "seq",
        "stat_date",
        "hour",
    )


def same_station_sightings(sightings: DataFrame, visits: DataFrame) -> DataFrame:
    """Sightings at the station of the sighting before: all that neither begin a day nor move."""
    starts = visits.where(F.col("kind").isin("first", "move"))
    return sightings.join(starts.select("seq"), "seq", "left_anti")


def past_gap_sightings(sightings: DataFrame, visits: DataFrame) -> DataFrame:
    """Re-sightings more than the gap after the last counted one."""
    revisits = visits_of_kind(visits, "revisit").select("seq")
    return sightings.join(revisits, "seq", "left_semi")
