"""JSON messages to typed records; bad messages are set aside with a reason.

A message is accepted when it is one JSON object whose text fields are JSON strings and whose
whole-number fields are JSON numbers in int range, or strings of such a number. A typed
``from_json`` would quietly turn the number 28 into the text "28", so every field is read as a
variant, in the same single parse, and its JSON type is checked before it is taken. Of a repeated
member the last one counts.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.times import event_date, parse_datetime, to_int
from footfall.schemas import MESSAGE_INTS, MESSAGE_STRINGS

_NUMBER_TYPES = r"^(BIGINT|DECIMAL|DOUBLE)"
# The grammar of a JSON number.
_NUMBER = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?$"
_FIELDS = [*MESSAGE_STRINGS, "stationName", *MESSAGE_INTS]
_SCHEMA = ", ".join([f"{f} variant" for f in _FIELDS] + ["_corrupt string"])
_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}


def _type(field: str) -> Column:
    return F.schema_of_variant(F.col("_body")[field])


def _text(field: str) -> Column:
    return F.when(_type(field) == "STRING", F.variant_get(F.col("_body")[field], "$", "string"))


def _whole_number(field: str) -> Column:
    # Numbers are taken as double first, so that 1.5 is told apart from 1.
    number = F.try_variant_get(F.col("_body")[field], "$", "double")
    whole = number.try_cast("int")
    is_number = _type(field).rlike(_NUMBER_TYPES) | _text(field).rlike(_NUMBER)
    return F.when(is_number & (whole.cast("double") == number), whole)


def _decode(messages: DataFrame, extra: dict[str, Column], problems: list) -> DataFrame:
    """Add the message fields and ``problem``, which is NULL for an accepted message.

    The text is parsed once, and every field is taken once. The parsed object and, in the end,
    ``problem`` leave a generator (of one row per message) because a filter on ``problem`` would
    otherwise be moved below them, with a copy of the parse or of the checks in all it reads. Only a
    message that is no object is looked at again, to tell broken text from other JSON.
    """
    fields = {f: _text(f) for f in MESSAGE_STRINGS}
    fields |= {f: _whole_number(f) for f in MESSAGE_INTS}
    once = F.struct(F.from_json("value", _SCHEMA, _OPTIONS).alias("_body"))
    parsed = messages.select(*messages.columns, F.inline(F.array(once))).withColumns(fields | extra)
    parsed = parsed.withColumn("event_ts", parse_datetime(F.col("datetime")))
    complete = reduce(and_, [F.col(f).isNotNull() for f in fields])
    ended = F.coalesce(F.col("value").rlike(r"\}\s*$"), F.lit(False))
    no_object = F.col("_body").isNull() | F.col("_body._corrupt").isNotNull() | ~ended
    broken = no_object & (F.col("value").rlike(r"^\s*\{") | F.try_parse_json("value").isNull())
    problem = F.when(broken, "not_json").when(no_object | ~complete, "bad_field")
    for condition, reason in problems:
        problem = problem.when(condition, reason)
    problem = problem.when(F.col("event_ts").isNull(), "bad_datetime")
    judged = parsed.withColumn("problem", problem).drop("_body")
    kept = [c for c in judged.columns if c != "problem"]
    return judged.select(*kept, F.inline(F.array(F.struct("problem"))))


def decode_sighting(messages: DataFrame) -> DataFrame:
    """Sighting messages with their seven fields, ``event_ts`` and ``problem``."""
    return _decode(messages, {}, [])


def decode_device_log(messages: DataFrame) -> DataFrame:
    """Device-log messages: as sightings, with an optional station name and a numeric sensor."""
    extra = {
        "_name_type": F.coalesce(_type("stationName"), F.lit("VOID")),
        "stationName": _text("stationName"),
    }
    problems = [
        (~F.col("_name_type").isin("VOID", "STRING"), "bad_field"),
        (to_int(F.col("sensorID")).isNull(), "bad_sensor"),
        (F.col("power").try_cast("tinyint").isNull(), "bad_power"),
    ]
    return _decode(messages, extra, problems).drop("_name_type")


def accepted(decoded: DataFrame) -> DataFrame:
    """Messages that passed every check."""
    return decoded.where(F.col("problem").isNull()).drop("problem")


def quarantine_bad(decoded: DataFrame) -> DataFrame:
    """The complement: text and reason of each rejected message."""
    return decoded.where(F.col("problem").isNotNull()).select("seq", "value", "problem")


def project_sighting(decoded: DataFrame) -> DataFrame:
    """Keep the four fields the counting needs, typed, plus ``seq`` and the event date."""
    return accepted(decoded).select(
        "seq",
        F.col("sensorID").alias("sensor_id"),
        F.col("stationID").alias("station_id"),
        F.col("deviceID").alias("dev_id"),
        "event_ts",
        event_date(F.col("event_ts")).alias("event_date"),
    )


def project_device_log(decoded: DataFrame) -> DataFrame:
    """Rows of the device-log table, with ``seq`` for picking the first of equal keys."""
    return accepted(decoded).select(
        "seq",
        to_int(F.col("sensorID")).alias("SensorId"),
        F.col("deviceID").alias("Mac"),
        F.col("power").cast("tinyint").alias("Rssi"),
        F.col("event_ts").alias("TimeNow"),
    )
