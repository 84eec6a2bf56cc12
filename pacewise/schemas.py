"""Declared table contracts (no inference, no evolution) and the drift check.

All timestamps are UTC wall-clock ``timestamp_ntz``: the producer emits UTC ISO-8601 strings and
the given test tables carry ``timestamp_ntz``, so day and hour boundaries never depend on a
session time zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

S, TS, D = StringType(), TimestampNTZType(), DateType()


def _struct(*fields: tuple[str, DataType]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


EVENT_FIELDS = (
    ("event_id", S), ("event_type", S), ("event_ts", TS), ("campaign_id", S),
    ("creative_id", S), ("request_id", S), ("user_id", S), ("device", S), ("geo", S),
    ("placement", S),
)
EVENT_COLUMNS = [n for n, _ in EVENT_FIELDS]

# On-disk contract of bronze: the 10 fields plus provenance.
BRONZE_SCHEMA = _struct(*EVENT_FIELDS, ("kafka_ts", TS), ("ingest_ts", TS))
SILVER_SCHEMA = _struct(*EVENT_FIELDS)
DIM_CAMPAIGN_SCHEMA = _struct(
    ("campaign_id", S), ("budget", LongType()), ("flight_start", D), ("flight_end", D),
    ("daily_budget", DoubleType()), ("target_geo", S), ("target_device", S),
)
# Snapshot as landed from the campaign service: dates as ISO strings.
CAMPAIGN_SNAPSHOT_SCHEMA = _struct(
    ("campaign_id", S), ("budget", LongType()), ("flight_start", S), ("flight_end", S),
    ("daily_budget", DoubleType()), ("target_geo", S), ("target_device", S),
)
DELIVERY_SCHEMA = _struct(
    ("request_id", S), ("impression_ts", TS), ("campaign_id", S), ("creative_id", S),
    ("user_id", S), ("device", S), ("geo", S), ("placement", S),
    ("completed_q25", BooleanType()), ("completed_q50", BooleanType()),
    ("completed_q75", BooleanType()), ("completed_q100", BooleanType()),
)
FILL_SCHEMA = _struct(
    ("campaign_id", S), ("placement", S), ("event_hour", TS), ("requests", LongType()),
    ("impressions", LongType()), ("fill_rate", DoubleType()),
)
PACING_SCHEMA = _struct(
    ("campaign_id", S), ("pacing_date", D), ("delivered_impressions", LongType()),
    ("cumulative_delivered", LongType()), ("budget", LongType()),
    ("expected_pace", DoubleType()), ("pace_index", DoubleType()), ("pace_label", S),
)
ERASURE_LOG_SCHEMA = _struct(("user_id", S), ("tables", S), ("erased_at", TS))
TOMBSTONE_SCHEMA = _struct(("user_id", S), ("requested_at", TS))

# Physical layout columns (derived, not part of the logical contracts above).
LAYOUT_COLUMNS = {
    "bronze": _struct(("stream_tag", S), ("batch_id", LongType()), ("ingest_date", D)),
    "silver": _struct(("event_date", D), ("user_bucket", IntegerType())),
    "silver_by_day": _struct(("event_date", D)),
    "delivery": _struct(("impression_date", D)),
    "fill": _struct(("event_date", D)),
    "pacing": _struct(),  # identity partition on campaign_id, already a column
}


class SchemaDriftError(ValueError):
    """A DataFrame does not carry the declared contract."""


def check_schema(df: DataFrame, expected: StructType, what: str = "table") -> DataFrame:
    """Fail hard when names or types drift from the contract; nullability is not compared."""
    got = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    want = [(f.name, f.dataType.simpleString()) for f in expected.fields]
    if got != want:
        raise SchemaDriftError(f"{what}: schema drift\n  expected {want}\n  got      {got}")
    return df


def conform(df: DataFrame, expected: StructType) -> DataFrame:
    """Select and cast to the contract's column order and types."""
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in expected.fields])
