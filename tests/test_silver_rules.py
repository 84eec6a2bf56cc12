"""Micro-fixtures for the dedup and parse rules."""

import datetime as dt

from pyspark.sql import functions as F

from helpers import T0, bronze_df, event, ts
from pacewise.operators.silver import fact_event
from pacewise.streaming.bronze import ENVELOPE_SCHEMA, parse


def test_dedup_keeps_earliest_ingest_and_drops_null_ids(spark):
    e1 = event("evt-1", "impression", T0)
    e_other = event("evt-2", "ad_request", T0)
    rows = [
        (*e1[:1], "impression", *e1[2:], T0, ts(1)),          # later ingest
        (*e1[:1], "q25", *e1[2:], T0, ts(0)),                 # earliest ingest, marked by type
        (None, "impression", *e1[2:], T0, ts(0)),
        (None, "impression", *e1[2:], T0, ts(2)),
        (*e_other, T0, ts(0)),
    ]
    out = {r["event_id"]: r["event_type"] for r in fact_event(bronze_df(spark, rows)).collect()}
    assert out == {"evt-1": "q25", "evt-2": "ad_request"}


def test_malformed_json_keeps_rows_with_nulls(spark):
    env = spark.createDataFrame([
        ("k", "{bad", dt.datetime(2024, 1, 1)),
        ("k", '{"event_id": "evt-9", "event_ts": "zz", "event_type": "q50"}', dt.datetime(2024, 1, 1)),
        ("k", '{"event_id": "evt-8", "event_ts": "2024-01-02T03:04:05.123456Z"}', dt.datetime(2024, 1, 1)),
    ], ENVELOPE_SCHEMA)
    rows = {r["event_id"]: r for r in parse(env).collect()}
    assert set(rows) == {None, "evt-9", "evt-8"}
    bad = rows[None]
    assert all(bad[c] is None for c in ("event_type", "event_ts", "user_id", "campaign_id"))
    assert bad["kafka_ts"] is not None and bad["ingest_ts"] is not None
    assert rows["evt-9"]["event_ts"] is None and rows["evt-9"]["event_type"] == "q50"
    assert rows["evt-8"]["event_ts"] == dt.datetime(2024, 1, 2, 3, 4, 5, 123456)
    # silver drops the NULL id but keeps the row whose only bad field is event_ts
    kept = fact_event(parse(env)).select("event_id").collect()
    assert sorted(r[0] for r in kept) == ["evt-8", "evt-9"]


def test_parse_schema_is_the_bronze_contract(spark):
    env = spark.createDataFrame([], ENVELOPE_SCHEMA)
    assert [f.name for f in parse(env).schema.fields] == [
        "event_id", "event_type", "event_ts", "campaign_id", "creative_id", "request_id", "user_id",
        "device", "geo", "placement", "kafka_ts", "ingest_ts"]
    assert parse(env).schema["event_ts"].dataType.simpleString() == "timestamp_ntz"
    assert F is not None
