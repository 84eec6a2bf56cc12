"""Silver merged batch by batch, and the ingest command."""

import datetime as dt
import json
import threading
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from helpers import bronze_df, event
from pacewise.operators.layout import file_stats
from pacewise.operators.silver import fact_event, merge_events
from pacewise.session import fresh_dir
from pacewise.sources import given
from pacewise.sources.tables import Lake, silver_table
from pacewise.streaming import bronze, ingest


def _row(event_id, at, ingest, user="usr-00001"):
    return (*event(event_id, "ad_request", at, user_id=user), at, ingest)


def test_merging_touches_only_the_days_of_the_batch(spark):
    table = silver_table(fresh_dir(spark, "t-merge") + "/fact_event")
    d = lambda day, h=1: dt.datetime(2024, 1, day, h)
    assert merge_events(spark, table, bronze_df(spark, [_row("a", d(1), d(1)), _row("b", d(2), d(2)), _row(None, d(2), d(2))])) == 2
    files = {r["file_path"] for r in file_stats(spark, table).collect()}
    second = bronze_df(spark, [_row("a", d(1), d(3)),                        # delivered again
                               _row("late", d(1, 5), d(3)),                  # late, for a day already there
                               _row("c", d(3), d(3)), _row("c", d(3), d(4)),  # twice in one batch
                               _row("no-ts", None, d(3)), _row("no-user", d(3), d(3), None)])
    assert merge_events(spark, table, second) == 4
    assert merge_events(spark, table, second) == 0                           # a replayed batch
    assert sorted(r["event_id"] for r in table.read(spark).collect()) == ["a", "b", "c", "late", "no-ts", "no-user"]
    assert files < {r["file_path"] for r in file_stats(spark, table).collect()}   # no file was rewritten
    assert merge_events(spark, table, bronze_df(spark, [])) == 0


def test_batches_in_any_order_equal_a_full_rebuild(spark):
    table = silver_table(fresh_dir(spark, "t-merge-all") + "/fact_event")
    rows = given.bronze(spark, SF001).withColumn("part", F.pmod(F.xxhash64("request_id", "ingest_ts"), F.lit(4)))
    for part in (2, 0, 3, 1):
        merge_events(spark, table, rows.where(F.col("part") == part).drop("part"))
    got, want = table.read(spark), fact_event(given.bronze(spark, SF001))
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def _waited(check, seconds=90):
    until = time.monotonic() + seconds
    while not check():
        assert time.monotonic() < until, "waited too long"
        time.sleep(0.3)


def test_the_ingest_command_starts_stops_and_resumes(spark):
    lake = Lake(spark, fresh_dir(spark, "t-ingest"))
    landing = lake.folder("landing")
    parts = given.bronze(spark, SF001).withColumn("part", F.pmod(F.hash("request_id"), F.lit(3)))
    land = lambda p: bronze.land_envelopes(parts.where(F.col("part") == p).drop("part"), f"{landing}/p{p}", files=1)
    land(0)
    lines, result = [], {}

    def run():
        raw = bronze.file_source(spark, f"{landing}/*")
        result.update(ingest.ingest(spark, lake, raw, processing_time="1 second", silver=True, poll=0.3, log=lines.append))

    def started():
        thread = threading.Thread(target=run)
        thread.start()
        return thread

    thread = started()
    _waited(lambda: any('"batch"' in x for x in lines))
    land(1)
    _waited(lambda: sum('"event": "batch"' in x for x in lines) == 2)
    ingest.request_stop(spark, lake, "ingest")
    thread.join(90)
    assert not thread.is_alive() and result["batches"] == 2
    two = parts.where("part < 2").count()
    assert result["rows"] == two == lake.read("bronze").count()
    land(2)
    thread = started()                       # the old marker doesn't stop it
    _waited(lambda: sum('"event": "batch"' in x for x in lines) == 3)
    ingest.request_stop(spark, lake, "ingest")
    thread.join(90)
    assert lake.read("bronze").count() == parts.count() and result["rows"] == parts.count() - two
    want = fact_event(given.bronze(spark, SF001))
    assert lake.read("silver").count() == want.count()
    events = [json.loads(x) for x in lines]
    assert [e["event"] for e in events] == ["started", "batch", "batch", "ended", "started", "batch", "ended"]
    assert all(e["error"] is None for e in events if e["event"] == "ended")


def test_a_failed_batch_is_replayed_as_a_whole(spark, monkeypatch):
    lake = Lake(spark, fresh_dir(spark, "t-replay"))
    landing = lake.folder("landing")
    bronze.land_envelopes(given.bronze(spark, SF001), landing, files=2)
    real, calls = ingest.merge_events, []

    def failing(*args):
        calls.append(1)
        added = real(*args)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return added

    go = lambda: ingest.ingest(spark, lake, bronze.file_source(spark, landing, 1), available_now=True, silver=True, log=lambda x: None)
    with monkeypatch.context() as m:
        m.setattr(ingest, "merge_events", failing)
        with pytest.raises(Exception, match="lost"):
            go()
    go()
    want = given.bronze(spark, SF001)
    assert lake.read("bronze").count() == want.count() and lake.read("silver").count() == fact_event(want).count()
