"""Erasure: partition-level rewrite, emptied partitions, id validation, tombstones, audit."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from helpers import event, silver_df
from pacewise.functions import user_bucket
from pacewise.operators import erase
from pacewise.operators.layout import file_stats
from pacewise.session import fresh_dir
from pacewise.sources.tables import Lake, silver_table


def _users(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "user_id string")


def _bucket(spark, uid):
    return spark.range(1).select(user_bucket(F.lit(uid))).first()[0]


def test_erase_removes_emptied_partition_and_keeps_others(spark):
    day1, day2 = dt.datetime(2024, 1, 10, 9), dt.datetime(2024, 1, 11, 9)
    rows = [event("a", "ad_request", day1, user_id="usr-alone"),       # alone in its (day, bucket)
            event("b", "ad_request", day2, user_id="usr-alone"),
            event("c", "ad_request", day2, user_id="usr-other")]
    table = silver_table(fresh_dir(spark, "t-erase") + "/fact_event")
    table.write(silver_df(spark, rows))
    b_alone = _bucket(spark, "usr-alone")
    b_other = _bucket(spark, "usr-other")
    cost = erase.erase(spark, table, _users(spark, "usr-alone"))
    assert cost.rows_deleted == 2
    assert not os.path.exists(f"{table.path}/event_date=2024-01-10/user_bucket={b_alone}".replace("file:", ""))
    left = sorted(r["event_id"] for r in table.read(spark).collect())
    assert left == ["c"]
    if b_alone != b_other:
        assert cost.partitions_emptied == 2
    assert erase.remaining_rows(spark, table, _users(spark, "usr-alone")) == 0


def test_erase_with_a_joined_id_table(spark):
    rows = [event(f"e{i}", "ad_request", dt.datetime(2024, 1, 10, i % 24), user_id=f"usr-{i % 7:05d}")
            for i in range(200)]
    table = silver_table(fresh_dir(spark, "t-erase-join") + "/fact_event")
    table.write(silver_df(spark, rows))
    users = _users(spark, "usr-00001", "usr-00002")
    cost = erase.erase(spark, table, users)
    assert cost.rows_deleted == sum(1 for i in range(200) if i % 7 in (1, 2))
    assert table.read(spark).where(F.col("user_id").isin("usr-00001", "usr-00002")).count() == 0
    assert table.read(spark).count() == 200 - cost.rows_deleted


@pytest.mark.parametrize("bad", ["x' OR '1'='1", "abc\n", "", "usr 1"])
def test_bad_user_ids_are_rejected(spark, bad):
    with pytest.raises(erase.UnsafeUserId):
        erase.validated_users(_users(spark, "usr-00001", bad))


def _lake_with_silver(spark, rows):
    lake = Lake(spark, fresh_dir(spark, "t-lake"))
    lake.write("silver", silver_df(spark, rows))
    return lake


def test_tombstones_hide_rows_without_touching_files_then_reconcile(spark):
    rows = [event(f"e{i}", "impression", dt.datetime(2024, 1, 10, i % 24), f"req-{i}",
                  user_id=f"usr-{i % 3:05d}") for i in range(60)]
    lake = _lake_with_silver(spark, rows)
    files_before = sorted(r["file_path"] for r in file_stats(spark, lake["silver"]).collect())
    erase.request_erasure(spark, lake, _users(spark, "usr-00001"))
    assert erase.live(spark, lake, "silver").where(F.col("user_id") == "usr-00001").count() == 0
    assert erase.live(spark, lake, "silver").count() == 40
    files_after = sorted(r["file_path"] for r in file_stats(spark, lake["silver"]).collect())
    assert files_before == files_after                      # N11: data files unchanged
    assert lake.read("silver").count() == 60                 # rows still physically there


def test_forget_all_layers_and_audit(spark):
    from conftest import SF001
    from pacewise.plans import builders
    lake = Lake(spark, fresh_dir(spark, "t-forget"))
    builders.run(builders.BuildContext(spark, lake, SF001), "seeded")
    uid = lake.read("delivery").groupBy("user_id").count().orderBy(F.desc("count"), "user_id").first()[0]
    before = {n: lake.read(n).count() for n in ("bronze", "silver", "delivery")}
    result = erase.forget(spark, lake, _users(spark, uid))
    assert result["tables"] == ["bronze", "silver", "delivery", "fill", "pacing"]
    for n in ("bronze", "silver", "delivery"):
        assert lake.read(n).where(F.col("user_id") == uid).count() == 0
        assert lake.read(n).count() == before[n] - result["costs"][n]["rows_deleted"]
    log = lake.read("erasure_log").collect()
    assert [(r["user_id"], r["tables"]) for r in log] == [(uid, "bronze,silver,delivery,fill,pacing")]
    # the rebuilt aggregates count only the remaining impressions
    n_imps = lake.read("silver").where(F.col("event_type") == "impression").count()
    assert lake.read("fill").agg(F.sum("impressions")).first()[0] == n_imps


def test_reconcile_applies_tombstones_and_clears_them(spark):
    from conftest import SF001
    from pacewise.plans import builders
    from pacewise.sources import fs
    lake = Lake(spark, fresh_dir(spark, "t-reconcile"))
    builders.run(builders.BuildContext(spark, lake, SF001), "seeded")
    uid = lake.read("silver").groupBy("user_id").count().orderBy(F.desc("count"), "user_id").first()[0]
    erase.request_erasure(spark, lake, _users(spark, uid))
    assert lake.read("silver").where(F.col("user_id") == uid).count() > 0
    out = erase.reconcile(spark, lake)
    assert out["applied_files"] >= 1 and "silver" in out["tables"]
    for n in ("bronze", "silver", "delivery"):
        assert lake.read(n).where(F.col("user_id") == uid).count() == 0
    assert lake.read("tombstones").count() == 0
    assert not fs.list_names(spark, lake["tombstones"].path, "part-")


def test_erase_on_an_unpartitioned_table(spark):
    from pacewise.sources.tables import flat_table
    rows = [event(f"e{i}", "ad_request", dt.datetime(2024, 1, 10, i % 24), user_id=f"usr-{i % 4:05d}")
            for i in range(40)]
    table = flat_table(fresh_dir(spark, "t-flat") + "/events", name="flat")
    silver_df(spark, rows).repartition(3).write.parquet(table.path)
    cost = erase.erase(spark, table, _users(spark, "usr-00002"))
    assert cost.rows_deleted == 10 and cost.rows_rewritten == 40
    assert sorted({r["user_id"] for r in table.read(spark).collect()}) == ["usr-00000", "usr-00001", "usr-00003"]
    assert table.read(spark).count() == 30
