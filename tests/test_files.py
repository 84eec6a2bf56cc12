"""Erasure and compaction of single files: what is left alone, and runs that fail half way."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import children, event, metric, silver_df
from pacewise.operators import erase, maintenance
from pacewise.operators.layout import file_stats
from pacewise.session import fresh_dir
from pacewise.sources import fs
from pacewise.sources.tables import Lake, flat_table, silver_table
from pacewise.streaming.bronze import write_batch


def _users(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "user_id string")


def _bronze(spark, users, per_user=5, day=10, hour=1):
    rows = [event(f"e{u}-{k}", "ad_request", dt.datetime(2024, 1, day, 1), user_id=f"usr-{u:05d}") for u in users for k in range(per_user)]
    at = F.lit(dt.datetime(2024, 1, day, hour)).cast("timestamp_ntz")
    return silver_df(spark, rows).withColumn("kafka_ts", at).withColumn("ingest_ts", at)


def _files(spark, table):
    return {r["file_path"]: r["rows"] for r in file_stats(spark, table).collect()}


def test_erase_replaces_only_the_files_that_hold_the_user(spark):
    lake = Lake(spark, fresh_dir(spark, "t-files"))
    bronze = lake["bronze"]
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "100")
    try:
        write_batch(bronze, _bronze(spark, range(200)), "seed", 0)   # 1,000 rows of a day, sorted by user
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    before = _files(spark, bronze)
    assert len(before) >= 10
    cost = erase.erase(spark, bronze, _users(spark, "usr-00077"))
    after = _files(spark, bronze)
    assert cost.rows_deleted == 5 and cost.files_rewritten <= 2 and cost.rows_rewritten <= 200
    assert cost.partitions_touched == 1 and cost.partitions_emptied == 0
    assert set(after) == set(before) and sum(before.values()) - sum(after.values()) == 5
    assert sum(before[f] != after[f] for f in before) == cost.files_rewritten
    assert lake.read("bronze").count() == 995


@pytest.mark.parametrize("count", [1, 3, 40])
def test_bloom_filters_skip_files_without_the_users(spark, count):
    lake = Lake(spark, fresh_dir(spark, "t-bloom"))
    for b in range(12):   # every batch has ids over the whole range, so minima and maxima tell nothing
        write_batch(lake["bronze"], _bronze(spark, range(b, 1200, 12), 1, hour=b + 1), "seed", b)
    users = _users(spark, *[f"usr-{12 * i + 500:05d}" for i in range(count)])   # all in one batch

    def rows_scanned(table):
        with erase._lookups(spark):
            df = erase._users_rows(table.read(spark, layout=True), table, users)
            assert df.count() == df.count()
            got = df.collect()
            stack, rows = [df._jdf.queryExecution().executedPlan()], 0
            while stack:
                node = stack.pop()
                if node.getClass().getSimpleName() == "FileSourceScanExec":
                    rows += metric(node, "numOutputRows")
                stack.extend(children(node))
        return len(got), rows

    plain = lake["bronze"]
    blind = type(plain)(plain.path, plain.contract, plain.partition_by, plain.layout, plain.derive)
    found, scanned = rows_scanned(plain)
    assert rows_scanned(blind) == (found, 1200)
    assert found == count and scanned <= 300


def test_erase_cut_short_is_finished_by_the_next_run(spark, monkeypatch):
    table = flat_table(fresh_dir(spark, "t-cut") + "/events")
    rows = [event(f"e{i}", "ad_request", dt.datetime(2024, 1, 10, 1), user_id=f"usr-{i % 4:05d}") for i in range(80)]
    silver_df(spark, rows).repartition(6).write.parquet(table.path)
    real, calls = fs.replace, []

    def lost(*args):
        calls.append(args)
        if len(calls) == 3:
            raise RuntimeError("driver lost")
        real(*args)

    with monkeypatch.context() as m:
        m.setattr(fs, "replace", lost)
        with pytest.raises(RuntimeError):
            erase.erase(spark, table, _users(spark, "usr-00001"))
    spark.catalog.refreshByPath(table.path)
    left = table.read(spark)
    assert left.where("user_id <> 'usr-00001'").count() == 60      # no other row is invisible
    cost = erase.erase(spark, table, _users(spark, "usr-00001"))
    assert 0 < cost.rows_deleted < 20 and table.read(spark).count() == 60
    parent, name = table.path.rsplit("/", 1)
    assert fs.list_names(spark, parent, f"{name}__") == []


def _tombstones(spark):
    lake = Lake(spark, fresh_dir(spark, "t-flat"))
    for k in range(3):
        erase.request_erasure(spark, lake, _users(spark, *[f"usr-{k}-{i}" for i in range(40)]))
    return lake["tombstones"], lambda: maintenance.compact(spark, lake["tombstones"]), 120


def _days(spark):
    table = silver_table(fresh_dir(spark, "t-days") + "/fact_event")
    rows = [event(f"e{i}", "ad_request", dt.datetime(2024, 1, 10 + i % 2, 1), user_id="usr-00001") for i in range(60)]
    for k in range(3):
        table.write(silver_df(spark, rows[20 * k: 20 * k + 20]), mode="append")
    return table, lambda: maintenance.compact(spark, table), 60


def _batches(spark):
    lake = Lake(spark, fresh_dir(spark, "t-batches"))
    for b in range(4):
        write_batch(lake["bronze"], _bronze(spark, range(10), 1, hour=b + 1), "seed", b)
    return lake["bronze"], lambda: maintenance.merge_batches(spark, lake["bronze"], "seed"), 40


@pytest.mark.parametrize("kind", [_tombstones, _days, _batches])
@pytest.mark.parametrize("fails_at", [1, 2])
def test_a_refused_rename_hides_no_row_and_leaves_no_stage(spark, monkeypatch, kind, fails_at):
    table, run, total = kind(spark)
    content = lambda: maintenance.fingerprint(table.read(spark))
    before, real, calls = content(), fs.rename, []

    def refused(*args):
        calls.append(args)
        if len(calls) == fails_at:
            raise OSError("refused")
        real(*args)

    with monkeypatch.context() as m:
        m.setattr(fs, "rename", refused)
        if kind is _tombstones and fails_at == 2:   # one file: one move
            run()
        else:
            with pytest.raises(OSError):
                run()
    spark.catalog.refreshByPath(table.path)
    assert table.read(spark).distinct().count() == total
    maintenance.recover(spark, table.path)
    spark.catalog.refreshByPath(table.path)
    assert content() == before
    parent, name = table.path.rsplit("/", 1)
    assert fs.list_names(spark, parent, f"{name}__") == [] and fs.list_names(spark, table.path, "_swap_") == []
    run()
    assert content() == before


def test_compaction_packs_small_files_to_the_target_and_spares_large_ones(spark):
    table = flat_table(fresh_dir(spark, "t-bins") + "/events")
    rows = silver_df(spark, [event(f"e{i}", "ad_request", dt.datetime(2024, 1, 10, 1), user_id=f"usr-{i:05d}") for i in range(4000)])
    rows.where("event_id < 'e2'").coalesce(1).write.parquet(table.path)
    rows.where("event_id >= 'e2'").repartition(20).write.mode("append").parquet(table.path)
    before = {r["file_path"]: r["file_size"] for r in file_stats(spark, table).collect()}
    large = max(before, key=before.get)
    small = sorted(before.values())[:-1]
    target = sum(small) // 4
    report = maintenance.compact(spark, table, small_bytes=before[large] // 2, target_bytes=target)
    assert report["files_before"] == 20 and 4 <= report["files_after"] <= 5
    after = {r["file_path"]: r["file_size"] for r in file_stats(spark, table).collect()}
    assert after[large] == before[large] and len(after) == 1 + report["files_after"]
    assert table.read(spark).count() == 4000 == table.read(spark).select("event_id").distinct().count()
    assert maintenance.compact(spark, table, small_bytes=before[large] // 2, target_bytes=target)["partitions"] == 0


def test_a_write_counts_its_rows(spark):
    table = silver_table(fresh_dir(spark, "t-count") + "/fact_event")
    assert table.write(silver_df(spark, [])) == 0
    rows = [event(f"e{i}", "ad_request", dt.datetime(2024, 1, 10, i % 24), user_id=f"usr-{i}") for i in range(70)]
    assert table.write(silver_df(spark, rows)) == 70 == table.read(spark).count()
    assert table.write(silver_df(spark, rows[:5]), mode="append") == 5
