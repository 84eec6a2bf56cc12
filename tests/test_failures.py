"""A run that fails half way, and the run after it."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from pacewise.operators import analyst, erase, gold, maintenance
from pacewise.plans import builders
from pacewise.session import fresh_dir
from pacewise.sources import fs
from pacewise.sources.tables import Lake


def test_erase_after_a_failed_run_refreshes_the_aggregates(spark, monkeypatch):
    lake = Lake(spark, fresh_dir(spark, "t-retry"))
    builders.run(builders.BuildContext(spark, lake, SF001), "seeded")
    users = analyst.top_users(lake.read("silver"), 1).select("user_id")
    users = spark.createDataFrame([tuple(r) for r in users.collect()], "user_id string")

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(erase, "refresh_fill_days", broken)
        with pytest.raises(RuntimeError, match="incomplete"):
            erase.forget(spark, lake, users)
    assert erase.forget(spark, lake, users)["tables"][-2:] == ["fill", "pacing"]
    fill = gold.inventory_fill(lake.read("silver"))
    stored = lake.read("fill").select(*fill.columns)
    assert fill.subtract(stored).count() == stored.subtract(fill).count() == 0
    pacing = gold.campaign_pacing(lake.read("silver"), lake.read("dim_campaign"))
    assert lake.read("pacing").count() == pacing.count()


def test_a_refused_rename_loses_no_row(spark, monkeypatch):
    root = fresh_dir(spark, "t-swap")
    old, new = f"{root}/d=1", f"{root}_stage/d=1"
    spark.range(5).write.parquet(old)
    spark.range(100, 103).write.parquet(new)
    rename = fs.rename

    def refused(s, src, dst):
        if src == new:
            raise OSError("refused")
        rename(s, src, dst)

    with monkeypatch.context() as m:
        m.setattr(fs, "rename", refused)
        with pytest.raises(OSError):
            maintenance.swap_folders(spark, root, [(new, old)], [])
    assert spark.read.parquet(old).count() == 5 and spark.read.parquet(new).count() == 3
    assert maintenance.recover(spark, root) == 1
    assert sorted(r[0] for r in spark.read.parquet(old).select(F.col("id")).collect()) == [100, 101, 102]
    assert fs.list_names(spark, root, ".old") == []


def test_a_scan_of_ten_thousand_partitions_has_a_flat_predicate(spark):
    keys = [f"seed\u0001{i}" for i in range(0, 20_000, 2)]
    df = spark.range(20_000).select(F.lit("seed").alias("stream_tag"), F.col("id").alias("batch_id"))
    df = df.unionByName(spark.sql("SELECT 'seed' AS stream_tag, CAST(NULL AS BIGINT) AS batch_id"))
    cols = ["stream_tag", "batch_id"]
    assert df.where(maintenance.in_partitions(cols, keys)).count() == 10_000
    null = f"seed\u0001{maintenance.NULL_KEY}"
    assert df.where(maintenance.in_partitions(cols, [null])).count() == 1


def test_partition_keys_prune_the_scan(spark):
    path = fresh_dir(spark, "t-prune")
    spark.range(6).selectExpr("id", "CAST('2024-01-01' AS DATE) + CAST(id AS INT) AS d", "id % 2 AS b").write.partitionBy("d", "b").parquet(path)
    df = spark.read.parquet(path).where(maintenance.in_partitions(["d", "b"], ["2024-01-02\u00011", "2024-01-05\u00010"]))
    assert sorted(r["id"] for r in df.collect()) == [1, 4]
    assert len({r[0] for r in df.select("_metadata.file_path").collect()}) == 2
    assert "PartitionFilters: [concat_ws" in df._jdf.queryExecution().executedPlan().toString()


def test_erasing_five_and_five_thousand_ids_takes_one_plan(spark):
    from helpers import event, silver_df
    import datetime as dt
    from pacewise.sources.tables import silver_table
    table = silver_table(fresh_dir(spark, "t-many") + "/fact_event")
    table.write(silver_df(spark, [event(f"e{i}", "ad_request", dt.datetime(2024, 1, 10, 1), user_id=f"usr-{i:05d}") for i in range(40)]))
    few = spark.createDataFrame([(f"usr-{i:05d}",) for i in range(5)], "user_id string")
    many = spark.range(5, 5005).select(F.format_string("usr-%05d", "id").alias("user_id")).where("id % 2 = 1")
    assert erase.erase(spark, table, few).rows_deleted == 5
    assert erase.erase(spark, table, many).rows_deleted == 18
    assert table.read(spark).count() == 17


def test_compaction_settles_and_spares_the_newest_batch_of_every_tag(spark):
    from pacewise.sources import given
    lake = Lake(spark, fresh_dir(spark, "t-settle"))
    rows = given.bronze(spark, SF001).limit(60).withColumn("ingest_ts", F.expr("TIMESTAMP_NTZ'2024-01-10 01:00:00'"))
    for tag, batches in (("a", (0, 1)), ("b", (0, 7))):
        for batch in batches:
            for _ in range(3):
                path = f"{lake['bronze'].path}/stream_tag={tag}/batch_id={batch}/ingest_date=2024-01-10"
                rows.write.mode("append").parquet(path)
    before = lake.count("bronze")
    first = maintenance.compact(spark, lake["bronze"], skip_latest="batch_id")
    assert first["partitions"] == 2 and first["files_after"] < first["files_before"]
    assert lake.count("bronze") == before == 720
    assert maintenance.compact(spark, lake["bronze"], skip_latest="batch_id")["partitions"] == 0
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "90")
    try:
        again = maintenance.compact(spark, lake["bronze"])
        assert again["partitions"] == 2 and lake.count("bronze") == before   # the two left out above
        assert maintenance.compact(spark, lake["bronze"])["partitions"] == 0
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
