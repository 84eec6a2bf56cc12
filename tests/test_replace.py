"""Full replaces, names in the session catalog, and fill by difference."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from helpers import event, silver_df
from pacewise.operators import analyst, erase, gold
from pacewise.plans import builders
from pacewise.session import fresh_dir
from pacewise.sources import fs
from pacewise.sources.tables import Lake, Table

ROWS = [event(f"e{i}", "ad_request", dt.datetime(2024, 1, 10, i % 24), user_id=f"usr-{i % 5:05d}") for i in range(50)]


def _ids(df):
    return sorted(r["event_id"] for r in df.collect())


@pytest.mark.parametrize("lost_in", ["write", "rename", "empty"])
def test_a_build_that_fails_leaves_the_old_table(spark, monkeypatch, lost_in):
    lake = Lake(spark, fresh_dir(spark, "t-replace"))
    names = lake.register(f"t_{lost_in}_")
    lake.write("silver", silver_df(spark, ROWS[:30]))
    before = _ids(lake.read("silver"))
    with monkeypatch.context() as m:
        if lost_in == "write":
            real = Table.write
            def lost(self, df, *a, **k):
                real(self, df, *a, **k)
                raise RuntimeError("driver lost")
            m.setattr(Table, "write", lost)
        elif lost_in == "rename":
            m.setattr(fs, "rename", lambda *a: (_ for _ in ()).throw(OSError("refused")))
        rows = [] if lost_in == "empty" else ROWS[30:]
        with pytest.raises((RuntimeError, OSError, AssertionError)):
            lake.replace("silver", silver_df(spark, rows), must_have_rows=True)
    for again in (lake, Lake(spark, lake.root)):          # this session, and one that starts anew
        assert _ids(again.read("silver")) == before
    assert _ids(spark.table(names["silver"])) == before
    assert lake.replace("silver", silver_df(spark, ROWS[30:])) == 20
    assert _ids(Lake(spark, lake.root).read("silver")) == _ids(spark.table(names["silver"])) == sorted(r[0] for r in ROWS[30:])
    assert len(fs.list_names(spark, f"{lake.root}/silver", "fact_event")) == 1    # neither stage nor old version is left


def test_names_follow_replaces_erasures_and_late_partitions(spark):
    lake = Lake(spark, fresh_dir(spark, "t-names"))
    builders.run(builders.BuildContext(spark, lake, SF001), "seeded")
    names = lake.register("t_follow_")
    assert names["silver"] == "t_follow_silver.fact_event" and names["bronze"] == "t_follow_bronze.ad_events_raw"
    for name in ("bronze", "silver", "delivery", "fill", "pacing", "dim_campaign"):
        table = spark.table(names[name])
        assert table.schema == lake[name].read_schema or sorted(table.dtypes) == sorted(lake.read(name, layout=True).dtypes)
        assert table.count() == lake.count(name)
    uid = spark.sql(f"SELECT user_id FROM {names['silver']} GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 1").first()[0]
    erase.forget(spark, lake, spark.createDataFrame([(uid,)], "user_id string"))
    for name in ("bronze", "silver", "delivery"):
        assert spark.table(names[name]).where(F.col("user_id") == uid).count() == 0
        assert spark.table(names[name]).count() == lake.count(name)
    assert spark.table(names["pacing"]).exceptAll(lake.read("pacing").select(*spark.table(names["pacing"]).columns)).isEmpty()
    builders.run(builders.BuildContext(spark, lake, SF001), "all")
    assert spark.table(names["silver"]).count() == lake.count("silver")
    plan = spark.table(names["silver"]).where("event_date = DATE'2024-01-05' AND user_bucket = 3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_fill_less_the_users_equals_a_rebuild(spark):
    lake = Lake(spark, fresh_dir(spark, "t-diff"))
    builders.run(builders.BuildContext(spark, lake, SF001), "seeded")
    odd = [event("x1", "ad_request", None, user_id="usr-odd", campaign_id=None), event("x2", "impression", dt.datetime(2030, 1, 1), user_id="usr-odd"),
           event("x3", "ad_request", None, user_id="usr-other", campaign_id=None, placement=None)]
    lake.replace("silver", lake.read("silver").unionByName(silver_df(spark, odd)))
    lake.replace("fill", gold.inventory_fill(lake.read("silver")))
    top = [r["user_id"] for r in analyst.top_users(lake.read("silver"), 4).collect()]
    users = spark.createDataFrame([(u,) for u in ["usr-odd", *top]], "user_id string")
    theirs = erase.fill_of(spark, lake, users)
    read = []
    real = gold.inventory_fill
    gold.inventory_fill = lambda df: read.append(1) or real(df)
    try:
        erase.forget(spark, lake, users)
    finally:
        gold.inventory_fill = real
    assert len(read) == 1 and theirs.count() > 0            # only the users' own rows were counted
    want, got = real(lake.read("silver")), lake.read("fill")
    assert got.count() == want.count() and got.select(*want.columns).exceptAll(want).isEmpty()
    assert got.where("event_hour > TIMESTAMP_NTZ'2029-01-01 00:00:00'").count() == 0
    assert got.where("event_hour IS NULL").count() == 1
