"""Jobs whose work must keep its shape when the tables grow: packing, landing, the layout study, the classifier."""

import datetime as dt
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from pacewise.llm import quality
from pacewise.operators import analyst, layout
from pacewise.operators.silver import deduplicated
from pacewise.plans import jobs
from pacewise.session import fresh_dir
from pacewise.sources import fs, given
from pacewise.sources.tables import Lake, silver_table
from pacewise.streaming import bronze


@pytest.fixture
def conf(spark):
    """Sets options of the session for one test."""
    before = {}

    def put(**options):
        for key, value in options.items():
            name = "spark.sql." + key.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)
    yield put
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _events(spark, rows: int, files: int) -> str:
    """Given ``events`` of two days in so many files."""
    path = fresh_dir(spark, "t-events")
    at = F.lit(dt.datetime(2024, 1, 10)).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") * 172_000 / rows)
    (spark.range(rows).select(F.col("id").alias("event_id"), at.alias("ts"), (F.col("id") * 37 % 211).alias("user_id"))
     .repartition(files).write.parquet(f"{path}/events.parquet"))
    return path


def test_small_files_are_packed_where_a_day_has_many_large_ones(spark, conf):
    path = _events(spark, 30_000, 16)
    conf(adaptive__advisoryPartitionSizeInBytes="64k", files__maxPartitionBytes="64k", files__openCostInBytes="64k")
    got = jobs.compacted_bronze(spark, path)
    assert got.exceptAll(given.bronze(spark, path)).isEmpty() and got.count() == given.bronze(spark, path).count()


def test_landed_files_stay_small_and_batches_four(spark, monkeypatch):
    path = _events(spark, 3_000, 2)
    rows = given.bronze(spark, path)
    assert bronze.landing_files(rows) == 4
    monkeypatch.setattr(bronze, "LANDED_ROWS", 500)
    lake = Lake(spark, fresh_dir(spark, "t-landed"))
    raw = jobs.landed(spark, path, lake)
    files = fs.data_files(spark, lake.folder("landing", "ad_events"))
    assert len(files) == 4 * -(-rows.count() // 2_000) > 4
    back = spark.read.schema(bronze.ENVELOPE_SCHEMA).json(files)
    per_file = back.groupBy(F.input_file_name()).count().agg(F.max("count"), F.sum("count")).first()
    assert per_file[0] < 800 and per_file[1] == rows.count()
    seen = []
    query = bronze.start(spark, raw, lake["bronze"], lake.folder("_checkpoints", "b"), "b", available_now=True, on_batch=lambda df, n: seen.append(n))
    query.awaitTermination()
    assert seen == [0, 1, 2, 3]
    columns = [c for c in rows.columns if c != "ingest_ts"]
    assert lake.read("bronze").select(*columns).exceptAll(rows.select(*columns)).isEmpty()


def test_rows_are_not_sorted_before_they_are_shuffled_to_be_deduplicated(spark):
    plan = deduplicated(given.bronze(spark, _events(spark, 100, 1)))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(event_id" in plan and "Sort [event_id" not in plan[plan.rindex("Exchange hashpartitioning(event_id"):]


def test_the_layout_study_shuffles_one_copy_of_each_event(spark):
    silver = given.silver(spark, _events(spark, 2_000, 2))
    study = layout.build_layout_study(spark, silver, fresh_dir(spark, "t-study"), copies=3, bad_files=7)
    want = analyst.amplify(silver, 3)
    assert study.source.read(spark).count() == silver.count()
    for table in (study.bad, study.optimized):
        got = table.read(spark)
        assert got.count() == want.count() and got.exceptAll(want).isEmpty()
    assert layout.file_stats(spark, study.bad).count() == 7


def test_copies_made_while_writing_stay_sorted_in_one_file_a_partition(spark):
    silver = given.silver(spark, _events(spark, 3_000, 2))
    table = silver_table(fresh_dir(spark, "t-copied") + "/fact_event")
    assert table.write(silver, copied=lambda rows: analyst.with_copies(rows, 4)) == 4 * silver.count()
    assert table.read(spark).exceptAll(analyst.amplify(silver, 4)).isEmpty()
    for path in [r["file_path"] for r in layout.file_stats(spark, table).collect()][:5]:
        keys = [(r[0], r[1]) for r in spark.read.parquet(fs.plain(path)).select(*table.cluster_by).collect()]
        assert keys == sorted(keys)


def test_the_fit_holds_its_sample_once():
    r = np.random.default_rng(7)
    rows = [(np.sort(r.choice(1 << 18, 2_000, replace=False)).astype(np.int32), r.random(2_000).astype(np.float32) / 1_000, k % 2) for k in range(1_500)]
    held = sum(at.nbytes + value.nbytes for at, value, _ in rows)
    tracemalloc.start()
    model = quality.fit(rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert model is not None and peak < 1.5 * held + (40 << 20)
