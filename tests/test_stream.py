"""Stream -> bronze: restart from the checkpoint, replay safety, lost-checkpoint guard."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from pacewise.session import fresh_dir
from pacewise.sources import given
from pacewise.sources.tables import Lake
from pacewise.streaming import bronze as stream


def _run(spark, lake, landing, tag="ingest", checkpoint=None):
    q = stream.start(spark, stream.file_source(spark, landing, 1), lake["bronze"],
                     checkpoint or lake.folder("_chk"), tag, available_now=True)
    q.awaitTermination()
    assert q.exception() is None


def test_restart_ingests_each_record_once(spark):
    lake = Lake(spark, fresh_dir(spark, "t-stream"))
    src = given.bronze(spark, SF001).withColumn("part", F.pmod(F.hash("request_id"), F.lit(3)))
    landing = lake.folder("landing")
    for p in range(3):
        stream.land_envelopes(src.where(F.col("part") == p).drop("part"), f"{landing}/p{p}", files=1)
    first = lake.folder("landing_first")
    os.makedirs(first.replace("file:", ""), exist_ok=True)
    # files 1 and 2, stop, then file 3 and restart from the checkpoint
    for p in range(2):
        shutil.copytree(f"{landing}/p{p}", f"{first}/p{p}")
    _run(spark, lake, f"{first}/*")
    n_two = lake.read("bronze").count()
    shutil.copytree(f"{landing}/p2", f"{first}/p2")
    _run(spark, lake, f"{first}/*")
    total = src.count()
    assert n_two < total
    assert lake.read("bronze").count() == total
    # replaying a batch (same batch id) replaces it instead of adding rows
    batch0 = lake.read("bronze", layout=True).where(F.col("batch_id") == 0).drop(
        "stream_tag", "batch_id", "ingest_date")
    stream.write_batch(lake["bronze"], batch0, "ingest", 0)
    assert lake.read("bronze").count() == total


def test_lost_checkpoint_with_existing_tag_is_refused(spark):
    lake = Lake(spark, fresh_dir(spark, "t-stream-guard"))
    landing = lake.folder("landing")
    stream.land_envelopes(given.bronze(spark, SF001), landing, files=1)
    _run(spark, lake, landing, checkpoint=lake.folder("_chk1"))
    with pytest.raises(RuntimeError):
        _run(spark, lake, landing, checkpoint=lake.folder("_chk2"))
    _run(spark, lake, landing, tag="ingest2", checkpoint=lake.folder("_chk3"))   # new tag is fine


def test_merge_batches_keeps_rows_and_newest_batch(spark):
    from pacewise.operators.maintenance import merge_batches
    from pacewise.sources import fs
    lake = Lake(spark, fresh_dir(spark, "t-merge"))
    landing = lake.folder("landing")
    stream.land_envelopes(given.bronze(spark, SF001), landing, files=4)
    _run(spark, lake, landing)
    tag_dir = f"{lake['bronze'].path}/stream_tag=ingest"
    before = lake.read("bronze").count()
    assert len(fs.list_names(spark, tag_dir, "batch_id=")) == 4
    report = merge_batches(spark, lake["bronze"], "ingest")
    assert report == {"merged_batches": 3, "into_batch": 2}
    assert fs.list_names(spark, tag_dir, "batch_id=") == ["batch_id=2", "batch_id=3"]
    assert lake.read("bronze").count() == before
    # a restart continues with batch ids above the merged folder
    more = lake.folder("landing2")
    stream.land_envelopes(given.bronze(spark, SF001).limit(10), more, files=1)
    assert merge_batches(spark, lake["bronze"], "ingest") == {"merged_batches": 0}
