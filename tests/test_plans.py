"""What the products' plans share: scans of the events and shuffles on event_id."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from helpers import children, event, silver_df
from pacewise.operators import analyst, gold
from pacewise.sources import given


def _nodes(df):
    df.collect()
    stack, seen = [df._jdf.queryExecution().executedPlan()], []
    while stack:
        node = stack.pop()
        seen.append((node.getClass().getSimpleName(), node.simpleString(200)))
        if node.getClass().getSimpleName() not in ("ReusedExchangeExec", "ReusedSubqueryExec"):
            stack.extend(children(node))
    return seen


@pytest.mark.parametrize("name", ["delivery", "pacing", "checks"])
def test_one_scan_and_one_shuffle_on_event_id(spark, name):
    silver, dim = given.silver(spark, SF001), given.dim(spark, SF001)
    df = {"delivery": lambda: gold.impression_delivery(silver), "pacing": lambda: gold.campaign_pacing(silver, dim),
          "checks": lambda: analyst.silver_checks(silver, dim)}[name]()
    nodes = _nodes(df)
    scans = [s for kind, s in nodes if kind == "FileSourceScanExec" and "events.parquet" in s]
    shuffles = [s for kind, s in nodes if kind == "ShuffleExchangeExec" and re.search(r"hashpartitioning\(event_id", s)]
    assert len(scans) == 1 and len(shuffles) == 1, nodes


def test_impressions_without_or_with_one_hot_request(spark):
    """A third of the impressions has no request id, a third has the same one."""
    t = dt.datetime(2024, 1, 10)
    rows = [event(f"n{i}", "impression", t + dt.timedelta(seconds=i), None, user_id=f"usr-{i}") for i in range(3000)]
    rows += [event(f"h{i}", "impression", t + dt.timedelta(seconds=i), "hot", user_id=f"usr-{i}") for i in range(3000)]
    rows += [event(f"u{i}", "impression", t + dt.timedelta(seconds=i), f"req-{i}", user_id=f"usr-{i}") for i in range(3000)]
    rows += [event("q1", "q25", t, "hot"), event("q2", "q50", t, None), event("q3", "q25", t, "req-7"), event("q4", "q50", t, "req-7"),
             event("q5", "q25", t, "without-impression"), event("twice", "impression", t, "req-0", user_id="usr-0")]
    out = gold.impression_delivery(silver_df(spark, rows))
    got = {(r["request_id"], r["completed_q25"], r["completed_q50"]): r["n"] for r in
           out.groupBy("request_id", "completed_q25", "completed_q50").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got.pop((None, False, False)) == 3000 and got.pop(("hot", True, False)) == 3000
    assert got.pop(("req-7", True, True)) == 1 and len(got) == 2999 and set(got.values()) == {1}
    assert out.agg(F.bool_or("completed_q75"), F.bool_or("completed_q100")).first() == (False, False)


def test_rows_without_a_request_spread_over_the_tasks(spark):
    t = dt.datetime(2024, 1, 10)
    rows = [event(f"n{i}", "impression", t + dt.timedelta(seconds=i), None if i % 10 < 3 else f"req-{i}", user_id=f"usr-{i}") for i in range(8000)]
    keys = ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")
    before = {k: spark.conf.get(k) for k in keys}
    spark.conf.set(keys[0], "false")
    spark.conf.set(keys[1], "8")
    try:
        for part in ("request_id IS NULL", "request_id IS NOT NULL"):
            out = gold.impression_delivery(silver_df(spark, rows)).where(part).withColumn("task", F.spark_partition_id())
            sizes = sorted(r["n"] for r in out.groupBy("task").agg(F.count(F.lit(1)).alias("n")).collect())
            assert len(sizes) == 8 and sizes[-1] < 2 * sizes[len(sizes) // 2], sizes
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
