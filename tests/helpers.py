"""Builders for hand-written micro-fixtures."""

from __future__ import annotations

import datetime as dt

from pacewise.schemas import BRONZE_SCHEMA, DIM_CAMPAIGN_SCHEMA, SILVER_SCHEMA

T0 = dt.datetime(2024, 1, 10, 12, 0, 0)


def ts(minutes: float = 0, base: dt.datetime = T0) -> dt.datetime:
    return base + dt.timedelta(minutes=minutes)


def event(event_id, event_type, at, request_id="req-1", campaign_id="cmp-001", user_id="usr-00001",
          placement="preroll"):
    return (event_id, event_type, at, campaign_id, "crv-001", request_id, user_id, "mobile", "US-CA", placement)


def silver_df(spark, rows):
    return spark.createDataFrame(rows, SILVER_SCHEMA)


def bronze_df(spark, rows):
    return spark.createDataFrame(rows, BRONZE_SCHEMA)


def dim_df(spark, rows):
    """rows: (campaign_id, budget, flight_start, flight_end)"""
    full = [(c, b, s, e, 0.0, "US-CA", "mobile") for c, b, s, e in rows]
    return spark.createDataFrame(full, DIM_CAMPAIGN_SCHEMA)


# --- what an executed plan did ------------------------------------------------------------------------
def children(node):
    name = node.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return [node.executedPlan()]
    if name.endswith("QueryStageExec"):
        return [node.plan()]
    seq = node.children()
    kids = [seq.apply(i) for i in range(seq.size())]
    subs = node.subqueries()
    kids += [subs.apply(i) for i in range(subs.size())]
    return kids


def metric(node, key: str) -> int:
    opt = node.metrics().get(key)
    return int(opt.get().value()) if opt.isDefined() else 0


def scan_metrics(df: DataFrame) -> dict[str, int]:
    """Run ``df`` and sum the file-scan metrics of its executed plan: the files its scans select and their
    full sizes (column pruning reads less of each)."""
    df.collect()
    files = size = scans = 0
    stack = [df._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            scans += 1
            files += metric(node, "numFiles")
            size += metric(node, "filesSize")
        stack.extend(children(node))
    return {"scans": scans, "files_read": files, "file_bytes": size}
