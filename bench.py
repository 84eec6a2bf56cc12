"""Benchmark: headline builds and queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Prints ONE JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf", "details"}.
``value`` is the sum of all timed steps. The layout queries are timed as the median of 5 runs on
each layout (the comparison the baseline publishes); ``details`` carries the files/bytes each
layout query read and the delete-rewrite ratios, which are the comparable quantities.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pacewise.operators import analyst, erase, layout  # noqa: E402
from pacewise.plans import builders, jobs  # noqa: E402
from pacewise.session import fresh_dir, get_session  # noqa: E402
from pacewise.sources import given  # noqa: E402
from pacewise.sources.tables import Lake  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = 5
FILE_ROWS = 2_000  # rows of a file of the lake at most


def _timed(fn):
    t0 = time.perf_counter()
    out = fn()
    return time.perf_counter() - t0, out


def main() -> None:
    spark = get_session(f"local[{CPUS}]", app="pacewise-bench",
                        extra={"spark.sql.shuffle.partitions": str(CPUS)})
    q: dict[str, float] = {}
    details: dict[str, object] = {}
    # JVM warm-up (class loading, code generation) on the smallest input; not timed
    details["warmup_sec"] = round(
        _timed(lambda: analyst.bronze_smoke(given.bronze(spark, SF_DIR)).collect())[0], 3)

    # --- builds: bronze fixture -> silver -> gold ------------------------------------------------
    lake = Lake(spark, fresh_dir(spark, "bench-lake"))
    ctx = builders.BuildContext(spark, lake, SF_DIR)
    # the cluster profile caps a file's rows, so that a day has many; here a day is small, and so is the cap
    spark.conf.set("spark.sql.files.maxRecordsPerFile", str(FILE_ROWS))
    for name in builders.GROUPS["seeded"]:
        q[f"build_{name}"], n = _timed(lambda name=name: builders.BUILDERS[name](ctx))
        details[f"rows_{name}"] = n
    spark.conf.unset("spark.sql.files.maxRecordsPerFile")

    # --- analyst queries over the gold / silver tables -------------------------------------------
    analyst_qs = {
        "pacing_leaderboard": lambda: analyst.pacing_leaderboard(lake.read("pacing")),
        "fill_by_placement": lambda: analyst.fill_by_placement(lake.read("fill")),
        "completion_funnel": lambda: analyst.completion_funnel(lake.read("delivery")),
        "silver_checks": lambda: analyst.silver_checks(lake.read("silver"), lake.read("dim_campaign")),
        "bronze_smoke": lambda: analyst.bronze_smoke(lake.read("bronze")),
    }
    for name, make in analyst_qs.items():
        q[name], _ = _timed(lambda make=make: make().collect())

    # --- layout study: build both layouts, then the three queries on each ------------------------
    q["build_layout_study"], study = _timed(
        lambda: layout.build_layout_study(spark, lake.read("silver"), fresh_dir(spark, "bench-layout")))
    opt_df = study.optimized.read(spark, layout=True)
    uid = jobs.top_user_id(opt_df)
    day = layout.first_day(opt_df).first()["day"]
    for label, table in (("bad", study.bad), ("optimized", study.optimized)):
        df = table.read(spark, layout=True)
        for qname, make in (("user_filtered_scan", lambda df=df: layout.user_filtered_scan(df, uid)),
                            ("date_range_scan", lambda df=df: layout.date_range_scan(df, day)),
                            ("campaign_rollup", lambda df=df: layout.campaign_rollup(df))):
            times = [_timed(lambda: make().collect())[0] for _ in range(RUNS)]
            q[f"{qname}_{label}"] = statistics.median(times)
        for r in layout.scan_volume(spark, table, uid, day).collect():
            details[f"scan_{r['query'].replace(' ', '_').replace('-', '_')}_{label}"] = {k: r[k] for k in ("files_read", "file_bytes", "column_bytes")}
    for r in layout.layout_report(spark, study.bad, "bad").unionByName(
            layout.layout_report(spark, study.optimized, "optimized")).collect():
        details[f"layout_{r['layout']}"] = {k: r[k] for k in ("files", "total_bytes", "rows")}

    # --- erasure of the top user across all layers -----------------------------------------------
    top = analyst.top_users(lake.read("silver"), 1).select("user_id")
    q["forget_top_user"], result = _timed(lambda: erase.forget(spark, lake, top))
    details["forget_costs"] = result["costs"]

    # --- delete cost: bucketed vs day-only layout ------------------------------------------------
    q["delete_cost_study"], cost = _timed(lambda: jobs.delete_cost(spark, SF_DIR).collect())
    for r in cost:
        details[f"delete_{r['table']}"] = {k: r[k] for k in ("files_rewritten", "rows_rewritten",
                                                             "bytes_rewritten", "rows_deleted")}
    details["delete_rows_ratio"] = cost[0]["rows_ratio_unbucketed_over_bucketed"]
    details["delete_bytes_ratio"] = cost[0]["bytes_ratio_unbucketed_over_bucketed"]

    sf = re.search(r"sf([0-9.]+)", SF_DIR)
    print(json.dumps({
        "metric": "total_sec",
        "value": round(sum(q.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in q.items()},
        "sf": float(sf.group(1)) if sf else SF_DIR,
        "details": details,
    }, default=str))
    spark.stop()


if __name__ == "__main__":
    main()
