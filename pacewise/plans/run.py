"""Command line: build targets, maintenance, or erase users from a lake.

    python -m pacewise.plans.run all --lake <root> [--sf-dir <given tables>] [--campaigns <json>]
    python -m pacewise.plans.run seeded --lake <root> --sf-dir /root/testdata/sf0.01
    python -m pacewise.plans.run maintenance --lake <root>
    python -m pacewise.plans.run forget --lake <root> --user-id usr-00149 [--user-id ...]
    python -m pacewise.plans.run forget --lake <root> --users-table <parquet with user_id>
    python -m pacewise.plans.run reconcile --lake <root>
    python -m pacewise.plans.run ingest --lake <root> --kafka host:9092 [--topic ad_events] [--silver]
    python -m pacewise.plans.run ingest --lake <root> --landing <JSON envelopes> [--available-now]
    python -m pacewise.plans.run stop-ingest --lake <root> [--tag ingest]
"""

from __future__ import annotations

import argparse
import json

from pacewise.operators import erase
from pacewise.plans import builders
from pacewise.session import get_session
from pacewise.sources.tables import Lake
from pacewise.streaming import bronze, ingest


def main(argv: list[str] | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="pacewise")
    ap.add_argument("target", help="builder, group, 'forget', 'reconcile', 'ingest' or 'stop-ingest'")
    ap.add_argument("--lake", required=True)
    ap.add_argument("--sf-dir")
    ap.add_argument("--campaigns")
    ap.add_argument("--user-id", action="append", default=[])
    ap.add_argument("--users-table")
    ap.add_argument("--master")
    ap.add_argument("--kafka", help="bootstrap servers (needs the Kafka connector)")
    ap.add_argument("--topic", default="ad_events")
    ap.add_argument("--landing", help="folder of landed JSON envelopes, instead of Kafka")
    ap.add_argument("--most-per-batch", type=int, help="offsets (Kafka) or files a batch takes at most")
    ap.add_argument("--tag", default="ingest")
    ap.add_argument("--trigger", default="10 seconds")
    ap.add_argument("--available-now", action="store_true")
    ap.add_argument("--silver", action="store_true", help="merge every batch into silver")
    args = ap.parse_args(argv)
    spark = get_session(args.master, app=f"pacewise-{args.target}")
    lake = Lake(spark, args.lake)
    try:
        if args.target == "forget":
            if args.users_table:
                users = spark.read.parquet(args.users_table).select("user_id")
            else:
                users = spark.createDataFrame([(u,) for u in args.user_id], "user_id string")
            result = erase.forget(spark, lake, users)
        elif args.target == "ingest":
            if bool(args.kafka) == bool(args.landing):
                ap.error("ingest needs --kafka or --landing")
            raw = (bronze.kafka_source(spark, args.kafka, args.topic, max_offsets_per_trigger=args.most_per_batch) if args.kafka
                   else bronze.file_source(spark, args.landing, args.most_per_batch))
            result = ingest.ingest(spark, lake, raw, args.tag, args.trigger, args.available_now, args.silver)
        elif args.target == "stop-ingest":
            ingest.request_stop(spark, lake, args.tag)
            result = {"asked": args.tag}
        elif args.target == "reconcile":
            result = erase.reconcile(spark, lake)
        else:
            ctx = builders.BuildContext(spark, lake, args.sf_dir, args.campaigns, log=print)
            result = builders.run(ctx, args.target)
        print(json.dumps(result, default=str))
        return result
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
