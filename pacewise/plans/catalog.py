"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``, keyed by SURVEY section 7.3.

Pure queries derive every layer from the given tables in one lazy plan. Side-effect jobs
(layouts, erasure, streaming, compaction) run the real job on their own copy of the lake under
the session's checkpoint folder and return the resulting table.

The campaigns are the 20 of FIXTURES.md (``nation`` keys 0..19), at any size of the input, as the events
derived there use these 20 codes only; no event is left without its campaign.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pacewise.operators import analyst, checks, gold
from pacewise.sources import given

Query = Callable[[SparkSession, str], DataFrame]


def _delivery(s: SparkSession, d: str) -> DataFrame:
    return gold.impression_delivery(given.silver(s, d))


def _fill(s: SparkSession, d: str) -> DataFrame:
    return gold.inventory_fill(given.silver(s, d))


def _pacing(s: SparkSession, d: str) -> DataFrame:
    return gold.campaign_pacing(given.silver(s, d), given.dim(s, d))


PURE: dict[str, Query] = {
    "bronze_smoke": lambda s, d: analyst.bronze_smoke(given.bronze(s, d)),
    "silver_fact_event": given.silver,
    "dim_campaign": given.dim,
    "gold_delivery": _delivery,
    "gold_fill": _fill,
    "gold_pacing": _pacing,
    "gold_pacing_from_fill": lambda s, d: gold.campaign_pacing_from_fill(_fill(s, d), given.dim(s, d)),
    "pacing_leaderboard": lambda s, d: analyst.pacing_leaderboard(_pacing(s, d)),
    "fill_by_placement": lambda s, d: analyst.fill_by_placement(_fill(s, d)),
    "completion_funnel": lambda s, d: analyst.completion_funnel(_delivery(s, d)),
    "silver_checks": lambda s, d: analyst.silver_checks(given.silver(s, d), given.dim(s, d)),
    "top_user": lambda s, d: analyst.top_users(given.silver(s, d), 1),
    "amplified_events": lambda s, d: analyst.amplify(given.silver(s, d)),
    "orphan_impressions": lambda s, d: checks.orphan_impressions(given.silver(s, d)),
    "unjoined_events": lambda s, d: checks.unjoined_events(given.silver(s, d), given.dim(s, d)),
    "delivery_matches_impressions": lambda s, d: checks.delivery_matches_impressions(given.silver(s, d), _delivery(s, d)),
    "nesting_violations": lambda s, d: checks.nesting_violations(_delivery(s, d)),
    "negative_fill": lambda s, d: checks.negative_fill(_fill(s, d)),
    "pacing_deltas": lambda s, d: checks.pacing_deltas(_pacing(s, d)),
    "label_counts": lambda s, d: checks.label_counts(_pacing(s, d)),
    "late_events_by_day": lambda s, d: checks.late_events_by_day(given.deduped(s, d)),
}


def queries() -> dict[str, Query]:
    return {**PURE, **_side_effect_queries()}


def _side_effect_queries() -> dict[str, Query]:
    from pacewise.plans import jobs

    return {
        "user_filtered_scan": jobs.user_filtered_scan,
        "date_range_scan": jobs.date_range_scan,
        "campaign_rollup": jobs.campaign_rollup,
        "forget_user_bronze": jobs.forgotten_table("bronze"),
        "forget_user_silver": jobs.forgotten_table("silver"),
        "forget_user_delivery": jobs.forgotten_table("delivery"),
        "forget_user_fill": jobs.forgotten_table("fill"),
        "forget_user_pacing": jobs.forgotten_table("pacing"),
        "erasure_log": jobs.erasure_log,
        "dim_campaign_landed": jobs.landed_campaigns,
        "tombstone_read": jobs.tombstone_read,
        "stream_bronze": jobs.streamed_bronze,
        "stream_fact_event": jobs.streamed_silver,
        "compacted_silver": jobs.compacted_silver,
        "compacted_bronze": jobs.compacted_bronze,
        "reconciled_silver": jobs.reconciled_silver,
        "incremental_silver": jobs.incremental_silver,
        "stream_broken_bronze": jobs.stream_broken_bronze,
        "stream_binary_bronze": jobs.stream_binary_bronze,
        "forced_files": jobs.forced_files,
        "refusals": jobs.refusals,
        "named_rollup": jobs.named_rollup,
        "scan_savings": jobs.scan_savings,
        "layouts_agree": jobs.layouts_agree,
        "delete_ratio": jobs.delete_ratio,
        "deferred_erasure": jobs.deferred_erasure,
        # rows-only: results depend on the physical file layout
        "layout_report": jobs.layout_report,
        "scan_volume": jobs.scan_volume,
        "delete_cost": jobs.delete_cost,
    }
