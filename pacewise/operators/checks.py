"""Data-quality checks N1-N12 as queries. Each returns a small DataFrame; ``assert_*`` helpers
turn them into hard failures for jobs and tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pacewise.functions import seconds, utc_day


def orphan_impressions(silver: DataFrame) -> DataFrame:
    """Impressions without an ad request of the same request_id (N4: B17 as C6 left-anti join)."""
    imps = silver.where(F.col("event_type") == "impression").select("request_id")
    # distinct: a request id repeated many times reaches the join as one row (partial agg map-side)
    reqs = silver.where(F.col("event_type") == "ad_request").select("request_id").distinct()
    return imps.join(reqs, "request_id", "left_anti").agg(F.count(F.lit(1)).alias("orphan_impressions"))


def unjoined_events(silver: DataFrame, dim: DataFrame) -> DataFrame:
    """Silver events whose campaign is not in the dimension."""
    return (silver.select("campaign_id")
            .join(dim.select("campaign_id"), "campaign_id", "left_anti")
            .agg(F.count(F.lit(1)).alias("unjoined_events")))


def delivery_matches_impressions(silver: DataFrame, delivery: DataFrame) -> DataFrame:
    """Delivery rows and silver impressions, which must be as many."""
    impressions = silver.where(F.col("event_type") == "impression").agg(F.count(F.lit(1))).scalar()
    return delivery.agg(F.count(F.lit(1)).alias("delivery_rows")).select("delivery_rows", impressions.alias("impressions"))


def nesting_violations(delivery: DataFrame) -> DataFrame:
    """Impressions completing a later quartile without the earlier one (N6: B12)."""
    c = {q: F.col(f"completed_{q}") for q in ("q25", "q50", "q75", "q100")}
    bad = ((c["q50"] & ~c["q25"]) | (c["q75"] & ~c["q50"]) | (c["q100"] & ~c["q75"]))
    return delivery.where(bad).agg(F.count(F.lit(1)).alias("nesting_violations"))


def negative_fill(fill: DataFrame) -> DataFrame:
    """Fill buckets with a negative rate (N7: B13)."""
    bad = F.col("fill_rate").isNotNull() & (F.col("fill_rate") < 0)
    return fill.where(bad).agg(F.count(F.lit(1)).alias("negative_fill"))


def pacing_deltas(pacing: DataFrame) -> DataFrame:
    """Day-over-day change of the running total per campaign (E3); never negative."""
    w = Window.partitionBy("campaign_id").orderBy("pacing_date")
    return pacing.select(
        "campaign_id", "pacing_date", "cumulative_delivered",
        (F.col("cumulative_delivered") - F.lag("cumulative_delivered").over(w)).alias("delta"))


def label_counts(pacing: DataFrame) -> DataFrame:
    """Rows and delivered total per pace label (N8: the labels vary)."""
    return (pacing.groupBy("pace_label")
            .agg(F.count(F.lit(1)).alias("campaign_days"),
                 F.sum("cumulative_delivered").alias("cumulative_total")))


def late_events_by_day(deduped: DataFrame, late_after_seconds: int = 60) -> DataFrame:
    """Events per event_ts day and how many of them arrived late.

    The batch policy accepts any lateness: a rebuild lands each row in its own event day.
    ``deduped`` is silver with provenance (``ingest_ts``).
    """
    late = (F.col("ingest_ts") - F.col("event_ts")) > seconds(late_after_seconds)
    return (deduped.groupBy(utc_day("event_ts").alias("event_date"))
            .agg(F.count(F.lit(1)).alias("events"),
                 F.sum(F.when(late, 1).otherwise(0)).cast("bigint").alias("late_events")))


def violations(silver: DataFrame, dim: DataFrame, delivery: DataFrame, fill: DataFrame,
               pacing: DataFrame) -> dict[str, int]:
    """All silver/gold invariants (N2-N8, N12) as numbers that must be zero."""
    counts = silver.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("d")).first()
    n_imps = silver.where(F.col("event_type") == "impression").count()
    labels = pacing.select(F.countDistinct("pace_label")).first()[0]
    decreases = pacing_deltas(pacing).where(F.col("delta") < 0).count()
    return {
        "silver_duplicates": counts["n"] - counts["d"],
        "dim_not_twenty": 0 if dim.count() == 20 else 1,
        "unjoined_events": unjoined_events(silver, dim).first()[0],
        "orphan_impressions": orphan_impressions(silver).first()[0],
        "delivery_vs_impressions": abs(delivery.count() - n_imps),
        "nesting_violations": nesting_violations(delivery).first()[0],
        "negative_fill": negative_fill(fill).first()[0],
        "cumulative_decreases": decreases,
        "fewer_than_two_labels": 0 if labels >= 2 else 1,
    }


def assert_clean(report: dict[str, int]) -> None:
    bad = {k: v for k, v in report.items() if v}
    if bad:
        raise AssertionError(f"data-quality violations: {bad}")
