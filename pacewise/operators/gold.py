"""Gold products: impression delivery (L6), inventory fill (L4), campaign pacing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pacewise.constants import QUARTILE_TYPES
from pacewise.functions import count_when, inclusive_days, pace_label, ratio, utc_day, utc_hour
from pacewise.schemas import DELIVERY_SCHEMA, FILL_SCHEMA, PACING_SCHEMA, conform

DELIVERY_KEYS = ("request_id", "impression_ts", "campaign_id", "creative_id", "user_id",
                 "device", "geo", "placement")


def impression_delivery(silver: DataFrame) -> DataFrame:
    """One row per impression with quartile-completion flags.

    One pass over silver makes the rows of both join sides: impressions grouped by their eight columns,
    quartiles by their request alone, folded map-side. That shuffle is on all eight columns, so neither a
    hot request nor the rows without one gather in a task, and both sides of the join reuse it.
    Impressions without a request id can't match and go around the join; a request with very many
    impressions meets one flag row, so its side may be split by AQE.
    """
    imp = F.col("event_type") == "impression"
    of_imp = [F.when(imp, F.col("event_ts")).alias("impression_ts"),
              *[F.when(imp, F.col(c)).alias(c) for c in DELIVERY_KEYS if c not in ("request_id", "impression_ts")]]
    rows = (silver.where(F.col("event_type").isin("impression", *QUARTILE_TYPES))
            .select("request_id", *of_imp, imp.alias("shown"), "event_type")
            .groupBy(*DELIVERY_KEYS, "shown")
            .agg(*[F.bool_or(F.col("event_type") == q).alias(f"has_{q}") for q in QUARTILE_TYPES]))
    own = [f"has_{q}" for q in QUARTILE_TYPES]
    flags = rows.where(~F.col("shown") & F.col("request_id").isNotNull()).select("request_id", *[F.col(c).alias(f"any_{c}") for c in own])
    shown = rows.where("shown")
    # an impression's own flags are false; naming them keeps both sides on one shuffle
    matched = shown.where(F.col("request_id").isNotNull()).join(flags, "request_id", "left").select(
        *DELIVERY_KEYS, *[(F.col(f"has_{q}") | F.coalesce(F.col(f"any_has_{q}"), F.lit(False))).alias(f"completed_{q}") for q in QUARTILE_TYPES])
    alone = shown.where(F.col("request_id").isNull()).select(
        *DELIVERY_KEYS, *[F.col(f"has_{q}").alias(f"completed_{q}") for q in QUARTILE_TYPES])
    return conform(matched.unionByName(alone), DELIVERY_SCHEMA)


def inventory_fill(silver: DataFrame) -> DataFrame:
    """Requests, impressions and fill rate per campaign x placement x UTC hour.

    Counted by the hour of each event (not by request linkage), so a bucket may exceed 1;
    requests = 0 gives NULL. One partial + final aggregation: the shuffle carries at most
    one row per key per map task.
    """
    out = (silver.where(F.col("event_type").isin("ad_request", "impression"))
           .groupBy("campaign_id", "placement", utc_hour("event_ts").alias("event_hour"))
           .agg(count_when(F.col("event_type") == "ad_request").alias("requests"),
                count_when(F.col("event_type") == "impression").alias("impressions"))
           .withColumn("fill_rate", ratio("impressions", "requests")))
    return conform(out, FILL_SCHEMA)


def daily_impressions(silver: DataFrame) -> DataFrame:
    """Impressions per campaign and UTC day."""
    return (silver.where(F.col("event_type") == "impression")
            .groupBy("campaign_id", utc_day("event_ts").alias("pacing_date"))
            .agg(F.count(F.lit(1)).alias("delivered_impressions")))


def daily_impressions_from_fill(fill: DataFrame) -> DataFrame:
    """The same per-day counts, summed from the hourly fill table.

    Fill counts impressions by the hour of each event, so its hours of one day add up to that
    day's impressions exactly; the fill table is campaign x placement x hour, tiny next to silver.
    """
    return (fill.where(F.col("impressions") > 0)
            .groupBy("campaign_id", utc_day("event_hour").alias("pacing_date"))
            .agg(F.sum("impressions").cast("bigint").alias("delivered_impressions")))


def campaign_pacing(silver: DataFrame, dim: DataFrame) -> DataFrame:
    """Per campaign x flight day up to ``as_of``: delivery, running total, expected pace,
    pace index and label (L5: D6, D3, H8, H10, C2, B10, E2, H7, H12, H13)."""
    return pacing_from_daily(daily_impressions(silver), dim)


def campaign_pacing_from_fill(fill: DataFrame, dim: DataFrame) -> DataFrame:
    """Campaign pacing computed from the fill table instead of rescanning silver (equal result)."""
    return pacing_from_daily(daily_impressions_from_fill(fill), dim)


def pacing_from_daily(daily: DataFrame, dim: DataFrame) -> DataFrame:
    """Pacing from per-campaign daily impression counts.

    ``as_of`` is the latest impression date over all campaigns, computed once as a scalar
    subquery. The calendar is zero-filled, so pre-flight impressions never enter the running
    sum, and a campaign starting after ``as_of`` has no rows. The running-sum window is
    partitioned by campaign and holds at most one row per flight day.
    """
    # every day has impressions; reading the count as well lets the subquery share the counts' shuffle
    as_of = daily.agg(F.max(F.when(F.col("delivered_impressions") > 0, F.col("pacing_date")))).scalar()
    calendar = (dim.select("campaign_id", "budget", "flight_start", "flight_end")
                .select("*", F.explode(F.sequence("flight_start", "flight_end",
                                                  F.expr("INTERVAL 1 DAY"))).alias("pacing_date"))
                .where(F.col("pacing_date") <= as_of))
    w = (Window.partitionBy("campaign_id").orderBy("pacing_date")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    paced = (calendar.join(daily, ["campaign_id", "pacing_date"], "left")
             .withColumn("delivered_impressions",
                         F.coalesce(F.col("delivered_impressions"), F.lit(0).cast("bigint")))
             .withColumn("cumulative_delivered", F.sum("delivered_impressions").over(w))
             .withColumn("expected_pace",
                         F.col("budget") * (inclusive_days("pacing_date", "flight_start")
                                            / inclusive_days("flight_end", "flight_start")
                                            .cast("double")))
             .withColumn("pace_index", F.col("cumulative_delivered")
                         / F.nullif(F.col("expected_pace"), F.lit(0.0)))
             .withColumn("pace_label", pace_label("pace_index")))
    return conform(paced, PACING_SCHEMA)
