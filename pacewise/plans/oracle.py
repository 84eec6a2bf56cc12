"""DuckDB oracle SQL for every registered query that has a SQL equivalent.

Each statement rebuilds the fixture from the pre-registered ``events`` and ``nation`` views in
plain SQL, independently of the Spark code, and then states the query. Type notes: DuckDB
``sum`` of integers is HUGEINT, so sums are cast to BIGINT; ratios are computed in DOUBLE.
"""

from __future__ import annotations

# --- fixture: bronze, silver, dimension -----------------------------------------------------
_BRONZE = """
bronze AS (
  SELECT
    CASE WHEN e % 997 = 500 THEN NULL ELSE 'evt-' || CAST(e AS VARCHAR) || '-' || CAST(step AS VARCHAR) END AS event_id,
    step_type AS event_type,
    CASE WHEN (e + 7 * step) % 20 = 3
         THEN ts + to_seconds(off) - to_seconds(60 * (2 + e % 239))
         ELSE ts + to_seconds(off) END AS event_ts,
    'cmp-' || lpad(CAST((u + e) % 20 + 1 AS VARCHAR), 3, '0') AS campaign_id,
    'crv-' || lpad(CAST((u + e) % 60 + 1 AS VARCHAR), 3, '0') AS creative_id,
    'req-' || CAST(e AS VARCHAR) AS request_id,
    'usr-' || lpad(CAST(u AS VARCHAR), 5, '0') AS user_id,
    (['mobile', 'desktop', 'ctv'])[e % 3 + 1] AS device,
    (['US-CA', 'US-NY', 'GB-LND', 'DE-BE', 'JP-13'])[u % 5 + 1] AS geo,
    (['preroll', 'midroll', 'banner_top', 'banner_side'])[(e // 3) % 4 + 1] AS placement,
    ts + to_seconds(off) AS kafka_ts,
    ts + to_seconds(off + 5 + 60 * copy) AS ingest_ts
  FROM (SELECT event_id AS e, user_id AS u, ts FROM events) ev
  CROSS JOIN (VALUES (0, 'ad_request', 0), (1, 'impression', 1), (2, 'q25', 3),
                     (3, 'q50', 5), (4, 'q75', 7), (5, 'q100', 9)) s(step, step_type, off)
  CROSS JOIN (VALUES (0), (1)) c(copy)
  WHERE (step = 0 OR (e % 10 < 7 AND step - 1 <= (e // 10) % 5))
    AND (copy = 0 OR (e * 6 + step) % 50 = 0)
)"""

def _dedup_cte(name: str = "dedup", source: str = "bronze") -> str:
    return f"""
{name} AS (
  SELECT * FROM {source}
  WHERE event_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY event_id
                             ORDER BY ingest_ts, kafka_ts, event_ts, request_id) = 1
)"""


_DEDUP = _dedup_cte()

_SILVER = """
silver AS (
  SELECT event_id, event_type, event_ts, campaign_id, creative_id, request_id, user_id,
         device, geo, placement
  FROM dedup
)"""

_DIM = """
dim_campaign AS (
  SELECT campaign_id, budget, flight_start, flight_end,
         round(CAST(budget AS DOUBLE) / (flight_end - flight_start), 2) AS daily_budget,
         target_geo, target_device
  FROM (
    SELECT 'cmp-' || lpad(CAST(n_nationkey + 1 AS VARCHAR), 3, '0') AS campaign_id,
           CAST(CASE WHEN n_nationkey = 19 THEN 0 ELSE 130 + 10 * n_nationkey END AS BIGINT) AS budget,
           CAST(DATE '2024-01-03' + CAST(n_nationkey % 10 AS INTEGER) AS DATE) AS flight_start,
           CAST(DATE '2024-01-20' + CAST(n_nationkey % 12 AS INTEGER) AS DATE) AS flight_end,
           (['US-CA', 'US-NY', 'GB-LND', 'DE-BE', 'JP-13'])[n_nationkey % 5 + 1] AS target_geo,
           (['mobile', 'desktop', 'ctv'])[n_nationkey % 3 + 1] AS target_device
    FROM nation WHERE n_nationkey < 20)
)"""

# --- gold ------------------------------------------------------------------------------------
_DELIVERY = """
quartile_flags AS (
  SELECT request_id,
         bool_or(event_type = 'q25') AS f25, bool_or(event_type = 'q50') AS f50,
         bool_or(event_type = 'q75') AS f75, bool_or(event_type = 'q100') AS f100
  FROM silver WHERE event_type IN ('q25', 'q50', 'q75', 'q100')
  GROUP BY request_id
),
delivery AS (
  SELECT imp.request_id, imp.event_ts AS impression_ts, imp.campaign_id, imp.creative_id,
         imp.user_id, imp.device, imp.geo, imp.placement,
         coalesce(qf.f25, false) AS completed_q25, coalesce(qf.f50, false) AS completed_q50,
         coalesce(qf.f75, false) AS completed_q75, coalesce(qf.f100, false) AS completed_q100
  FROM (SELECT DISTINCT request_id, event_ts, campaign_id, creative_id, user_id, device, geo, placement
        FROM silver WHERE event_type = 'impression') imp
  LEFT JOIN quartile_flags qf ON qf.request_id = imp.request_id
)"""

_FILL = """
fill AS (
  SELECT campaign_id, placement, event_hour, requests, impressions,
         CAST(impressions AS DOUBLE) / nullif(CAST(requests AS DOUBLE), 0) AS fill_rate
  FROM (
    SELECT campaign_id, placement, date_trunc('hour', event_ts) AS event_hour,
           count(*) FILTER (WHERE event_type = 'ad_request') AS requests,
           count(*) FILTER (WHERE event_type = 'impression') AS impressions
    FROM silver
    WHERE event_type IN ('ad_request', 'impression')
    GROUP BY ALL)
)"""

# Every flight day counts the impressions of its campaign since flight start by itself.
_PACING = """
pacing AS (
  SELECT campaign_id, pacing_date, delivered_impressions, cumulative_delivered, budget, expected_pace, pace_index,
         if(pace_index >= 1.05, 'ahead', if(pace_index <= 0.95, 'behind', 'on_track')) AS pace_label
  FROM (
    SELECT f.campaign_id, f.pacing_date, f.budget,
           count(*) FILTER (WHERE CAST(s.event_ts AS DATE) = f.pacing_date) AS delivered_impressions,
           count(s.event_id) AS cumulative_delivered,
           f.budget * ((f.pacing_date - f.flight_start + 1) / (f.flight_end - f.flight_start + 1)) AS expected_pace,
           count(s.event_id) / nullif(f.budget * ((f.pacing_date - f.flight_start + 1)
                                                  / (f.flight_end - f.flight_start + 1)), 0) AS pace_index
    FROM (SELECT campaign_id, budget, flight_start, flight_end,
                 flight_start + CAST(unnest(range(0, CAST(flight_end - flight_start + 1 AS BIGINT))) AS INTEGER) AS pacing_date
          FROM dim_campaign) f
    LEFT JOIN silver s ON s.campaign_id = f.campaign_id AND s.event_type = 'impression'
                      AND CAST(s.event_ts AS DATE) BETWEEN f.flight_start AND f.pacing_date
    WHERE f.pacing_date <= (SELECT CAST(max(event_ts) AS DATE) FROM silver WHERE event_type = 'impression')
    GROUP BY f.campaign_id, f.pacing_date, f.budget, f.flight_start, f.flight_end)
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


BASE = (_BRONZE, _DEDUP, _SILVER)
GOLD = (*BASE, _DIM, _DELIVERY, _FILL, _PACING)


def _q(body: str, *ctes: str) -> str:
    return with_ctes(*(ctes or GOLD)) + body


ORACLE: dict[str, str] = {
    "bronze_smoke": _q("""SELECT count(*) AS rows, count(DISTINCT event_id) AS distinct_ids,
       count(DISTINCT user_id) AS distinct_users FROM bronze""", _BRONZE),
    "silver_fact_event": _q("SELECT * FROM silver", *BASE),
    "dim_campaign": _q("SELECT * FROM dim_campaign", _DIM),
    "gold_delivery": _q("SELECT * FROM delivery", *BASE, _DELIVERY),
    "gold_fill": _q("SELECT * FROM fill", *BASE, _FILL),
    "gold_pacing": _q("""SELECT campaign_id, pacing_date, delivered_impressions, cumulative_delivered,
       budget, expected_pace, pace_index, pace_label FROM pacing""", *BASE, _DIM, _PACING),
    "gold_pacing_from_fill": _q("""SELECT campaign_id, pacing_date, delivered_impressions, cumulative_delivered,
       budget, expected_pace, pace_index, pace_label FROM pacing""", *BASE, _DIM, _PACING),
    "pacing_leaderboard": _q("""SELECT campaign_id, pacing_date, cumulative_delivered,
       round(expected_pace, 1) AS expected, round(pace_index, 3) AS pace_index, pace_label
FROM (SELECT *, max(pacing_date) OVER (PARTITION BY campaign_id) AS last_day FROM pacing)
WHERE pacing_date = last_day
ORDER BY pace_index DESC NULLS LAST, campaign_id""", *BASE, _DIM, _PACING),
    "fill_by_placement": _q("""SELECT placement, requests, impressions,
       round(CAST(impressions AS DOUBLE) / nullif(CAST(requests AS DOUBLE), 0), 3) AS fill_rate
FROM (SELECT placement, CAST(sum(requests) AS BIGINT) AS requests,
             CAST(sum(impressions) AS BIGINT) AS impressions
      FROM fill GROUP BY placement)
ORDER BY fill_rate DESC NULLS LAST, placement""", *BASE, _FILL),
    "completion_funnel": _q("""SELECT count(*) AS impressions,
       round(avg(CASE WHEN completed_q25 THEN 1 ELSE 0 END), 3) AS q25_rate,
       round(avg(CASE WHEN completed_q50 THEN 1 ELSE 0 END), 3) AS q50_rate,
       round(avg(CASE WHEN completed_q75 THEN 1 ELSE 0 END), 3) AS q75_rate,
       round(avg(CASE WHEN completed_q100 THEN 1 ELSE 0 END), 3) AS q100_rate
FROM delivery""", *BASE, _DELIVERY),
    "silver_checks": _q("""SELECT a.events, a.distinct_events, b.campaigns, c.joinable_events
FROM (SELECT count(*) AS events, count(DISTINCT event_id) AS distinct_events FROM silver) a,
     (SELECT count(*) AS campaigns FROM dim_campaign) b,
     (SELECT count(*) AS joinable_events FROM silver JOIN dim_campaign USING (campaign_id)) c""",
                        *BASE, _DIM),
    "top_user": _q("""SELECT user_id, count(*) AS events FROM silver GROUP BY user_id
ORDER BY count(*) DESC, user_id LIMIT 1""", *BASE),
    "amplified_events": _q("""SELECT s.event_id || '-' || CAST(r.rep AS VARCHAR) AS event_id, s.event_type,
       s.event_ts, s.campaign_id, s.creative_id, s.request_id, s.user_id, s.device, s.geo, s.placement
FROM silver s CROSS JOIN (SELECT unnest(range(0, 10)) AS rep) r""", *BASE),
    "orphan_impressions": _q("""SELECT count(*) AS orphan_impressions
FROM (SELECT request_id FROM silver WHERE event_type = 'impression') i
ANTI JOIN (SELECT DISTINCT request_id FROM silver WHERE event_type = 'ad_request') r USING (request_id)""",
                             *BASE),
    "unjoined_events": _q("""SELECT count(*) AS unjoined_events
FROM silver f ANTI JOIN dim_campaign d USING (campaign_id)""", *BASE, _DIM),
    "nesting_violations": _q("""SELECT count(*) FILTER (
         WHERE (NOT completed_q25 AND completed_q50) OR (NOT completed_q50 AND completed_q75)
            OR (NOT completed_q75 AND completed_q100)) AS nesting_violations
FROM delivery""", *BASE, _DELIVERY),
    "negative_fill": _q("""SELECT count(*) FILTER (WHERE fill_rate < 0) AS negative_fill FROM fill""",
                        *BASE, _FILL),
    "pacing_deltas": _q("""SELECT campaign_id, pacing_date, cumulative_delivered,
       cumulative_delivered - lag(cumulative_delivered) OVER w AS delta
FROM pacing WINDOW w AS (PARTITION BY campaign_id ORDER BY pacing_date)""", *BASE, _DIM, _PACING),
    "label_counts": _q("""SELECT pace_label, count(*) AS campaign_days,
       CAST(sum(cumulative_delivered) AS BIGINT) AS cumulative_total
FROM pacing GROUP BY pace_label""", *BASE, _DIM, _PACING),
    "late_events_by_day": _q("""SELECT CAST(event_ts AS DATE) AS event_date, count(*) AS events,
       CAST(sum(CASE WHEN ingest_ts - event_ts > INTERVAL 60 SECOND THEN 1 ELSE 0 END) AS BIGINT) AS late_events
FROM dedup GROUP BY CAST(event_ts AS DATE)""", _BRONZE, _DEDUP),
}


# --- side-effect jobs -----------------------------------------------------------------------------
_AMP = """
amp AS (
  SELECT s.event_id || '-' || CAST(r.rep AS VARCHAR) AS event_id, s.event_type, s.event_ts,
         s.campaign_id, s.creative_id, s.request_id, s.user_id, s.device, s.geo, s.placement
  FROM silver s CROSS JOIN (SELECT unnest(range(0, 10)) AS rep) r
)"""

# The erased user: most silver events, ties by user_id; bronze without that user feeds the rest.
_BRONZE_ALL = _BRONZE.replace("bronze AS (", "bronze_all AS (", 1)
_DEDUP_ALL = _dedup_cte("dedup_all", "bronze_all")
_FORGET = """
forgotten AS (
  SELECT user_id FROM dedup_all GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 1
),
bronze AS (
  SELECT * FROM bronze_all WHERE user_id IS DISTINCT FROM (SELECT user_id FROM forgotten)
)"""
FORGET = (_BRONZE_ALL, _DEDUP_ALL, _FORGET, _DEDUP, _SILVER)

ORACLE.update({
    "user_filtered_scan": _q("""SELECT user_id, count(*) AS events FROM amp
WHERE user_id = (SELECT user_id FROM amp GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 1)
GROUP BY user_id""", *BASE, _AMP),
    "date_range_scan": _q("""SELECT (SELECT min(CAST(event_ts AS DATE)) FROM amp) AS first_day,
  (SELECT count(*) FROM amp
   WHERE event_ts >= CAST((SELECT min(CAST(event_ts AS DATE)) FROM amp) AS TIMESTAMP)
     AND event_ts < CAST((SELECT min(CAST(event_ts AS DATE)) FROM amp) AS TIMESTAMP) + INTERVAL 2 DAY) AS events""",
                          *BASE, _AMP),
    "campaign_rollup": _q("""SELECT campaign_id, count(*) AS impressions FROM amp
WHERE event_type = 'impression' GROUP BY campaign_id""", *BASE, _AMP),
    "forget_user_bronze": _q("SELECT * FROM bronze", *FORGET),
    "forget_user_silver": _q("SELECT * FROM silver", *FORGET),
    "forget_user_delivery": _q("SELECT * FROM delivery", *FORGET, _DELIVERY),
    "forget_user_fill": _q("SELECT * FROM fill", *FORGET, _FILL),
    "forget_user_pacing": _q("""SELECT campaign_id, pacing_date, delivered_impressions, cumulative_delivered,
       budget, expected_pace, pace_index, pace_label FROM pacing""", *FORGET, _DIM, _PACING),
    "erasure_log": _q("""SELECT user_id, 'bronze,silver,delivery,fill,pacing' AS tables FROM forgotten""",
                      _BRONZE_ALL, _DEDUP_ALL, _FORGET),
    "dim_campaign_landed": _q("SELECT * FROM dim_campaign", _DIM),
    "tombstone_read": _q("""SELECT * FROM silver WHERE user_id IS DISTINCT FROM
  (SELECT user_id FROM silver GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 1)""", *BASE),
    "stream_bronze": _q("SELECT * EXCLUDE (ingest_ts) FROM bronze", _BRONZE),
    "stream_fact_event": _q("SELECT * FROM silver", *BASE),
    "compacted_silver": _q("SELECT * FROM silver", *BASE),
    "compacted_bronze": _q("SELECT * FROM bronze", _BRONZE),
    "reconciled_silver": _q("SELECT * FROM silver", *FORGET),
    "incremental_silver": _q("SELECT * FROM silver", *BASE),
    "stream_broken_bronze": _q("SELECT if(event_id IS NULL, NULL, COLUMNS(* EXCLUDE (kafka_ts, ingest_ts))), kafka_ts FROM bronze", _BRONZE),
    "stream_binary_bronze": _q("SELECT * EXCLUDE (ingest_ts), true AS ingested_now FROM bronze", _BRONZE),
    "forced_files": _q("SELECT CAST(500 AS BIGINT) AS files, count(*) AS rows, true AS sizes_add_up FROM amp", *BASE, _AMP),
    "refusals": _q("""SELECT c AS refused_for, true AS refused, (SELECT count(*) FROM silver) AS rows_left
FROM (VALUES ('another name'), ('another type'), ('a missing column'), ('a quote'), ('a line end'), ('an empty id')) v(c)""", *BASE),
    "named_rollup": _q("""SELECT d.campaign_id, d.budget, CAST(s.event_ts AS DATE) AS event_date, count(*) AS impressions
FROM silver s JOIN dim_campaign d USING (campaign_id)
WHERE s.event_type = 'impression' AND CAST(s.event_ts AS DATE) BETWEEN d.flight_start AND d.flight_end
GROUP BY ALL""", *BASE, _DIM),
    "scan_savings": """SELECT q AS query, l AS layout, true AS reads_less_than_everything, true AS gains_by_layout,
       (SELECT count(*) FROM events) > 0 AS reads_something
FROM (VALUES ('user-filtered scan'), ('date-range scan'), ('campaign rollup')) a(q) CROSS JOIN (VALUES ('bad'), ('optimized')) b(l)""",
    "layouts_agree": _q("""SELECT count(*) AS bad_rows, count(*) AS optimized_rows, true AS fewer_files,
       true AS user_query_reads_less FROM amp""", *BASE, _AMP),
    "delete_ratio": _q("""SELECT user_id, count(*) AS deleted_bucketed, count(*) AS deleted_unbucketed, true AS over_floor
FROM silver GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 1""", *BASE),
    "deferred_erasure": _q("""SELECT user_id, CAST(0 AS BIGINT) AS readable_rows, count(*) AS stored_rows, true AS files_unchanged
FROM silver GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 1""", *BASE),
    "delivery_matches_impressions": _q("""SELECT (SELECT count(*) FROM delivery) AS delivery_rows,
       (SELECT count(*) FROM silver WHERE event_type = 'impression') AS impressions""", *BASE, _DELIVERY),
})


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
