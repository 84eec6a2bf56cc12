"""Micro-fixtures for delivery, fill and pacing semantics."""

import datetime as dt

from helpers import dim_df, event, silver_df, ts
from pacewise.operators.gold import campaign_pacing, impression_delivery, inventory_fill

D = dt.date


def test_delivery_flags(spark):
    rows = [
        event("a0", "ad_request", ts(0), "req-a"), event("a1", "impression", ts(0.1), "req-a"),
        event("b0", "ad_request", ts(0), "req-b"), event("b1", "impression", ts(0.1), "req-b"),
        event("b2", "q25", ts(0.2), "req-b"), event("b3", "q50", ts(0.3), "req-b"),
    ]
    out = {r["request_id"]: (r["completed_q25"], r["completed_q50"], r["completed_q75"], r["completed_q100"])
           for r in impression_delivery(silver_df(spark, rows)).collect()}
    assert out == {"req-a": (False, False, False, False), "req-b": (True, True, False, False)}


def test_fill_by_event_hour(spark):
    base = dt.datetime(2024, 1, 10, 10, 59, 59)
    rows = [event("r", "ad_request", base, "req-x"), event("i", "impression", base + dt.timedelta(seconds=2), "req-x")]
    out = {r["event_hour"].hour: (r["requests"], r["impressions"], r["fill_rate"])
           for r in inventory_fill(silver_df(spark, rows)).collect()}
    assert out == {10: (1, 0, 0.0), 11: (0, 1, None)}


def _imp(i, day, campaign="cmp-001"):
    return event(f"i{i}-{campaign}", "impression", dt.datetime.combine(day, dt.time(12)), f"req-{i}-{campaign}",
                 campaign_id=campaign)


def test_pacing_labels_and_zero_budget(spark):
    day = D(2024, 1, 10)
    # budget 100 over a one-day flight -> expected 100.0 on that day
    rows = ([_imp(i, day, "cmp-001") for i in range(105)] + [_imp(i, day, "cmp-002") for i in range(95)]
            + [_imp(i, day, "cmp-003") for i in range(100)] + [_imp(i, day, "cmp-004") for i in range(7)])
    dim = dim_df(spark, [("cmp-001", 100, day, day), ("cmp-002", 100, day, day),
                         ("cmp-003", 100, day, day), ("cmp-004", 0, day, day)])
    out = {r["campaign_id"]: (r["pace_index"], r["pace_label"])
           for r in campaign_pacing(silver_df(spark, rows), dim).collect()}
    assert out == {"cmp-001": (1.05, "ahead"), "cmp-002": (0.95, "behind"), "cmp-003": (1.0, "on_track"),
                   "cmp-004": (None, "on_track")}


def test_pacing_calendar(spark):
    rows = [
        _imp(0, D(2024, 1, 4)),                      # before the flight: never counted
        _imp(1, D(2024, 1, 5)), _imp(2, D(2024, 1, 5)),
        _imp(3, D(2024, 1, 7)),                      # 2024-01-06 has no delivery -> 0 row
        event("q", "q100", dt.datetime(2024, 1, 8, 0, 0, 5), "req-3"),  # quartile past midnight
    ]
    dim = dim_df(spark, [("cmp-001", 100, D(2024, 1, 5), D(2024, 1, 14)),
                         ("cmp-002", 100, D(2024, 1, 9), D(2024, 1, 20))])   # starts after as_of
    out = [(r["campaign_id"], r["pacing_date"], r["delivered_impressions"], r["cumulative_delivered"])
           for r in campaign_pacing(silver_df(spark, rows), dim).orderBy("pacing_date").collect()]
    assert out == [("cmp-001", D(2024, 1, 5), 2, 2), ("cmp-001", D(2024, 1, 6), 0, 2),
                   ("cmp-001", D(2024, 1, 7), 1, 3)]   # as_of = 2024-01-07 (impressions only)
    first = campaign_pacing(silver_df(spark, rows), dim).orderBy("pacing_date").first()
    assert abs(first["expected_pace"] - 100 * 1 / 10) < 1e-12
