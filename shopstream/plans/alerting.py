"""Registered queries of the alert job (scaled windows, see params)."""

from __future__ import annotations

from ..operators import alerts
from ..session import pin_utc
from . import params as P
from .queries import event_logs


def q_alert_windows(spark, sf):
    pin_utc(spark)
    return alerts.window_counts(event_logs(spark, sf), P.WINDOW, P.SLIDE)


def q_alert_rule(spark, sf):
    pin_utc(spark)
    return alerts.alert_windows(event_logs(spark, sf), P.WINDOW, P.SLIDE)


def q_alert_items(spark, sf):
    pin_utc(spark)
    d = alerts.alert_details(event_logs(spark, sf), P.WINDOW, P.SLIDE)
    return alerts.as_text(d.select("mid", "window_start_ms", "window_end_ms", "uids", "item_ids"),
                          ["uids", "item_ids"])


def q_alert_events(spark, sf):
    pin_utc(spark)
    d = alerts.alert_details(event_logs(spark, sf), P.WINDOW, P.SLIDE)
    return alerts.as_text(d.select("mid", "window_start_ms", "window_end_ms", "events"), ["events"])


def q_alert_docs(spark, sf):
    pin_utc(spark)
    d = alerts.alert_details(event_logs(spark, sf), P.WINDOW, P.SLIDE)
    return alerts.as_text(alerts.alert_documents(d, P.DOC_BUCKET_MS), ["uids", "item_ids", "events"])


def q_alert_rule_panes(spark, sf):
    """The rule through the pane form (same result as alert_rule)."""
    pin_utc(spark)
    return alerts.alert_windows(event_logs(spark, sf), P.WINDOW, P.SLIDE, panes=True)
