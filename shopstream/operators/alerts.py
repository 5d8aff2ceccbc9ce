"""Coupon-abuse alerts over sliding windows.

Rule: within a window, a device (mid) where at least ``min_uids`` distinct
users took a coupon and nobody clicked an item raises an alert. The alert
document carries the coupon users, the coupon item ids and the list of all
event ids of the window, and is upserted under ``mid + "_" + minute`` so the
many overlapping windows of one minute give one document (last one wins).

Plan, in two passes so the expensive part only runs where it is needed:

1. ``window_stats``: expand each event into its windows (``F.window``) and
   aggregate per (mid, window) only bounded values: an exact
   ``count(distinct coupon uid)`` (Spark pre-aggregates by (mid, window,
   uid), spreading a hot device across tasks) and ``bool_or(click)``.
2. ``alert_details``: join the alerting windows' panes with the events on
   (mid, pane) and build the sets and the ordered event list there.

Windows are [start, end) aligned to the epoch (the reference's batches cover
(T-5min, T]).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import columns as X
from . import dedupe


def _coupon(ev: str = "eventId") -> Column:
    return F.col(ev) == F.lit(C.COUPON)


def _click(ev: str = "eventId") -> Column:
    return F.col(ev) == F.lit(C.CLICK_ITEM)


def windowed(events: DataFrame, window: str = C.ALERT_WINDOW, slide: str = C.ALERT_SLIDE,
             time_col: str = "event_time") -> DataFrame:
    """One row per (event, window containing it) with window_start/end as
    epoch ms (W2)."""
    w = F.window(F.col(time_col), window, slide)
    return events.select("*", w.alias("_w")).select(
        *events.columns, F.unix_millis(F.col("_w.start")).alias("window_start_ms"),
        F.unix_millis(F.col("_w.end")).alias("window_end_ms"))


def _coupon_uid(count_null_uid: bool) -> Column:
    uid = F.coalesce(F.col("uid"), F.lit("\u0000")) if count_null_uid else F.col("uid")
    return F.when(_coupon(), uid)


def window_counts(events: DataFrame, window: str = C.ALERT_WINDOW,
                  slide: str = C.ALERT_SLIDE) -> DataFrame:
    """Events per (mid, window) (W2 alone)."""
    return (windowed(events, window, slide)
            .groupBy("mid", "window_start_ms", "window_end_ms")
            .agg(F.count(F.lit(1)).alias("n_events")))


def window_stats(events: DataFrame, window: str = C.ALERT_WINDOW, slide: str = C.ALERT_SLIDE,
                 count_null_uid: bool = False) -> DataFrame:
    """Per (mid, window): distinct coupon users (A3, A7) and whether any
    item was clicked (A6, F3). ``count_null_uid`` reproduces the reference
    counting a null uid as one user (Q11)."""
    return (windowed(events, window, slide)
            .groupBy("mid", "window_start_ms", "window_end_ms")
            .agg(F.count_distinct(_coupon_uid(count_null_uid)).alias("n_uids"),
                 F.bool_or(_click()).alias("clicked")))


def _interval_ms(spec: str) -> int:
    n, unit = spec.split()
    return int(n) * {"second": 1000, "seconds": 1000, "minute": 60_000, "minutes": 60_000,
                     "hour": 3_600_000, "hours": 3_600_000}[unit]


def window_stats_panes(events: DataFrame, window: str = C.ALERT_WINDOW, slide: str = C.ALERT_SLIDE,
                       count_null_uid: bool = False, time_col: str = "event_time") -> DataFrame:
    """Same result as ``window_stats``, computed from slide-sized panes.

    Events are first reduced to one row per (mid, pane, coupon uid) with the
    pane's click flag (map-side combined), and only those rows are copied into
    the window/slide windows that contain the pane. When devices send many
    events per pane (the reference's 5-s slide copies each event into 60
    windows) the copies shrink from one per event to one per distinct user."""
    w_ms, s_ms = _interval_ms(window), _interval_ms(slide)
    if w_ms % s_ms:
        raise ValueError("pane form needs the window to be a multiple of the slide")
    pane = F.window(F.col(time_col), slide)
    panes = (events.groupBy("mid", F.unix_millis(pane.start).alias("pane_ms"),
                            _coupon_uid(count_null_uid).alias("coupon_uid"))
                   .agg(F.bool_or(_click()).alias("clicked")))
    starts = F.sequence(F.col("pane_ms") - F.lit(w_ms - s_ms), F.col("pane_ms"), F.lit(s_ms))
    per_window = panes.select("mid", "coupon_uid", "clicked", F.explode(starts).alias("window_start_ms"))
    return (per_window.groupBy("mid", "window_start_ms")
            .agg(F.count_distinct("coupon_uid").alias("n_uids"), F.bool_or("clicked").alias("clicked"))
            .withColumn("window_end_ms", F.col("window_start_ms") + F.lit(w_ms))
            .select("mid", "window_start_ms", "window_end_ms", "n_uids", "clicked"))


def alert_windows(events: DataFrame, window: str = C.ALERT_WINDOW, slide: str = C.ALERT_SLIDE,
                  min_uids: int = C.ALERT_MIN_UIDS, count_null_uid: bool = False,
                  panes: bool = False) -> DataFrame:
    """(mid, window) pairs that raise an alert (F2): no click, >= min_uids.
    ``panes=True`` computes the same pairs through the pane form."""
    stats = window_stats_panes if panes else window_stats
    s = stats(events, window, slide, count_null_uid)
    return (s.filter(~F.col("clicked") & (F.col("n_uids") >= min_uids))
             .select("mid", "window_start_ms", "window_end_ms", "n_uids"))


def details_of(hits: DataFrame, events: DataFrame, window: str = C.ALERT_WINDOW, slide: str = C.ALERT_SLIDE,
               time_col: str = "event_time") -> DataFrame:
    """The coupon users, coupon items (A4) and time-ordered event ids (A5) of
    alerting windows ``hits``. A window is a row of panes, so events meet the
    windows by (device, pane): events of other panes are not copied at all. A
    window that is no multiple of the slide is looked up by its copies."""
    w_ms, s_ms = _interval_ms(window), _interval_ms(slide)
    if w_ms % s_ms:
        w = windowed(events, window, slide, time_col).join(
            hits.select("mid", "window_start_ms"), ["mid", "window_start_ms"], "left_semi")
    else:
        last = F.col("window_start_ms") + F.lit(w_ms - s_ms)
        panes = hits.select("mid", "window_start_ms", "window_end_ms",
                            F.explode(F.sequence("window_start_ms", last, F.lit(s_ms))).alias("pane_ms"))
        pane = F.window(F.col(time_col), slide)
        w = events.withColumn("pane_ms", F.unix_millis(pane.start)).join(panes, ["mid", "pane_ms"])
    ordered = F.array_sort(F.collect_list(F.struct("ts", "eventId", "uid", "itemId")))
    return (w.groupBy("mid", "window_start_ms", "window_end_ms")
             .agg(F.array_sort(F.collect_set(F.when(_coupon(), F.col("uid")))).alias("uids"),
                  F.array_sort(F.collect_set(F.when(_coupon(), F.col("itemId")))).alias("item_ids"),
                  F.transform(ordered, lambda e: e["eventId"]).alias("events")))


def alert_details(events: DataFrame, window: str = C.ALERT_WINDOW, slide: str = C.ALERT_SLIDE,
                  min_uids: int = C.ALERT_MIN_UIDS, count_null_uid: bool = False,
                  panes: bool = False) -> DataFrame:
    """Alerting windows with their details."""
    return details_of(alert_windows(events, window, slide, min_uids, count_null_uid, panes), events, window, slide)


def pane_state(events: DataFrame, window: str = C.ALERT_WINDOW, slide: str = C.ALERT_SLIDE,
               delay: str = "10 seconds") -> DataFrame:
    """W2 as two chained streaming aggregations: one state row per (device,
    pane, coupon user), then per (device, window) the users and the click flag
    of its panes. Append mode gives each window once, when the watermark passes
    its end; no event list is held in state."""
    if _interval_ms(window) % _interval_ms(slide):
        raise ValueError("pane form needs the window to be a multiple of the slide")
    panes = (events.withWatermark("event_time", delay)
             .groupBy("mid", F.window("event_time", slide).alias("pane"), F.when(_coupon(), F.col("uid")).alias("uid"))
             .agg(F.bool_or(_click()).alias("clicked")))
    g = (panes.groupBy("mid", F.window(F.window_time("pane"), window, slide).alias("w"))
         .agg(F.collect_set("uid").alias("uids"), F.bool_or("clicked").alias("clicked")))
    return g.select("mid", F.unix_millis("w.start").alias("window_start_ms"),
                    F.unix_millis("w.end").alias("window_end_ms"), F.size("uids").alias("n_uids"), "clicked")


def alert_documents(details: DataFrame, bucket_ms: int = C.ALERT_DOC_BUCKET_MS) -> DataFrame:
    """One document per (mid, time bucket of the window end), the last
    window winning (W8, A13, P17). ``ts`` is the window end, not wall time."""
    docs = details.select(X.doc_id("mid", "window_end_ms", bucket_ms).alias("doc_id"), "mid",
                          "uids", "item_ids", "events", F.col("window_end_ms").alias("ts"))
    return dedupe.latest_per_key(docs, ["doc_id"], ["ts"])


def as_text(df: DataFrame, cols: list[str]) -> DataFrame:
    """Arrays -> comma-joined text (for comparisons and flat sinks)."""
    for c in cols:
        df = df.withColumn(c, F.array_join(F.col(c), ","))
    return df
