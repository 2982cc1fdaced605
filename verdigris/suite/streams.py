"""Streaming queries: the events table read as a file stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from verdigris.session import scratch_path
from verdigris.sources import storage
from verdigris.sources.versions import Versions
from verdigris.streaming import feeds
from verdigris.suite.registry import Tables, query

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def _feed(t: Tables):
    return feeds.file_feed(t.spark, t.folder, EVENTS, pathGlobFilter="events.parquet")


@query(
    "stream_align",
    """SELECT user_id, time_bucket(INTERVAL 20 MINUTE, ts + INTERVAL 10 MINUTE) AS ts, avg(value) AS value
       FROM {events} GROUP BY ALL""",
    "value:8",
)
def _(t):
    aligned = feeds.align_feed(_feed(t), "user_id", "ts", 1200, ["value"], lateness="1 hour")
    folder = scratch_path(t.spark, "stream-align")
    return feeds.latest_updates(aligned, ["user_id", "ts"], f"{folder}/out", f"{folder}/state")


@query("stream_ingest", "SELECT event_id, ts, user_id, event_type, value, props FROM {events} WHERE ts > TIMESTAMP '2024-01-10'")
def _(t):
    folder = scratch_path(t.spark, "stream-ingest")
    feeds.append_newer(_feed(t), f"{folder}/out", "ts", f"{folder}/state", start="2024-01-10")
    return t.spark.read.parquet(f"{folder}/out").drop("run", "batch")


def _land(t: Tables, rows, folder: str, name: str) -> None:
    """Rows as files of fixed names in a landing folder; files of the same names are replaced."""
    draft = f"{folder}-draft-{name}"
    rows.repartition(4).write.mode("overwrite").parquet(draft)
    parts = [n for n in storage.names(t.spark, draft) if n.endswith(".parquet")]
    for i, part in enumerate(parts):
        storage.rename(t.spark, f"{draft}/{part}", f"{folder}/{name}-{i}.parquet")
    storage.delete(t.spark, draft)


def _days(t: Tables, first: int, last: int):
    return t("events").filter(F.dayofmonth("ts").between(first, last))


@query(
    "feed_twice",
    "SELECT event_id, ts, user_id, event_type, value, props FROM {events} WHERE ts > TIMESTAMP '2024-01-03' AND day(ts) <= 20",
)
def _(t):
    folder = scratch_path(t.spark, "feed-twice")
    landing = f"{folder}/landing"

    def run() -> None:
        feed = feeds.file_feed(t.spark, landing, EVENTS)
        feeds.append_newer(feed, f"{folder}/out", "ts", f"{folder}/state", start="2024-01-03")

    _land(t, _days(t, 1, 10), landing, "early")
    run()
    run()  # nothing new
    _land(t, _days(t, 11, 20), landing, "later")
    # older than what is stored by now: left out by the bar
    _land(t, _days(t, 5, 6), landing, "again")
    run()
    return t.spark.read.parquet(f"{folder}/out").drop("run", "batch")


@query(
    "changed_feed",
    """SELECT event_id, ts, user_id, event_type, CASE WHEN day(ts) BETWEEN 11 AND 20 THEN value * 2 ELSE value END AS value, props
       FROM {events} WHERE NOT (day(ts) BETWEEN 11 AND 20 AND event_type = 'error')""",
)
def _(t):
    folder = scratch_path(t.spark, "changed-feed")
    landing = f"{folder}/landing"
    _land(t, _days(t, 1, 10), landing, "early")
    _land(t, _days(t, 11, 20), landing, "middle")
    feeds.load_changed(t.spark, landing, EVENTS, f"{folder}/out")
    # files are written again with other rows, and others are added
    _land(t, _days(t, 11, 20).filter("event_type <> 'error'").withColumn("value", F.col("value") * 2), landing, "middle")
    _land(t, _days(t, 21, 31), landing, "late")
    feeds.load_changed(t.spark, landing, EVENTS, f"{folder}/out")
    return Versions(t.spark, f"{folder}/out/rows", [feeds.FILE]).read().drop(feeds.FILE)


@query(
    "stream_history",
    """WITH firsts AS (SELECT user_id, arg_max(event_type, ts) AS event_type, max(ts) AS ts FROM {events} WHERE day(ts) <= 15 GROUP BY user_id),
            seconds AS (SELECT user_id, arg_max(event_type, ts) AS event_type, max(ts) AS ts FROM {events} WHERE day(ts) > 15 GROUP BY user_id)
       SELECT user_id, f.event_type, f.ts, f.ts AS valid_from, s.ts AS valid_to FROM firsts f LEFT JOIN seconds s USING (user_id)
       UNION ALL SELECT user_id, event_type, ts, ts, CAST(NULL AS TIMESTAMP) FROM seconds""",
)
def _(t):
    folder = scratch_path(t.spark, "stream-history")
    landing = f"{folder}/landing"
    for name, first, last in (("first", 1, 15), ("second", 16, 31)):
        _land(t, _days(t, first, last), landing, name)
        feed = feeds.file_feed(t.spark, landing, EVENTS).select("user_id", "event_type", "ts")
        merge = feeds.change_tracker(["user_id"], "ts", f"{folder}/out")
        feeds.run_once(feed.writeStream.foreachBatch(merge), f"{folder}/state")
    return feeds.current_history(t.spark, f"{folder}/out", ["user_id"])
