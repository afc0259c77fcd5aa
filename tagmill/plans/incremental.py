"""Queries on caches and logs that grow; streaming forms are tested for equality with these."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagmill.functions.columns import rounded
from tagmill.functions.working import places_within
from tagmill.plans.registry import query
from tagmill.sources.tables import Tables
from tagmill.streaming import incremental


@query("SELECT user_id, event_type, count(*) AS n FROM events WHERE event_id % 2 = 1 AND (user_id, event_type) NOT IN (SELECT (user_id, event_type) FROM events WHERE event_id % 2 = 0 AND user_id % 3 = 0) GROUP BY 1, 2")
def cache_unseen(t: Tables) -> DataFrame:
    """Keys of the second half of a log that a cache of part of the first half lacks."""
    e = t.raw("events")
    cache = e.where("event_id % 2 = 0 AND user_id % 3 = 0").select("user_id", "event_type").distinct()
    log = e.where("event_id % 2 = 1").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return incremental.unseen(log, cache, ["user_id", "event_type"])


@query("SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n, round_even(avg(value), 6) AS mean FROM events GROUP BY 1, 2")
def event_windows(t: Tables) -> DataFrame:
    """Hourly counts and means of a log."""
    return t.raw("events").groupBy(F.date_trunc("hour", "ts").alias("hour"), "event_type").agg(F.count("*").alias("n"), rounded(F.avg("value")).alias("mean"))


@query("SELECT user_id, count(*) AS n_rows, max(event_id) AS last_id FROM events GROUP BY 1 HAVING count(*) >= 10")
def log_progress(t: Tables) -> DataFrame:
    """Progress of each key in a log, of keys that have come far enough."""
    return t.raw("events").groupBy("user_id").agg(F.count("*").alias("n_rows"), F.max("event_id").alias("last_id")).where("n_rows >= 10")


@query("SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY value DESC NULLS LAST, event_id) AS place FROM events")
def place_in_type(t: Tables) -> DataFrame:
    """The place of each event among all of its type, of which there are few: by ranges, so no type is one task's."""
    e = t.raw("events").select("event_id", "event_type", "value")
    return places_within(e, ["event_type"], [F.desc("value"), F.col("event_id")], "place").drop("value")
