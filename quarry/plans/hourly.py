"""

timestamp -> hour instant -> invariant check -> totals per instant ->
weekday x hour counts (pivot) -> rates per weekday and event type from ONE
grouped aggregate (no self-joins), with each type's share of its weekday.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions.rounding import rnd, rnd_sql
from quarry.operators.filters import assert_all
from quarry.operators.reshape import pivot_counts
from quarry.session import table


def hourly_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select("event_type", "value", F.date_trunc("hour", "ts").alias("instant"),
                    F.date_format("ts", "EEEE").alias("weekday_name"), F.hour("ts").alias("hour"))


def invariant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F9 on this job: every event falls in an hour 0..23 and has a value >= 0."""
    return assert_all(hourly_frame(spark, sf_dir), F.col("hour").between(0, 23) & (F.col("value") >= 0))


def weekday_hour_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1 on this job: counts per weekday (rows) x hour (columns 0..23)."""
    return pivot_counts(hourly_frame(spark, sf_dir), "weekday_name", "hour", list(range(24)))


def hourly_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = hourly_frame(spark, sf_dir)
    per = h.groupBy("weekday_name", "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total_value"),
        F.count_distinct("instant").alias("active_hours"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy("weekday_name"))
    return per.select("weekday_name", "event_type", "n", rnd("total_value", 2).alias("total_value"), "active_hours",
                      rnd(rnd("total_value", 2) / F.col("n")).alias("value_per_event"),
                      rnd(F.col("n") / F.col("active_hours")).alias("events_per_active_hour"),
                      rnd(share).alias("share_of_weekday"))


HOURLY_RATES_SQL = f"""WITH h AS (SELECT event_type, value, date_trunc('hour', ts) AS instant, dayname(ts) AS weekday_name FROM events),
    p AS (SELECT weekday_name, event_type, count(*) AS n, sum(value) AS tv, count(DISTINCT instant) AS active_hours FROM h GROUP BY 1, 2)
    SELECT weekday_name, event_type, n, {rnd_sql('tv', 2)} AS total_value, active_hours, {rnd_sql(rnd_sql('tv', 2) + ' / n')} AS value_per_event,
      {rnd_sql('n / active_hours')} AS events_per_active_hour, {rnd_sql('n / sum(n) OVER (PARTITION BY weekday_name)')} AS share_of_weekday FROM p"""
