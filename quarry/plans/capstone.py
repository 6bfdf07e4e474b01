"""

The "weather" side is the daily roll-up of lineitem (T19: means per day,
any-flag), keyed by day of year; the "daylight" side is the per-day solar
dimension (T20). Events are joined to both (J3 on the day key, J7 on the
time of day), given calendar features (T16) and summarised per daylight
class and event type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.rounding import rnd, rnd_sql
from quarry.operators import daylight as DL
from quarry.operators.features import daily_rollup
from quarry.session import table

PLACE = (39.14, -77.20, -5.0)


def events_weather_daylight(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    weather = daily_rollup(li, F.to_date("l_shipdate"), ["l_quantity", "l_discount"],
                           [F.col("l_returnflag") == "R"], ["returned"])
    # one row per day of year: mean over the years of the roll-up (bounded: 366 rows)
    by_doy = weather.groupBy(F.dayofyear("day").alias("doy")).agg(
        F.avg("l_quantity").alias("w_quantity"), F.max("returned").alias("w_returned"))
    ev = DL.classify_daylight(table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value"),
                              "ts", *PLACE)
    ev = ev.withColumn("doy", F.dayofyear(F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(-300))))
    j = ev.join(F.broadcast(by_doy), "doy", "left")  # by_doy: at most 366 rows
    return j.groupBy("daylight", "event_type").agg(
        F.count(F.lit(1)).alias("n"), rnd(F.avg("value")).alias("mean_value"),
        rnd(F.avg("w_quantity"), 4).alias("mean_w_quantity"), F.max("w_returned").alias("any_returned"))


def capstone_sql() -> str:
    dims = DL.daylight_sql("CAST(lt AS DATE)", *PLACE)
    sec = "(hour(lt) * 3600 + minute(lt) * 60 + second(lt))"
    return f"""WITH w AS (SELECT CAST(l_shipdate AS DATE) AS day, round(avg(l_quantity) * 100) / 100 AS q,
        max(CAST(l_returnflag = 'R' AS INTEGER)) AS r FROM lineitem GROUP BY 1),
      d AS (SELECT dayofyear(day) AS doy, avg(q) AS w_quantity, max(r) AS w_returned FROM w GROUP BY 1),
      ev AS (SELECT event_id, event_type, value, ts - INTERVAL 300 MINUTE AS lt FROM events),
      b AS (SELECT *, {sec} AS s, {', '.join(f'{v} AS {k}' for k, v in dims.items())} FROM ev),
      c AS (SELECT event_type, value, dayofyear(lt) AS doy, CASE WHEN s < blue_am_start THEN 'night' WHEN s < golden_am_start THEN 'blue_hour'
        WHEN s < golden_am_end THEN 'golden_hour' WHEN s < golden_pm_start THEN 'day' WHEN s < blue_pm_start THEN 'golden_hour'
        WHEN s < blue_pm_end THEN 'blue_hour' ELSE 'night' END AS daylight FROM b)
      SELECT daylight, event_type, count(*) AS n, {rnd_sql('avg(value)')} AS mean_value, {rnd_sql('avg(w_quantity)', 4)} AS mean_w_quantity,
        max(w_returned) AS any_returned FROM c LEFT JOIN d USING (doy) GROUP BY 1, 2"""
