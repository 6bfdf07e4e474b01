
from __future__ import annotations

from quarry.catalog.registry import query
from quarry.plans import capstone, census, hourly

query("census_flow")(census.census_flow)
query("hourly_rates", hourly.HOURLY_RATES_SQL)(hourly.hourly_rates)
query("hourly_invariant", """SELECT bool_and(hour(ts) BETWEEN 0 AND 23 AND value >= 0) AS holds,
    count(*) FILTER (WHERE NOT (hour(ts) BETWEEN 0 AND 23 AND value >= 0)) AS violations FROM events""")(hourly.invariant)
query("hourly_weekday_pivot", "SELECT dayname(ts) AS weekday_name, " + ", ".join(
    f"count(*) FILTER (WHERE hour(ts) = {h}) AS \"{h}\"" for h in range(24)) + " FROM events GROUP BY 1")(
    hourly.weekday_hour_counts)
query("events_weather_daylight", capstone.capstone_sql())(capstone.events_weather_daylight)
