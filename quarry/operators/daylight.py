"""Daylight dimension from published low-precision solar equations.

For every distinct calendar date (a bounded dimension: one row per day) the
times at which the sun crosses given elevations are computed with native
Column maths: fractional year, equation of time and declination (the NOAA
general solar position approximations), then the hour angle of the wanted
elevation. Events are then classified by an equi-join on the date (J7).

Fixed values (published approximation coefficients, NOAA "General Solar
Position Calculations"):
  equation of time (minutes) = 229.18 * (0.000075 + 0.001868 cos g - 0.032077 sin g
                                         - 0.014615 cos 2g - 0.040849 sin 2g)
  declination (rad) = 0.006918 - 0.399912 cos g + 0.070257 sin g - 0.006758 cos 2g
                      + 0.000907 sin 2g - 0.002697 cos 3g + 0.00148 sin 3g
  g = 2 pi / 365 * (day_of_year - 1)         (evaluated at noon)
Elevations used: blue hour from -6 to -4 degrees, golden hour from -4 to 6 degrees.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLUE_LOW, BLUE_HIGH, GOLDEN_HIGH = -6.0, -4.0, 6.0
# boundary columns in the order they occur during a day, with the label of the
# span that ends at each boundary
BOUNDARIES = [
    ("blue_am_start", "night"),
    ("golden_am_start", "blue_hour"),
    ("golden_am_end", "golden_hour"),
    ("golden_pm_start", "day"),
    ("blue_pm_start", "golden_hour"),
    ("blue_pm_end", "blue_hour"),
]


def _solar_terms(day: Column) -> tuple[Column, Column]:
    g = F.lit(2 * math.pi / 365.0) * (F.dayofyear(day) - 1)
    eqtime = F.lit(229.18) * (
        F.lit(0.000075) + F.lit(0.001868) * F.cos(g) - F.lit(0.032077) * F.sin(g)
        - F.lit(0.014615) * F.cos(2 * g) - F.lit(0.040849) * F.sin(2 * g)
    )
    decl = (F.lit(0.006918) - F.lit(0.399912) * F.cos(g) + F.lit(0.070257) * F.sin(g)
            - F.lit(0.006758) * F.cos(2 * g) + F.lit(0.000907) * F.sin(2 * g)
            - F.lit(0.002697) * F.cos(3 * g) + F.lit(0.00148) * F.sin(3 * g))
    return eqtime, decl


def _crossing(eqtime: Column, decl: Column, lat: float, lon: float, utc_offset_h: float,
              elevation: float, morning: bool) -> Column:
    """Local seconds of day when the sun is at ``elevation`` (NULL if it never is)."""
    zen = math.radians(90.0 - elevation)
    latr = math.radians(lat)
    arg = (F.lit(math.cos(zen)) / (F.lit(math.cos(latr)) * F.cos(decl))) - F.lit(math.tan(latr)) * F.tan(decl)
    ha = F.degrees(F.acos(F.when(F.abs(arg) <= 1, arg)))
    sign = 1.0 if morning else -1.0
    minutes_utc = F.lit(720.0) - F.lit(4.0) * (F.lit(lon) + F.lit(sign) * ha) - eqtime
    return F.floor((minutes_utc + F.lit(60.0 * utc_offset_h)) * 60.0).cast("int")


def boundary_columns(day: Column, lat: float, lon: float, utc_offset_h: float) -> dict[str, Column]:
    """The six boundary times (local seconds of day) as expressions of the date."""
    eqtime, decl = _solar_terms(day)
    sides = {
        "blue_am_start": (BLUE_LOW, True), "golden_am_start": (BLUE_HIGH, True), "golden_am_end": (GOLDEN_HIGH, True),
        "golden_pm_start": (GOLDEN_HIGH, False), "blue_pm_start": (BLUE_HIGH, False), "blue_pm_end": (BLUE_LOW, False),
    }
    return {name: _crossing(eqtime, decl, lat, lon, utc_offset_h, elev, am) for name, (elev, am) in sides.items()}


def daylight_dimension(dates: DataFrame, date_col: str, lat: float, lon: float, utc_offset_h: float) -> DataFrame:
    """One row per distinct date with the six boundary times (local seconds of day)."""
    d = dates.select(F.col(date_col).alias("day")).distinct()
    return d.withColumns(boundary_columns(F.col("day"), lat, lon, utc_offset_h))


def daylight_sql(date_expr: str, lat: float, lon: float, utc_offset_h: float) -> dict[str, str]:
    """DuckDB twins of the boundary columns for a date expression."""
    g = f"(2 * pi() / 365.0 * (dayofyear({date_expr}) - 1))"
    eq = (f"(229.18 * (0.000075 + 0.001868 * cos({g}) - 0.032077 * sin({g}) - 0.014615 * cos(2 * {g})"
          f" - 0.040849 * sin(2 * {g})))")
    decl = (f"(0.006918 - 0.399912 * cos({g}) + 0.070257 * sin({g}) - 0.006758 * cos(2 * {g})"
            f" + 0.000907 * sin(2 * {g}) - 0.002697 * cos(3 * {g}) + 0.00148 * sin(3 * {g}))")
    latr = math.radians(lat)

    def cross(elev: float, morning: bool) -> str:
        zen = math.radians(90.0 - elev)
        arg = f"({math.cos(zen)!r} / ({math.cos(latr)!r} * cos({decl})) - {math.tan(latr)!r} * tan({decl}))"
        ha = f"degrees(acos(CASE WHEN abs({arg}) <= 1 THEN {arg} END))"
        sign = "+" if morning else "-"
        mins = f"(720.0 - 4.0 * ({lon!r} {sign} {ha}) - {eq})"
        return f"CAST(floor(({mins} + {60.0 * utc_offset_h!r}) * 60.0) AS INTEGER)"

    return {
        "blue_am_start": cross(BLUE_LOW, True), "golden_am_start": cross(BLUE_HIGH, True),
        "golden_am_end": cross(GOLDEN_HIGH, True), "golden_pm_start": cross(GOLDEN_HIGH, False),
        "blue_pm_start": cross(BLUE_HIGH, False), "blue_pm_end": cross(BLUE_LOW, False),
    }


def classify_daylight(events: DataFrame, ts_col: str, lat: float, lon: float, utc_offset_h: float,
                      name: str = "daylight") -> DataFrame:
    """Label each event night / blue_hour / golden_hour / day.

    The boundaries are functions of the event's own date, so this is a
    projection: no dimension table, no join, also on a stream. A NULL
    timestamp has a NULL label.
    """
    local = F.col(ts_col) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(int(round(utc_offset_h * 60))))
    sec = F.hour("__local") * 3600 + F.minute("__local") * 60 + F.floor(F.second("__local")).cast("int")
    ev = events.withColumn("__local", local).withColumns({"__day": F.to_date("__local"), "__sec": sec})
    bounds = boundary_columns(F.col("__day"), lat, lon, utc_offset_h)
    label = F.when(F.col("__sec").isNull(), F.lit(None))
    for bound, before in BOUNDARIES:
        label = label.when(F.col("__sec") < bounds[bound], F.lit(before))
    return ev.withColumn(name, label.otherwise("night")).drop("__local", "__day", "__sec")
