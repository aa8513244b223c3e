"""Dates, run stamps and windows as columns. Sessions run in UTC; the local zone is America/Vancouver."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL = "America/Vancouver"
RESET_HOUR = 5


def local(ts: Column, zone: str = LOCAL) -> Column:
    return F.from_utc_timestamp(ts.cast("timestamp"), zone)


def fire_date(ts: Column, zone: str = LOCAL) -> Column:
    """The local date, and the one before until five in the morning."""
    return F.to_date(local(ts, zone) - F.make_dt_interval(hours=F.lit(RESET_HOUR)))


def parse_stamp(stamp: Column) -> Column:
    return F.to_timestamp(stamp, "yyyyMMdd'T'HH'Z'")


def format_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd'T'HH'Z'")


def stamp_of_cycle(cycle: Column, now: Column) -> Column:
    """The newest stamp of a cycle (hour of the day) that is not after now."""
    today = F.date_trunc("day", now) + F.make_dt_interval(hours=cycle.cast("int"))
    return format_stamp(F.when(today > now, today - F.make_dt_interval(days=F.lit(1))).otherwise(today))


def valid_header(init: Column, fhour: Column, label: str, zone: str = LOCAL) -> Column:
    """Label, local and universal time of a frame, as it is shown above it."""
    valid = init + F.make_dt_interval(hours=fhour.cast("int"))
    here = local(valid, zone)
    ahead = (F.unix_timestamp(here) - F.unix_timestamp(valid.cast("timestamp"))) / 3600
    name = F.when(ahead == -7, "PDT").when(ahead == -8, "PST").otherwise("LT") if zone == LOCAL else F.lit("LT")
    day = lambda t: F.upper(F.date_format(t, "ddMMMyyyy"))
    return F.concat(F.lit(label + "  |  "), F.date_format(here, "EEE HH:mm"), name, F.lit(" "), day(here), F.lit("  |  "), F.date_format(valid, "HH:mm"), F.lit("UTC "), day(valid))


def block_end(ts: Column, hours: int = 3) -> Column:
    """End of the right-closed block that holds ts."""
    size = hours * 3600
    return F.timestamp_seconds(F.ceil(F.unix_timestamp(ts.cast("timestamp")) / size) * size)


def lead_hours(target_date: Column, init: Column, target_hour: int = 20) -> Column:
    """Hours from init to target_hour UTC on target_date."""
    return (F.unix_timestamp(target_date.cast("timestamp")) + target_hour * 3600 - F.unix_timestamp(init.cast("timestamp"))) / 3600.0


def first_12z_hours(init: Column, hours: Column) -> Column:
    """The forecast hours of the first 12Z to 12Z window after init; null where one is not among hours."""
    ahead = F.pmod(F.lit(12) - F.hour(init), F.lit(24)).cast("int")
    wanted = F.sequence(ahead + 3, ahead + 24, F.lit(3))
    return F.when(F.size(F.array_except(wanted, hours)) == 0, wanted)


def billing_start(now: Column, day: Column) -> Column:
    """First day of the billing period that holds now; the anchor day is moved to the month's end if need be."""
    anchor = lambda d: F.make_date(F.year(d), F.month(d), F.least(day, F.day(F.last_day(d))))
    today = F.to_date(now)
    return F.when(today >= anchor(today), anchor(today)).otherwise(anchor(F.add_months(F.trunc(today, "month"), -1)))


def billing_end(now: Column, day: Column) -> Column:
    start = billing_start(now, day)
    ahead = F.add_months(F.trunc(start, "month"), 1)
    return F.make_date(F.year(ahead), F.month(ahead), F.least(day, F.day(F.last_day(ahead))))


def daylight(ts: Column, lat: Column, lon: Column, zone: str = LOCAL) -> Column:
    """Between sunrise and sunset at the cell, on the common local clock."""
    here = local(ts, zone)
    year = F.year(here)
    leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
    g = 2 * F.pi() * (F.dayofyear(here) - 1) / F.when(leap, 366.0).otherwise(365.0)
    equation = 229.18 * (0.000075 + 0.001868 * F.cos(g) - 0.032077 * F.sin(g) - 0.014615 * F.cos(2 * g) - 0.040849 * F.sin(2 * g))
    tilt = 0.006918 - 0.399912 * F.cos(g) + 0.070257 * F.sin(g) - 0.006758 * F.cos(2 * g) + 0.000907 * F.sin(2 * g) - 0.002697 * F.cos(3 * g) + 0.00148 * F.sin(3 * g)
    phi = F.radians(lat)
    cosine = F.cos(F.radians(F.lit(90.833))) / (F.cos(phi) * F.cos(tilt)) - F.tan(phi) * F.tan(tilt)
    half = F.degrees(F.acos(F.least(F.greatest(cosine, F.lit(-1.0)), F.lit(1.0))))
    offset = (F.unix_timestamp(here) - F.unix_timestamp(ts.cast("timestamp"))) / 3600.0
    rise = (720 - 4 * (lon + half) - equation) / 60.0 + offset
    sets = (720 - 4 * (lon - half) - equation) / 60.0 + offset
    h = F.hour(here) + F.minute(here) / 60.0 + F.second(here) / 3600.0
    return ((rise <= h) & (h <= sets)) | ((h < 6) & (rise <= h + 24) & (h + 24 <= sets))
