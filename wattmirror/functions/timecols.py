"""Time columns. Instants are TIMESTAMP under a UTC session; wall clocks are TIMESTAMP_NTZ."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The reporting zone, the local wall-clock origin of the bucket grid, and the
# bucket names with their step in seconds (a day is a calendar day and has none).
LOCAL_TZ = "America/Los_Angeles"
BUCKET_ORIGIN = "2000-01-01 00:00:00"
BUCKET_SECONDS = {"hour": 3600, "2hour": 7200, "6hour": 21600, "day": None}

_US = 1_000_000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def instant(value: str) -> Column:
    """A literal UTC instant."""
    return F.lit(value).cast("timestamp")


def epoch_to_utc(seconds: Column | str) -> Column:
    """Epoch float seconds to an instant, keeping microseconds and NULL."""
    return F.timestamp_micros(F.round(_col(seconds) * _US).cast("bigint"))


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Elapsed seconds as a double."""
    return (F.unix_micros(_col(end)) - F.unix_micros(_col(start))) / F.lit(float(_US))


def _local_as_utc(ts: Column | str, tz: str) -> Column:
    """The local wall clock, held in a TIMESTAMP as if it were UTC."""
    return F.from_utc_timestamp(_col(ts), tz)


def local_wall(ts: Column | str, tz: str = LOCAL_TZ) -> Column:
    return _local_as_utc(ts, tz).cast("timestamp_ntz")


def local_day(ts: Column | str, tz: str = LOCAL_TZ) -> Column:
    return F.to_date(_local_as_utc(ts, tz))


def local_clock(ts: Column | str, tz: str = LOCAL_TZ) -> Column:
    """Local time of day as HH:mm:ss, which sorts like the time it names."""
    return F.date_format(_local_as_utc(ts, tz), "HH:mm:ss")


def wall_to_instant(local: Column | str, tz: str = LOCAL_TZ) -> Column:
    """Wall clock to instant; the first of two in an overlap, pre-change offset in a gap."""
    return F.to_utc_timestamp(_col(local).cast("timestamp"), tz)


def day_start(day: Column | str, tz: str = LOCAL_TZ) -> Column:
    return wall_to_instant(_col(day), tz)


def expected_hours(day: Column | str, tz: str = LOCAL_TZ) -> Column:
    """Hours in a local calendar day: 23, 24 or 25."""
    return seconds_between(day_start(day, tz), day_start(F.date_add(_col(day), 1), tz)) / 3600.0


def _origin_micros(origin: str) -> Column:
    return F.unix_micros(F.lit(origin).cast("timestamp"))


def local_bin(ts: Column | str, step_seconds: int, tz: str = LOCAL_TZ,
              origin: str = BUCKET_ORIGIN) -> Column:
    """Floor an instant's wall clock to the bucket grid counted from the origin."""
    wall = F.unix_micros(_local_as_utc(ts, tz))
    into = F.pmod(wall - _origin_micros(origin), F.lit(step_seconds * _US))
    return F.timestamp_micros(wall - into).cast("timestamp_ntz")


def bin_number(ts: Column | str, step_seconds: int, tz: str = LOCAL_TZ,
               origin: str = BUCKET_ORIGIN) -> Column:
    """Index of the grid bucket holding an instant, counted from the origin."""
    offset = F.unix_micros(_local_as_utc(ts, tz)) - _origin_micros(origin)
    step = F.lit(step_seconds * _US)
    return ((offset - F.pmod(offset, step)) / step).cast("bigint")


def bucket_label(local: Column | str, tz: str = LOCAL_TZ) -> Column:
    """ISO 8601 wall clock with the offset in force: 2024-01-01T06:00:00-08:00."""
    local = _col(local)
    as_utc = local.cast("timestamp")
    minutes = ((F.unix_seconds(as_utc) - F.unix_seconds(wall_to_instant(local, tz))) / 60).cast("int")
    return F.format_string(
        "%s%s%02d:%02d",
        F.date_format(as_utc, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(minutes < 0, "-").otherwise("+"),
        F.floor(F.abs(minutes) / 60).cast("int"),
        (F.abs(minutes) % 60).cast("int"))


def iso_utc(ts: Column | str) -> Column:
    """ISO 8601 text of an instant in UTC, NULL kept."""
    return F.date_format(_col(ts), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
