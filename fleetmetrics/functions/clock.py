"""Zone-free timestamp arithmetic and window assignment."""

from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F


def ntz(moment: datetime) -> Column:
    """A naive datetime as a TIMESTAMP_NTZ literal."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def minutes(count: int) -> Column:
    return F.make_dt_interval(mins=F.lit(count))


def site_now(zone: str) -> datetime:
    """The site's wall clock, for callers that drive a job from real time."""
    return datetime.now(ZoneInfo(zone)).replace(tzinfo=None)


def to_site_time(ts: Column, zone: str, source_zone: str = "UTC") -> Column:
    """Move a zone-free timestamp from ``source_zone`` to the site's zone."""
    return F.convert_timezone(F.lit(source_zone), F.lit(zone), ts)


def window_start(ts: Column, window_minutes: int) -> Column:
    """Start of the window that ``ts`` is assigned to.

    Windows restart at every full hour, so a length that does not divide 60
    leaves a last window that reaches into the next hour.
    """
    into_window = F.minute(ts) % F.lit(window_minutes)
    return ts - F.make_dt_interval(
        mins=into_window, secs=F.extract(F.lit("SECOND"), ts)
    )


def tiled_start(ts: Column, window_minutes: int) -> Column:
    """``window_start`` for lengths that divide the hour.

    Windows counted from the epoch then fall on the same starts, and the
    built-in finds them with plain integer arithmetic. Only usable as a whole
    select expression.
    """
    return F.window(ts, f"{window_minutes} minutes")["start"]


def tiles_the_hour(window_minutes: int) -> bool:
    return 60 % window_minutes == 0


def covering_windows(ts: Column, window_minutes: int) -> Column:
    """Array of the starts of all windows whose half-open range holds ``ts``.

    There is exactly one when the length divides 60. Otherwise the hour's last
    window overlaps the next hour, or windows longer than an hour overlap each
    other: a fixed number of starts holds every moment, and one more those in
    the first minutes of an hour.
    """
    own = window_start(ts, window_minutes)
    if tiles_the_hour(window_minutes):
        return F.array(own)
    hour = window_start(ts, 60)
    if window_minutes < 60:
        last_start = 59 // window_minutes * window_minutes
        always, further = [own], hour - minutes(60 - last_start)
        overlap = last_start + window_minutes - 60
    else:
        hours, overlap = divmod(window_minutes, 60)
        always = [hour - minutes(60 * back) for back in reversed(range(hours))]
        further = hour - minutes(60 * hours)
    if not overlap:
        return F.array(*always)
    return F.when(F.minute(ts) < overlap, F.array(further, *always)).otherwise(F.array(*always))
