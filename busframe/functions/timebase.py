"""Time stamps as nanoseconds since 1970 in long columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NS = 1_000_000_000


def irig_day(day: Column, hour: Column, minute: Column, second: Column, ms: Column) -> Column:
    """Day of the year (0 counts as 1) of an unknown year, set in 1970. ms: milliseconds."""
    return (((F.greatest(day, F.lit(1)).cast("long") - 1) * 86400 + hour * 3600 + minute * 60 + second) * NS) + ms.cast("long") * 1_000_000


def calendar(year: Column, month: Column, day: Column, hour: Column, minute: Column, second: Column, ms: Column) -> Column:
    """UTC date and time."""
    days = F.datediff(F.make_date(year, month, day), F.lit("1970-01-01").cast("date")).cast("long")
    return (days * 86400 + hour * 3600 + minute * 60 + second) * NS + ms.cast("long") * 1_000_000


def rtc(count: Column) -> Column:
    """48-bit counter of 100 ns."""
    return count.cast("long") * 100


def binary_weighted(high: Column, low: Column, us: Column) -> Column:
    """Ticks of 655.36 s and of 10 ms, and microseconds."""
    return high.cast("long") * 655_360_000_000 + low.cast("long") * 10_000_000 + us.cast("long") * 1000


def ieee_1588(seconds: Column, ns: Column) -> Column:
    return seconds.cast("long") * NS + ns.cast("long")


def ertc(high: Column, low: Column) -> Column:
    """64-bit counter in two 32-bit words."""
    return F.shiftleft(high.cast("long"), 32) + low.cast("long")


def absolute(rtc_count: Column, fix_rtc: Column, fix_time: Column) -> Column:
    """A packet's time from its counter and a clock fix."""
    return fix_time + (rtc(rtc_count) - rtc(fix_rtc))


def intra_packet(source: Column, form: Column, relative: Column, weighted: Column, ieee: Column, extended: Column) -> Column:
    """Time by source (0: relative counter; 1: secondary header) and the secondary header's format (0, 1, 2). Null otherwise."""
    return F.when(source == 0, relative).when((source == 1) & (form == 0), weighted).when((source == 1) & (form == 1), ieee).when((source == 1) & (form == 2), extended)


def unit_time(own: Column, stamp: Column, packet: Column) -> Column:
    """Time of a video unit: its own stamp's if it has one, else its packet's."""
    return F.when(own, stamp).otherwise(packet)
