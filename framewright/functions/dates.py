"""Date and time functions.

ANSI mode stays on, so parsing that may fail uses the ``try_`` forms.  Test tables hold
``TIMESTAMP_NTZ`` values; conversions here keep NTZ so results do not depend on the session
time zone, except where a watermark needs ``TIMESTAMP`` (see ``streaming``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH_NTZ = "1970-01-01 00:00:00"


def today_and_now() -> tuple[Column, Column]:
    """Current date and timestamp (fixed per query)."""
    return F.current_date(), F.current_timestamp()


def add_days(c: Column, n: int) -> Column:
    """D2."""
    return F.date_add(c, n)


def sub_days(c: Column, n: int) -> Column:
    """D2."""
    return F.date_sub(c, n)


def day_difference(end: Column, start: Column) -> Column:
    """D3: ``end - start`` in days, signed."""
    return F.datediff(end, start)


def months_between(end: Column, start: Column) -> Column:
    """Fractional months on a 31-day basis, rounded to 8 digits; whole months when both
    dates share the day of month or are both month ends."""
    return F.months_between(end, start)


def parse_date(c: Column, fmt: str | None = None) -> Column:
    """Text to date, with the default or a given pattern; malformed text raises."""
    return F.to_date(c, fmt) if fmt else F.to_date(c)


def try_parse_date(c: Column, fmt: str | None = None) -> Column:
    """Text to date; null when it does not parse."""
    return F.try_to_date(c, fmt) if fmt else F.try_to_date(c)


def parse_timestamp(c: Column, fmt: str) -> Column:
    """Text to a timestamp without time zone."""
    return F.to_timestamp_ntz(c, F.lit(fmt))


def as_date(text: str) -> Column:
    """A date literal, for comparisons that should not rely on implicit casts."""
    return F.to_date(F.lit(text))


def weekday_name(c: Column) -> Column:
    """``Monday`` .. ``Sunday``."""
    return F.date_format(c, "EEEE")


def epoch_micros(ts: Column) -> Column:
    """NTZ timestamp to microseconds since the epoch, without any time zone: built from the
    wall-clock fields (``timestamp_diff`` would pass through the session time zone and fold the
    hour skipped by a daylight-saving change)."""
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("long")
    return (days * 86_400_000_000 + F.hour(ts).cast("long") * 3_600_000_000
            + F.minute(ts).cast("long") * 60_000_000
            + (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("long"))


def from_epoch_micros(micros: Column) -> Column:
    """Microseconds since the epoch to an NTZ timestamp, without any time zone."""
    return F.timestamp_add("MICROSECOND", micros, F.lit(EPOCH_NTZ).cast("timestamp_ntz"))


def ntz_as_instant(ts: Column) -> Column:
    """An NTZ wall-clock value as the TIMESTAMP instant with the same UTC wall clock.  Unlike a
    cast, this does not depend on the session time zone (no shifted windows, no DST gaps)."""
    return F.timestamp_micros(epoch_micros(ts))


def instant_as_ntz(ts: Column) -> Column:
    """Inverse of ``ntz_as_instant``."""
    return from_epoch_micros(F.unix_micros(ts))


def epoch_nanos(ts: Column) -> Column:
    """D11 inverse: NTZ timestamp to nanoseconds since the epoch (as a long)."""
    return epoch_micros(ts) * 1000


def from_epoch_nanos(nanos: Column) -> Column:
    """D11/R10 exact form: nanoseconds since the epoch to an NTZ timestamp (microseconds kept,
    sub-microsecond part truncated toward zero, as the cast through double does)."""
    micros = (nanos.cast("decimal(20,0)") / F.lit(1000)).cast("long")   # exact, truncates toward zero
    return from_epoch_micros(micros)


def from_epoch_nanos_double(nanos: Column) -> Column:
    """D11 as in the reference: divide by 1e9 and cast through double (may lose the last
    microsecond)."""
    return (nanos.cast("double") / F.lit(1e9)).cast("timestamp")


def window_bucket(c: Column, size: str, slide: str | None = None) -> Column:
    """Tumbling or sliding window struct (``start``, ``end``)."""
    return F.window(c, size, slide) if slide else F.window(c, size)
