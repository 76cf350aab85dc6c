"""Date/time functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricewise.functions._util import as_col

# Fixed value: the sales file's timestamp layout, e.g. '2021-05-14 00:00'.
DEFAULT_TS_FORMAT = "yyyy-MM-dd HH:mm"
# Says that the layout is to be inferred from the first value (see operators.clean).
INFER_TS_FORMAT = "infer"
# Known layouts. Dates with dots, dashes or slashes: year first, else month before
# day where both are possible with slashes and dashes, day before month with dots; clock times after each.
_DAYS = ("yyyy-MM-dd", "yyyy/MM/dd", "yyyy.MM.dd", "yyyyMMdd", "M/d/yyyy", "d/M/yyyy", "M-d-yyyy", "d-M-yyyy",
         "d.M.yyyy", "d MMM yyyy", "d MMMM yyyy", "MMM d, yyyy", "MMMM d, yyyy")
_TIMES = ("", " HH:mm", " HH:mm:ss", " HH:mm:ss.SSSSSS", " HH:mm:ss.SSS", "'T'HH:mm", "'T'HH:mm:ss",
          "'T'HH:mm:ss.SSSSSS", "'T'HH:mm:ss.SSS")
TS_LAYOUTS = tuple(d + t for d in _DAYS for t in _TIMES)


def cast_timestamp(c: "Column | str", fmt: str = DEFAULT_TS_FORMAT) -> Column:
    """Text -> TIMESTAMP_NTZ in ``fmt``; text in any other layout becomes null.

    ``try_to_timestamp`` only decides validity (it never raises); the value
    itself comes from ``to_timestamp_ntz``, which does not pass through the
    session time zone, so wall-clock times inside a DST gap are kept.
    """
    text = as_col(c).cast("string")
    valid = F.try_to_timestamp(text, F.lit(fmt)).isNotNull()
    return F.when(valid, F.to_timestamp_ntz(text, F.lit(fmt)))


def sold_year(ts: "Column | str") -> Column:
    return F.year(as_col(ts)).cast("bigint")


def sold_month(ts: "Column | str") -> Column:
    return F.month(as_col(ts)).cast("bigint")


def month_start(ts: "Column | str") -> Column:
    """First instant of the month, kept as TIMESTAMP_NTZ (date_trunc returns TIMESTAMP)."""
    return F.date_trunc("MONTH", as_col(ts)).cast("timestamp_ntz")


def epoch_millis_to_utc(ms: "Column | str") -> Column:
    """Epoch milliseconds -> UTC wall-clock TIMESTAMP_NTZ; null stays null.

    Built as epoch + interval so the result does not depend on the session zone.
    """
    secs = (as_col(ms).cast("decimal(20,0)") / F.lit(1000)).cast("decimal(18,3)")
    epoch = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    return epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)


def ntz_micros(ts: "Column | str") -> Column:
    """Microseconds since 1970-01-01 of a wall-clock timestamp, independent of
    the session time zone."""
    epoch = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    return F.timestamp_diff("MICROSECOND", epoch, as_col(ts).cast("timestamp_ntz"))
