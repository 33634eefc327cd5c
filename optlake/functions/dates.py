"""Date and time handling (column expressions plus driver-side argument parsing).

Rules (all in the session zone, UTC):
* a filter argument is a date; zoned text is converted to UTC first, then the
  date is taken; unparsable text is an error (arguments never silently drop);
* a range bound may also be a number or a digit string: epoch milliseconds;
* data columns are coerced row by row: each value is tried against every
  accepted form, unparsable values become NULL.
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_DIGITS = re.compile(r"^-?\d+$")


def _to_utc_date(value: _dt.datetime) -> _dt.date:
    if value.tzinfo is not None:
        value = value.astimezone(_dt.timezone.utc)
    return value.date()


def parse_date_arg(value, label: str = "date") -> _dt.date | None:
    """Filter argument -> date (None stays None); bad text raises ValueError."""
    if value is None:
        return None
    if isinstance(value, _dt.datetime):
        return _to_utc_date(value)
    if isinstance(value, _dt.date):
        return value
    if isinstance(value, str):
        text = value.strip()
        try:
            if len(text) == 10:
                return _dt.date.fromisoformat(text)
            return _to_utc_date(_dt.datetime.fromisoformat(text.replace("Z", "+00:00")))
        except ValueError as exc:
            raise ValueError(f"cannot read {label}={value!r} as a day: give year-month-day or an ISO instant") from exc
    raise ValueError(f"{label} must be a date or a date string, got {type(value).__name__}")


def parse_bound(value, label: str = "bound") -> _dt.date | None:
    """Range bound: epoch ms (number or digit string) or a date/timestamp text."""
    if value is None:
        return None
    if isinstance(value, bool):
        raise ValueError(f"{label} must not be a boolean")
    if isinstance(value, (int, float)) or (isinstance(value, str) and _DIGITS.match(value.strip())):
        millis = int(value)
        return _dt.datetime.fromtimestamp(millis / 1000.0, tz=_dt.timezone.utc).date()
    return parse_date_arg(value, label)


def coerce_timestamp(col: Column | str) -> Column:
    """Text/number column -> TIMESTAMP, row by row; unparsable -> NULL.

    ``try_to_timestamp`` without a pattern accepts dates, 'T' or space
    separated times and zone offsets; the fixed patterns cover the slash and
    compact forms seen in vendor text.
    """
    c = F.col(col) if isinstance(col, str) else col
    s = c.cast("string")
    return F.coalesce(
        F.try_to_timestamp(s),
        F.try_to_timestamp(s, F.lit("yyyy/MM/dd")),
        F.try_to_timestamp(s, F.lit("MM/dd/yyyy")),
        F.try_to_timestamp(s, F.lit("yyyyMMdd")),
    )


def epoch_ns_to_ts(col: Column | str) -> Column:
    """Epoch nanoseconds -> TIMESTAMP (sub-microsecond digits dropped)."""
    c = F.col(col) if isinstance(col, str) else col
    return _micros(F.floor(c.cast("decimal(38,0)") / F.lit(1000)))


def long_ns_to_ts(col: Column) -> Column:
    """Epoch nanoseconds in a BIGINT -> TIMESTAMP, without decimals: its whole range lies in the years 1677 to 2262."""
    down = F.when(col % F.lit(1000) < 0, F.lit(1)).otherwise(F.lit(0))
    return F.timestamp_micros(F.call_function("div", col, F.lit(1000)) - down)


def epoch_ms_to_ts(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return _micros(c.cast("decimal(38,0)") * F.lit(1000))


# Microseconds of the first and last instant of the years 1 to 9999.
_FIRST_MICRO, _LAST_MICRO = -62_135_596_800_000_000, 253_402_300_799_999_999


def _micros(value: Column) -> Column:
    """Epoch microseconds -> TIMESTAMP; NULL outside the years 1 to 9999."""
    return F.timestamp_micros(F.when(value.between(_FIRST_MICRO, _LAST_MICRO), value).cast("long"))


def tolerance_days(n) -> int:
    """Coverage tolerance in whole days; negative counts as zero."""
    return max(int(n or 0), 0)
