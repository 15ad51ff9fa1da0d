"""The six source date layouts. A value that does not parse becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


# how each layout reads a text column, as an expression over {c}
LAYOUTS = {
    "day_slash": "try_to_date({c}, 'dd/MM/yyyy')",
    "iso_date": "try_to_date({c}, 'yyyy-MM-dd')",
    "iso_timestamp": "try_cast({c} AS timestamp_ntz)",
    "day_month_name": "try_to_date({c}, 'dd-MMM-yyyy')",
    "slash_minute": "cast(try_to_timestamp({c}, 'yyyy/MM/dd HH:mm') AS timestamp_ntz)",
    "epoch_seconds": f"{_EPOCH} + make_dt_interval(0, 0, 0, try_cast({{c}} AS decimal(18,6)))",
}


def parse(c: str, layout: str) -> Column:
    """The column named `c` as a date or timestamp."""
    if layout not in LAYOUTS:
        raise ValueError(f"{layout!r} is not a date layout; use one of {sorted(LAYOUTS)}")
    return F.expr(LAYOUTS[layout].format(c=c))


def parse_failed(raw: str, parsed: str) -> Column:
    return F.expr(f"{raw} IS NOT NULL AND {parsed} IS NULL")


def hours_between(start: Column | str, end: Column | str) -> Column:
    """Elapsed hours with fractions, for timestamps without a zone."""
    start, end = (F.col(c) if isinstance(c, str) else c for c in (start, end))
    return F.timestamp_diff("SECOND", start, end) / F.lit(3600.0)


def epoch_seconds(ts: Column | str) -> Column:
    return F.timestamp_diff("SECOND", F.expr(_EPOCH), F.col(ts) if isinstance(ts, str) else ts)
