"""Timestamp parsing and formatting as native column expressions.

The raw export mixes four layouts.  Each is tried in order with
``try_to_timestamp`` (NULL instead of an error) and the first hit wins; no
Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from queuelens.functions.text import strip_ws

# The raw export's timestamp layouts, in the order they are
# tried.  They correspond to the strptime layouts
#   %Y-%m-%d %H:%M:%S | %d/%m/%Y %H:%M | %m-%d-%Y %I:%M %p | %d-%b-%Y %H:%M:%S
# Single pattern letters accept both padded and unpadded numbers, and month
# names / AM-PM markers parse case-insensitively.
RAW_TIMESTAMP_FORMATS = (
    "yyyy-M-d H:m:s",
    "d/M/yyyy H:m",
    "M-d-yyyy h:m a",
    "d-MMM-yyyy H:m:s",
)

# The same layouts for writing text (zero padded), used by the raw fixture.
RAW_TIMESTAMP_WRITE_FORMATS = (
    "yyyy-MM-dd HH:mm:ss",
    "dd/MM/yyyy HH:mm",
    "MM-dd-yyyy hh:mm a",
    "dd-MMM-yyyy HH:mm:ss",
)

ISO_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Text that starts like an ISO date: the only shape the last-resort cast accepts.
_ISO_PREFIX = r"^\d{4}-\d{1,2}-\d{1,2}([ T]|$)"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# A shape every text parseable by the layout at the same position must have.
# Guarding each attempt with it changes no result (a text without the shape
# fails that layout anyway) but skips the failing attempts, which are the
# expensive ones: a failed parse builds and catches an exception per row.
_LAYOUT_SHAPES = (
    r"^\d{4}-",
    r"^\d{1,2}/",
    r"(?i)[ap]m$",
    r"^\d{1,2}-[A-Za-z]",
)


def _text(col: Column | str, stripped: bool) -> Column:
    return _c(col) if stripped else strip_ws(_c(col))


def parse_known_formats(col: Column | str, stripped: bool = False) -> Column:
    """First successful parse among the four layouts, else NULL (TIMESTAMP_NTZ).

    ``stripped=True`` when the caller already removed surrounding whitespace
    (the text then feeds every guard and attempt without being re-stripped)."""
    t = _text(col, stripped)
    parsed = F.coalesce(*[F.when(t.rlike(shape), F.try_to_timestamp(t, F.lit(f)))
                          for shape, f in zip(_LAYOUT_SHAPES, RAW_TIMESTAMP_FORMATS)])
    # try_to_timestamp yields a session-zone timestamp; the session zone is
    # UTC, so the cast back to wall clock is exact.
    return parsed.cast("timestamp_ntz")


def parse_fallback(col: Column | str, stripped: bool = False) -> Column:
    """Last resort (cl_ts_fallback): ISO-shaped text via a plain cast, else NULL.

    Deliberately narrower than a free-form guess: bare times or bare years
    are rejected instead of being anchored to today or to 1 January.
    """
    t = _text(col, stripped)
    return F.when(t.rlike(_ISO_PREFIX), t.try_cast("timestamp_ntz"))


def parse_mixed_timestamp(col: Column | str, stripped: bool = False) -> Column:
    """cl_timestamp: known layouts first, then the ISO fallback; NULL stays NULL."""
    return F.coalesce(parse_known_formats(col, stripped), parse_fallback(col, stripped))


def iso_text(col: Column | str) -> Column:
    """cl_iso_format: ``YYYY-MM-DD HH:MM:SS`` text; NULL stays NULL."""
    return F.date_format(_c(col), ISO_FORMAT)


def format_as(col: Column | str, layout_no: Column) -> Column:
    """Render a timestamp in raw layout number ``layout_no`` (0-3)."""
    c = _c(col)
    out = F.lit(None).cast("string")
    for i in reversed(range(len(RAW_TIMESTAMP_WRITE_FORMATS))):
        out = F.when(layout_no == i, F.date_format(c, RAW_TIMESTAMP_WRITE_FORMATS[i])).otherwise(out)
    return out


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Exact (fractional) seconds from ``start`` to ``end`` as DOUBLE."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end)) / F.lit(1_000_000.0)
