"""SLA column expressions and the shared aggregate measures.

Everything here is a native Spark expression so it stays inside whole-stage
codegen.  Rounding rules:

* resolution hours: half-to-even at 2 dp (``rint``), and the breach test uses
  the rounded value;
* reported percentages and means: ``round`` (half away from zero) on DOUBLE;
* money and hour sums: exact DECIMAL sums, so the result does not depend on
  the order in which partitions are combined.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from queuelens.functions.timestamps import seconds_between


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ts_literal(value: str | _dt.datetime) -> Column:
    """A TIMESTAMP_NTZ literal (``as_of`` and similar parameters)."""
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(value).cast("timestamp_ntz")


def round_half_even_2dp(hours: Column) -> Column:
    return F.rint(hours * F.lit(100.0)) / F.lit(100.0)


def resolution_hours(status: Column | str, opened: Column | str, closed: Column | str) -> Column:
    """cl_resolution: hours open->close for Closed tickets with a close time, else NULL."""
    raw = seconds_between(opened, closed) / F.lit(3600.0)
    return F.when((_c(status) == "Closed") & _c(closed).isNotNull(), round_half_even_2dp(raw))


def breach_flag(status: Column | str, hours: Column | str, opened: Column | str,
                target: Column | str, as_of: str | _dt.datetime) -> Column:
    """cl_breach as 0/1.

    Closed: rounded hours > target.  Anything else: unrounded hours elapsed
    from opening to ``as_of`` > target.  Unknown hours (NULL) never breach.
    """
    elapsed = seconds_between(opened, ts_literal(as_of)) / F.lit(3600.0)
    cond = F.when(_c(status) == "Closed", _c(hours) > _c(target)).otherwise(elapsed > _c(target))
    return F.coalesce(cond, F.lit(False)).cast("int")


# ---------------------------------------------------------------- aggregates

def pct(numerator: Column, denominator: Column, digits: int | None) -> Column:
    """``round(100 * n / d, digits)`` in DOUBLE; NULL when ``d`` is 0."""
    v = F.try_divide(F.lit(100.0) * numerator.cast("double"), denominator.cast("double"))
    return F.round(v, digits) if digits is not None else v


def breach_pct(breached: Column | str = "sla_breached", digits: int | None = 1) -> Column:
    """Share of breached tickets in percent (aggregate)."""
    return pct(F.sum(_c(breached)), F.count(F.lit(1)), digits)


def compliance_pct(breached: Column | str = "sla_breached", digits: int | None = 1) -> Column:
    """Share of tickets within SLA in percent (aggregate)."""
    return pct(F.count_if(_c(breached) == 0), F.count(F.lit(1)), digits)


def exact_sum(col: Column | str, scale: int = 2) -> Column:
    """Order-independent sum of a 2-dp DOUBLE measure, returned as DOUBLE."""
    return F.sum(_c(col).cast(f"decimal(18,{scale})")).cast("double")


def exact_mean(col: Column | str, digits: int | None, scale: int = 2) -> Column:
    """Mean of a 2-dp DOUBLE measure (NULLs skipped) from an exact sum."""
    v = F.try_divide(exact_sum(col, scale), F.count(_c(col)).cast("double"))
    return F.round(v, digits) if digits is not None else v


def bigint_sum(col: Column | str) -> Column:
    return F.sum(_c(col)).cast("bigint")


# ------------------------------------------------------------ derived keys

def month_key(ts: Column | str) -> Column:
    """``YYYY-MM`` of a timestamp."""
    return F.date_format(_c(ts), "yyyy-MM")


def weekday_sunday0(ts: Column | str) -> Column:
    """Weekday number with Sunday = 0 (Spark's dayofweek has Sunday = 1)."""
    return F.dayofweek(_c(ts)) - 1


# Weekday names indexed by the Sunday-first number.
WEEKDAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def weekday_name(day_no: Column) -> Column:
    out = F.lit(WEEKDAY_NAMES[-1])
    for i in reversed(range(len(WEEKDAY_NAMES) - 1)):
        out = F.when(day_no == i, F.lit(WEEKDAY_NAMES[i])).otherwise(out)
    return out


# The salary-date window (day of month >= 25 or <= 2) and its labels.
SALARY_WINDOW_FROM_DAY = 25
SALARY_WINDOW_TO_DAY = 2
SALARY_LABEL = "Salary-date window"
REST_LABEL = "Rest of month"


def salary_period(ts: Column | str) -> Column:
    d = F.dayofmonth(_c(ts))
    return F.when((d >= SALARY_WINDOW_FROM_DAY) | (d <= SALARY_WINDOW_TO_DAY),
                  F.lit(SALARY_LABEL)).otherwise(F.lit(REST_LABEL))


# Resolution buckets, upper bound inclusive, and the label of
# everything above the last bound (NULL hours land there too).
RESOLUTION_BUCKETS = ((24, "0-24 hrs"), (48, "24-48 hrs"), (72, "48-72 hrs"), (168, "72-168 hrs"))
OVERFLOW_BUCKET = "168+ hrs"


def resolution_bucket(hours: Column | str) -> Column:
    h = _c(hours)
    out = F.lit(OVERFLOW_BUCKET)
    for bound, label in reversed(RESOLUTION_BUCKETS):
        out = F.when(h <= bound, F.lit(label)).otherwise(out)
    return out
