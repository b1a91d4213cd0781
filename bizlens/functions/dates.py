"""Date functions (H1-H16), all native Column expressions.

Business-calendar functions (NETWORKDAYS, WORKDAY) use closed forms over
``weekday`` (0 = Monday … 6 = Sunday), so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_start(ts: Column) -> Column:
    """H1: first day of the month, as a DATE."""
    return F.trunc(F.to_date(ts), "MM")


def to_day(ts: Column) -> Column:
    """H2."""
    return F.to_date(ts)


def months_since(start: Column, end: Column) -> Column:
    """H3/H13 "M": complete months from start to end."""
    return F.timestamp_diff("MONTH", start, end)


def days_between(start: Column, end: Column) -> Column:
    """H4/H13 "D": end − start in days."""
    return F.datediff(end, start)


def hours_between(start: Column, end: Column) -> Column:
    """H6: epoch difference in hours (fractional)."""
    return F.timestamp_diff("SECOND", start, end) / F.lit(3600.0)


def days_between_exact(start: Column, end: Column) -> Column:
    """H6: epoch difference in days (fractional)."""
    return F.timestamp_diff("SECOND", start, end) / F.lit(86400.0)


def year_month(d: Column) -> Column:
    """H7: first of month as the year-month key."""
    return F.trunc(F.to_date(d), "MM")


def month_label(d: Column, pattern: str = "MMM-yyyy") -> Column:
    """H8: ``Jan-2019``; ``pattern='MMMM'`` gives the full month name."""
    return F.date_format(d, pattern)


def quarter_label(d: Column) -> Column:
    """H9: ``"Q" & INT((MONTH(d)-1)/3)+1``."""
    return F.concat(F.lit("Q"), F.quarter(d).cast("string"))


def eomonth(d: Column, months: int | Column = 0) -> Column:
    """EOMONTH(d, n)."""
    n = months if isinstance(months, Column) else F.lit(months)
    return F.last_day(F.add_months(d, n))


def _weekdays_before(x: Column) -> Column:
    # Weekdays among offsets [0, x) of a week starting on Monday, for 0 <= x < 14.
    return F.least(x, F.lit(5)) + F.greatest(F.least(x - 7, F.lit(5)), F.lit(0))


def _networkdays_forward(a: Column, b: Column) -> Column:
    n = F.datediff(b, a) + 1
    w = F.weekday(a)
    r = n % 7
    return (n / 7).cast("long") * 5 + _weekdays_before(w + r) - _weekdays_before(w)


def networkdays(start: Column, end: Column) -> Column:
    """NETWORKDAYS(start, end): Monday-Friday days in the closed range.

    Reversed ranges are negative, as in the spreadsheet.
    """
    return F.when(end >= start, _networkdays_forward(start, end)) \
            .otherwise(-_networkdays_forward(end, start))


def networkdays_with_holidays(df: DataFrame, start: str, end: str, holidays: DataFrame,
                              holiday_col: str = "holiday", out: str = "networkdays") -> DataFrame:
    """H11 with a holiday calendar: weekday holidays inside the range are subtracted.

    Holiday hits are counted per distinct (start, end) pair: each pair is
    expanded to the calendar years it spans and equi-joined with the holidays
    on the year (no broadcast of the calendar is forced; AQE picks the
    strategy from its measured size), then joined back on the pair, so the
    rows of ``df`` are untouched.
    """
    h = (holidays.select(F.col(holiday_col).cast("date").alias("_h")).where(F.weekday("_h") < 5).distinct()
                 .withColumn("_y", F.year("_h")))
    pairs = df.select(F.col(start).alias("_s"), F.col(end).alias("_e")).distinct()
    lo, hi = F.least("_s", "_e"), F.greatest("_s", "_e")
    spans = pairs.select("_s", "_e", F.explode(F.sequence(F.year(lo), F.year(hi))).alias("_y"))
    hits = (spans.join(h, "_y").where((F.col("_h") >= lo) & (F.col("_h") <= hi))
                 .groupBy("_s", "_e").agg(F.count(F.lit(1)).alias("_nh")))
    sign = F.when(F.col(end) >= F.col(start), 1).otherwise(-1)
    j = df.join(hits, (df[start].eqNullSafe(hits["_s"])) & (df[end].eqNullSafe(hits["_e"])), "left")
    return (j.withColumn(out, networkdays(F.col(start), F.col(end)) - sign * F.coalesce("_nh", F.lit(0)))
             .drop("_s", "_e", "_nh"))


def workday(start: Column, n: int | Column) -> Column:
    """WORKDAY(start, n): the n-th weekday after start (start excluded), before it for n < 0."""
    n = n if isinstance(n, Column) else F.lit(n)
    w, k = F.weekday(start), F.abs(n)
    r, weeks = k % 5, (k / 5).cast("int") * 7
    friday = F.date_sub(start, F.greatest(w - 4, F.lit(0)).cast("int"))  # weekend start -> Friday before
    after = F.date_add(friday, (weeks + r + F.when(F.weekday(friday) + r > 4, 2).otherwise(0)).cast("int"))
    monday = F.date_add(start, F.when(w > 4, F.lit(7) - w).otherwise(0).cast("int"))  # weekend start -> Monday after
    before = F.date_sub(monday, (weeks + r + F.when(F.weekday(monday) - r < 0, 2).otherwise(0)).cast("int"))
    return F.when(n == 0, start).when(n > 0, after).otherwise(before)


def datedif(start: Column, end: Column, unit: str) -> Column:
    """DATEDIF with units Y, M, D."""
    unit = unit.upper()
    if unit == "D":
        return F.datediff(end, start)
    if unit == "M":
        return F.timestamp_diff("MONTH", start, end)
    if unit == "Y":
        return F.timestamp_diff("YEAR", start, end)
    raise ValueError(f"unsupported DATEDIF unit {unit!r}")


def month_between(d: Column, year: int, month: int) -> Column:
    """D inside the given calendar month (both ends inclusive)."""
    import calendar
    import datetime as dt
    first = dt.date(year, month, 1)
    last = dt.date(year, month, calendar.monthrange(year, month)[1])
    return F.to_date(d).between(F.lit(first), F.lit(last))


# The four accepted date layouts (regex, Spark pattern), tried in order.
DATE_LAYOUTS = [
    (r"^\d{4}-\d{2}-\d{2}\z", "yyyy-MM-dd"),
    (r"^\d{2}/\d{2}/\d{4}\z", "MM/dd/yyyy"),
    (r"^\d{2}\.\d{2}\.\d{4}\z", "dd.MM.yyyy"),
    (r"^\d{2}-[A-Za-z]{3}-\d{4}\z", "dd-MMM-yyyy"),
]


def parse_date_multi(s: Column) -> Column:
    """The layout whose pattern matches decides; an impossible day gives NULL.

    The patterns exclude each other.  Layouts of digits are brought to the ISO one, whose cast needs no exception to
    tell an impossible day.
    """
    v = F.trim(s)
    out = F
    for rx, fmt in DATE_LAYOUTS:
        if "MMM" in fmt:
            day = F.try_to_date(v, fmt)
        else:
            iso = F.concat_ws("-", *(F.substring(v, fmt.index(part) + 1, len(part)) for part in ("yyyy", "MM", "dd")))
            day = iso.try_cast("date")
        out = out.when(v.rlike(rx), day)
    return out
