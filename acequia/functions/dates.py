"""Dates as corpora write them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_date(c: Column) -> Column:
    """A date of D/M/Y or D-M-Y (padded or not) or Y-M-D; a year alone is its first day; else null."""
    t = F.regexp_replace(F.trim(c), "/", "-")
    d, m, y = (F.regexp_extract(t, r"^(\d{1,2})-(\d{1,2})-(\d{4})$", i) for i in (1, 2, 3))
    iso = (
        F.when(y != "", F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")))
        .when(t.rlike(r"^\d{4}$"), F.concat(t, F.lit("-01-01")))
        .when(t.rlike(r"^\d{4}-\d{2}-\d{2}$"), t)
    )
    return F.try_to_date(iso, "yyyy-MM-dd")


def month_windows(start: Column, end: Column) -> Column:
    """Half-open windows [from, to) of a month each between two dates, the last one cut short, newest first."""
    starts = F.sequence(start.cast("date"), F.greatest(start.cast("date"), F.date_sub(end.cast("date"), 1)), F.expr("interval 1 month"))
    windows = F.transform(starts, lambda s: F.struct(s.alias("from"), F.least(F.add_months(s, 1), end.cast("date")).alias("to")))
    return F.when(start.cast("date") < end.cast("date"), F.reverse(windows)).otherwise(F.slice(windows, 1, 0))


def clock(c: Column) -> Column:
    """h:mm:ss of an ISO-8601 duration of hours, minutes and seconds; null of anything else."""
    part = lambda unit: F.coalesce(F.try_to_number(F.regexp_extract(c, rf"T.*?(\d+){unit}", 1), F.lit("999999")), F.lit(0)).cast("bigint")
    whole = part("H") * 3600 + part("M") * 60 + part("S")
    text = F.format_string("%d:%02d:%02d", F.floor(whole / 3600), F.floor(whole % 3600 / 60), whole % 60)
    return F.when(c.rlike(r"^PT(?:\d+H)?(?:\d+M)?(?:\d+S)?$") & (c != "PT"), text)
