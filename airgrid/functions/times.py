"""Times of day, dates that are known in part, and date ranges."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_time(c: Column) -> Column:
    """HH:MM:SS from up to three parts, each the whole number it starts with; missing parts are 0, odd ones give null. No range check."""
    three = once(F.split(c, ":"), lambda parts: F.array(*(F.coalesce(F.get(parts, i), F.lit("0")) for i in range(3))))
    whole = F.transform(three, lambda p: F.regexp_extract(p, r"^\s*([+-]?[0-9]+)", 1).try_cast("int").cast("string"))
    padded = F.transform(whole, lambda n: F.when(F.length(n) < 2, F.lpad(n, 2, "0")).otherwise(n))
    return once(padded, lambda t: F.concat(F.get(t, 0), F.lit(":"), F.get(t, 1), F.lit(":"), F.get(t, 2)))


def once(c: Column, f: Callable[[Column], Column]) -> Column:
    """f of c, which is evaluated once for all its uses: Spark repeats it in generators and in the branches of a case."""
    return F.get(F.transform(F.array(c), f), 0)


def seconds_of(c: Column) -> Column:
    return once(F.split(c, ":"), lambda parts: F.get(parts, 0).cast("int") * 3600 + F.get(parts, 1).cast("int") * 60 + F.get(parts, 2).cast("int"))


def add_duration(start: Column, duration: Column) -> Column:
    """Hours go round at 24; the empty string without a duration."""

    def clock(total: Column) -> Column:
        return F.format_string("%02d:%02d:%02d", (F.floor(total / 3600) % 24).cast("int"), (F.floor(total / 60) % 60).cast("int"), (total % 60).cast("int"))

    return F.when(duration.isNull(), F.lit("")).otherwise(once(seconds_of(start) + seconds_of(duration), clock))


def format_fr_date(c: Column) -> Column:
    return F.date_format(c, "dd/MM/yyyy")


def parse_partial_date(c: Column) -> Column:
    """struct<lo date, hi date, precision> of JJ/MM/AAAA, MM/AAAA or AAAA; null for anything else."""
    day = F.when(c.rlike(r"^\d{2}/\d{2}/\d{4}\z"), F.try_to_date(c, "dd/MM/yyyy"))
    month = F.when(c.rlike(r"^\d{2}/\d{4}\z"), F.try_to_date(F.concat(F.lit("01/"), c), "dd/MM/yyyy"))
    year = F.when(c.rlike(r"^\d{4}\z"), c)
    first = F.try_to_date(F.concat(F.lit("01/01/"), year), "dd/MM/yyyy")
    last = F.try_to_date(F.concat(F.lit("31/12/"), year), "dd/MM/yyyy")
    kind = lambda lo, hi, p: F.struct(lo.alias("lo"), hi.alias("hi"), F.lit(p).alias("precision"))
    return F.when(day.isNotNull(), kind(day, day, "day")).when(month.isNotNull(), kind(month, F.last_day(month), "month")).when(first.isNotNull(), kind(first, last, "year"))


def expand_date_range(param: Column) -> Column:
    """array<date> of YYYY-MM-DD, YYYY-MM-DD->YYYY-MM-DD, or a year from 1950 to 2050; null for anything else."""
    one = F.when(param.rlike(r"^\d{4}-\d{2}-\d{2}\z"), F.try_to_date(param, "yyyy-MM-dd"))
    two = param.rlike(r"^\d{4}-\d{2}-\d{2}->\d{4}-\d{2}-\d{2}\z")
    a = F.when(two, F.try_to_date(F.substring(param, 1, 10), "yyyy-MM-dd"))
    b = F.when(two, F.try_to_date(F.substring(param, 13, 10), "yyyy-MM-dd"))
    year = F.when(param.rlike(r"^\d{4}\z"), param.cast("string"))
    year = F.when(year.between("1950", "2050"), year)
    lo = F.coalesce(one, a, F.try_to_date(F.concat(year, F.lit("-01-01")), "yyyy-MM-dd"))
    hi = F.coalesce(one, b, F.try_to_date(F.concat(year, F.lit("-12-31")), "yyyy-MM-dd"))
    return F.when(lo <= hi, F.sequence(lo, hi, F.expr("interval 1 day")))
