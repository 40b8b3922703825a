"""FC9: holiday covariate as a rule expression (no lookup table to ship).

A region is a list of rules over the date: a fixed day, the n-th (or last) weekday of a month, the last given weekday before a day,
or a number of days from Easter Sunday. ``observed`` adds the days on which a region keeps fixed holidays that fall on a weekend.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MON, THU, SAT, SUN = 2, 5, 7, 1  # Spark dayofweek

# Public holidays by region.
#   ("day", month, day, first year); ("nth", month, weekday, n; -1: last); ("before", month, day, weekday): the last such weekday
#   before that day; ("easter", days from Easter Sunday)
RULES: dict[str, tuple[tuple, ...]] = {
    "US": (
        ("day", 1, 1, 0), ("day", 7, 4, 0), ("day", 11, 11, 0), ("day", 12, 25, 0), ("day", 6, 19, 2021),
        ("nth", 1, MON, 3), ("nth", 2, MON, 3), ("nth", 5, MON, -1), ("nth", 9, MON, 1), ("nth", 10, MON, 2), ("nth", 11, THU, 4),
    ),
    "GB": (
        ("day", 1, 1, 0), ("easter", -2), ("easter", 1), ("nth", 5, MON, 1), ("nth", 5, MON, -1), ("nth", 8, MON, -1),
        ("day", 12, 25, 0), ("day", 12, 26, 0),
    ),
    "DE": (
        ("day", 1, 1, 0), ("easter", -2), ("easter", 1), ("day", 5, 1, 0), ("easter", 39), ("easter", 50), ("day", 10, 3, 1990),
        ("day", 12, 25, 0), ("day", 12, 26, 0),
    ),
    "FR": (
        ("day", 1, 1, 0), ("easter", 1), ("day", 5, 1, 0), ("day", 5, 8, 0), ("easter", 39), ("easter", 50), ("day", 7, 14, 0),
        ("day", 8, 15, 0), ("day", 11, 1, 0), ("day", 11, 11, 0), ("day", 12, 25, 0),
    ),
    "CA": (
        ("day", 1, 1, 0), ("easter", -2), ("before", 5, 25, MON), ("day", 7, 1, 0), ("nth", 9, MON, 1), ("day", 9, 30, 2021),
        ("nth", 10, MON, 2), ("day", 12, 25, 0),
    ),
}
#: How a region keeps a fixed holiday of a weekend: the nearest weekday, or the next free weekday.
OBSERVED = {"US": "nearest", "GB": "next", "CA": "next"}


def easter_sunday(d: Column) -> Column:
    """Easter Sunday of the date's year (Oudin's integer form of the Gregorian computus)."""
    y = F.year(d)
    div = lambda a, b: F.floor(a / F.lit(b)).cast("int")  # noqa: E731  the operands are never negative
    golden = F.pmod(y, F.lit(19))
    century = div(y, 100)
    epact = F.pmod(century - div(century, 4) - div(8 * century + 13, 25) + 19 * golden + 15, F.lit(30))
    moon = F.when(epact == 29, epact - 1).when((epact == 28) & (golden > 10), epact - 1).otherwise(epact)
    weekday = F.pmod(y + div(y, 4) + moon + 2 - century + div(century, 4), F.lit(7))
    offset = moon - weekday  # days from March 28
    return F.date_add(F.make_date(y, F.lit(3), F.lit(28)), offset)


def _rule(d: Column, rule: tuple) -> Column:
    m, day, dow = F.month(d), F.dayofmonth(d), F.dayofweek(d)
    if rule[0] == "day":
        _, month, number, first = rule
        hit = (m == month) & (day == number)
        return hit & (F.year(d) >= first) if first else hit
    if rule[0] == "nth":
        _, month, weekday, n = rule
        if n > 0:
            return (m == month) & (dow == weekday) & day.between(7 * n - 6, 7 * n)
        return (m == month) & (dow == weekday) & (F.month(F.date_add(d, 7)) != month)
    if rule[0] == "before":
        _, month, number, weekday = rule
        return (dow == weekday) & (m == month) & day.between(number - 7, number - 1)
    return F.datediff(d, easter_sunday(d)) == rule[1]


def _any(d: Column, rules) -> Column:
    return reduce(lambda a, b: a | b, [_rule(d, r) for r in rules])


def is_holiday(d: str | Column, region: str, observed: bool = False) -> Column:
    d = F.col(d) if isinstance(d, str) else d
    rules = RULES.get(region.upper())
    if rules is None:
        raise ValueError(f"unsupported holiday region {region!r}; known are {', '.join(RULES)}")
    out = _any(d, rules)
    way = OBSERVED.get(region.upper()) if observed else None
    if way is None:
        return out
    fixed = [r for r in rules if r[0] == "day"]
    on = lambda k: _any(F.date_add(d, k), fixed)  # noqa: E731  a fixed holiday k days from d
    dow = F.dayofweek(d)
    if way == "nearest":
        return out | ((dow == MON) & on(-1)) | ((dow == MON + 4) & on(1))
    # the next weekday that is no holiday itself: Monday, or Tuesday after two in a row
    return out | ((dow == MON) & (on(-1) | on(-2))) | ((dow == MON + 1) & ((on(-2) & on(-1)) | (on(-3) & on(-2))))


def is_us_holiday(d: str | Column) -> Column:
    return is_holiday(d, "US")


def holiday_flag(d: str | Column, region: str | None, observed: bool = False) -> Column:
    """1 on a holiday of ``region``, else 0; constant 0 when no region."""
    if region is None:
        return F.lit(0).cast("long")
    return F.when(is_holiday(d, region, observed), F.lit(1)).otherwise(F.lit(0)).cast("long")


def with_holiday(frame: DataFrame, time_col: str, region: str | None, name: str = "is_holiday") -> DataFrame:
    return frame.withColumn(name, holiday_flag(time_col, region))
