"""Week bucketing and calendar features."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weekcast.config import WEEKDAYS


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def week_start(date, anchor: str = "MON") -> Column:
    """First day of the 7-day week that starts on ``anchor`` and holds ``date``.

    ``MON`` gives ISO weeks.  ``TUE`` reproduces a pandas ``W-MON`` period
    start (a week that *ends* on Monday, trap R1).  Pure date arithmetic, so it
    stays inside whole-stage codegen.
    """
    d = F.to_date(_col(date))
    k = WEEKDAYS[anchor.upper()]
    # F.weekday: Monday = 0 ... Sunday = 6
    offset = (F.weekday(d) - F.lit(k - 1) + F.lit(7)) % F.lit(7)
    return F.date_sub(d, offset.cast("int"))


def calendar_columns(week) -> dict[str, Column]:
    w = _col(week)
    iso_week = F.weekofyear(w)
    return {
        "week": iso_week,
        "month": F.month(w),
        "quarter": F.quarter(w),
        "year": F.year(w),
        "is_year_end": (iso_week >= 51).cast("int"),
        "is_month_start": (F.dayofmonth(w) == 1).cast("int"),
        "is_month_end": (w == F.last_day(w)).cast("int"),
    }


def add_calendar_features(df: DataFrame, week_col: str = "week_start") -> DataFrame:
    """ISO week, month, quarter, year and the year/month edge flags."""
    return df.withColumns(calendar_columns(week_col))


def us_federal_holidays(year: int) -> list[dt.date]:
    """US federal holidays of a year by rule, with the Friday or Monday on which one that falls on a weekend is observed."""
    def nth(month: int, weekday: int, n: int) -> dt.date:
        """The n-th such weekday of a month (Monday 0); n = -1 is the last."""
        if n < 0:
            last = dt.date(year, month + 1, 1) - dt.timedelta(days=1)
            return last - dt.timedelta(days=(last.weekday() - weekday) % 7)
        first = dt.date(year, month, 1)
        return first + dt.timedelta(days=(weekday - first.weekday()) % 7 + 7 * (n - 1))

    fixed = [dt.date(year, 1, 1), dt.date(year, 7, 4), dt.date(year, 11, 11), dt.date(year, 12, 25)]
    if year >= 2021:
        fixed.append(dt.date(year, 6, 19))
    moving = [nth(2, 0, 3), nth(5, 0, -1), nth(9, 0, 1), nth(10, 0, 2), nth(11, 3, 4)]
    if year >= 1986:
        moving.append(nth(1, 0, 3))
    observed = [d + dt.timedelta(days={5: -1, 6: 1}[d.weekday()]) for d in [*fixed, dt.date(year + 1, 1, 1)] if d.weekday() >= 5]
    return sorted({d for d in (*fixed, *moving, *observed) if d.year == year})


# Public holidays of a whole country.  "since" is the first year for which the rules hold; a date is
# (month, day, first year); "easter" holds days after Easter Sunday; "once" holds single dates.
HOLIDAY_RULES = {
    "BR": {"since": 1981, "easter": (-2,), "once": (),
           "dates": ((1, 1, 0), (4, 21, 0), (5, 1, 0), (9, 7, 0), (10, 12, 0), (11, 2, 0), (11, 15, 0), (11, 20, 2024), (12, 25, 0))},
    "DE": {"since": 1991, "easter": (-2, 1, 39, 50), "once": (dt.date(2017, 10, 31),),
           "dates": ((1, 1, 0), (5, 1, 0), (10, 3, 0), (12, 25, 0), (12, 26, 0))},
    "FR": {"since": 1982, "easter": (1, 39, 50), "once": (),
           "dates": ((1, 1, 0), (5, 1, 0), (5, 8, 0), (7, 14, 0), (8, 15, 0), (11, 1, 0), (11, 11, 0), (12, 25, 0))},
}
US_SINCE, LAST_YEAR = 1978, 2100


def easter_sunday(year: int) -> dt.date:
    """Easter of the Gregorian calendar: the Sunday after the first full moon of spring, as the church counts moons."""
    century = year // 100
    moon_shift = (century - century // 4 - (8 * century + 13) // 25 + 19 * (year % 19) + 15) % 30
    moon_shift -= moon_shift == 29 or (moon_shift == 28 and year % 19 > 10)
    full_moon = dt.date(year, 3, 21) + dt.timedelta(days=moon_shift)
    return full_moon + dt.timedelta(days=7 - (full_moon.weekday() + 1) % 7)


def holiday_years(country: str) -> tuple[int, int]:
    """First and last year whose holidays are known for a country; a ``ValueError`` for unknown countries."""
    c = country.upper()
    if c != "US" and c not in HOLIDAY_RULES:
        raise ValueError(f"no holiday rules for country {country!r}; give a holiday table")
    return (US_SINCE if c == "US" else HOLIDAY_RULES[c]["since"]), LAST_YEAR


def public_holidays(country: str, year: int) -> list[dt.date]:
    """Holidays of a country in a year by rule; a ``ValueError`` for unknown countries and years."""
    first, last = holiday_years(country)
    if not first <= year <= last:
        raise ValueError(f"holidays of {country!r} are known from {first} to {last}, not for {year}")
    if country.upper() == "US":
        return us_federal_holidays(year)
    rule, easter = HOLIDAY_RULES[country.upper()], easter_sunday(year)
    days = [dt.date(year, m, d) for m, d, since in rule["dates"] if year >= since]
    days += [easter + dt.timedelta(days=k) for k in rule["easter"]]
    return sorted({*days, *(d for d in rule["once"] if d.year == year)})


def holiday_table(spark: SparkSession, country: str = "US", first_year: int | None = None, last_year: int | None = None) -> DataFrame:
    """(country, holiday_date), a row a holiday, by default for all years of ``holiday_years``."""
    first, last = holiday_years(country)
    years = range(first if first_year is None else first_year, (last if last_year is None else last_year) + 1)
    rows = [(country.upper(), d) for y in years for d in public_holidays(country, y)]
    return spark.createDataFrame(rows, "country string, holiday_date date")
