"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from marketgrain.functions.numeric import flag
from marketgrain.schemas import EPOCH, SEASONS

# fixed values: days before the first of each month in a year of 365 days
DAYS_BEFORE_MONTH = (0, 31, 59, 90, 120, 151, 181, 212, 243, 273, 304, 334)


def parse_date(text: Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Date of a text column; text that is no date becomes NULL."""
    return F.to_date(F.try_to_timestamp(text, F.lit(fmt)))


def parse_datetime(date_text: Column, time_text: Column) -> Column:
    """Timestamp of separate date and time texts; NULL when they do not parse."""
    return F.try_to_timestamp(F.concat_ws(" ", date_text, time_text))


def cyclic(value: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of the position within a period."""
    angle = value * (2 * F.pi() / period)
    return F.sin(angle), F.cos(angle)


def is_national_day(month: Column, day_of_year: Column) -> Column:
    return flag((month == 10) & day_of_year.between(274, 280))


def is_labor_day(month: Column, day_of_year: Column) -> Column:
    return flag((month == 5) & day_of_year.between(121, 125))


def season(month: Column, rule: str = "meteorological") -> Column:
    """Season label.

    ``meteorological``: March to May is Spring. ``shifted``: December to February is Spring, the rule of
    the original feature table.
    """
    if rule == "shifted":
        index = F.floor((month % 12 + 3) / 3)
    elif rule == "meteorological":
        index = F.floor(((month + 9) % 12) / 3) + 1
    else:
        raise ValueError(f"unknown season rule {rule!r}")
    return F.try_element_at(F.array(*[F.lit(s) for s in SEASONS]), index.cast("int"))


def calendar_columns(date: Column) -> dict[str, Column]:
    """The calendar part of the feature table."""
    month, doy, dow = F.month(date), F.dayofyear(date), F.weekday(date)
    month_sin, month_cos = cyclic(month, 12)
    doy_sin, doy_cos = cyclic(doy, 365)
    dow_sin, dow_cos = cyclic(dow, 7)
    return {
        "Year": F.year(date),
        "Month": month,
        "Quarter": F.quarter(date),
        "DayOfYear": doy,
        "DayOfWeek": dow,
        "WeekOfYear": F.weekofyear(date),
        "IsWeekend": flag(dow >= 5),
        "Month_Sin": month_sin,
        "Month_Cos": month_cos,
        "DayOfYear_Sin": doy_sin,
        "DayOfYear_Cos": doy_cos,
        "DayOfWeek_Sin": dow_sin,
        "DayOfWeek_Cos": dow_cos,
        "IsNationalDay": is_national_day(month, doy),
        "IsLaborDay": is_labor_day(month, doy),
        "Days_Since_Epoch": F.datediff(date, F.lit(EPOCH).cast("date")),
    }


def approx_day_of_year(month: Column) -> Column:
    """Middle of the month as day of the year, for rows that carry a month but no date."""
    before = F.try_element_at(F.array(*[F.lit(d) for d in DAYS_BEFORE_MONTH]), F.greatest(month.cast("int"), F.lit(1)))
    return before + 15


def period_text(year: Column, month: Column, day: str) -> Column:
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"), F.lit(f"-{day}"))


def day_type(is_weekend: Column) -> Column:
    return F.when(is_weekend == 1, "Weekend").otherwise("Weekday")


def first_of_month(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1))
