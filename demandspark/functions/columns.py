"""Scalar column expressions: rounding, revenue, calendar, guards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark import schemas


def half_even(value: Column, digits: int = 2) -> Column:
    """Half-even rounding of a number with few decimals, exact at ties.

    The tie is decided on a decimal, so 8.345 is a tie and not 8.3450000000000006.
    """
    return F.bround(value.try_cast("decimal(28,8)"), digits).cast("double")


def whole(value: Column) -> Column:
    """Half-even rounding to a whole number; null if there is none."""
    return F.bround(value.try_cast("decimal(28,8)"), 0).try_cast("long")


def at_least_zero(value: Column) -> Column:
    """Clip at zero; null stays null (``greatest`` alone would turn it into zero)."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(0).cast("double")))


def demand_units(value: Column) -> Column:
    """A prediction as a whole, non-negative number of units; null if it is not a number."""
    return F.when(whole(value).isNotNull(), F.greatest(F.lit(0).cast("long"), whole(value)))


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives null, not an error, for a zero denominator."""
    return numerator / F.nullif(denominator, F.lit(0).cast("double"))


def net_revenue(units: Column, price: Column, discount: Column) -> Column:
    """units * price * (1 - discount/100) as an exact decimal; discount is a percentage.

    Price and discount count with six decimals. Null if an amount is out of range (units from
    1e12, price from 1e7, discount from 1e3). Decimals make sums over any partitioning
    identical. Cast to double last.
    """
    percent = F.lit(100).cast("decimal(3,0)") - discount.try_cast("decimal(9,6)")
    share = percent * F.lit("0.01").cast("decimal(3,2)")
    return units.try_cast("decimal(12,0)") * price.try_cast("decimal(13,6)") * share.cast("decimal(11,8)")


def parse_day(text: Column) -> Column:
    """A strict yyyy-MM-dd date; anything else is null."""
    return F.when(text.rlike(schemas.DATE_PATTERN), F.try_to_date(text, "yyyy-MM-dd"))


def matches(text: Column, pattern: str) -> Column:
    """Pattern test in which null fails."""
    return F.coalesce(text.rlike(pattern), F.lit(False))


def calendar(day: Column) -> dict[str, Column]:
    """The seven calendar features; weeks are ISO weeks, Monday is day 0."""
    weekday = F.weekday(day)
    return {
        "Day": F.dayofmonth(day),
        "Month": F.month(day),
        "Year": F.year(day),
        "Week": F.weekofyear(day),
        "Quarter": F.quarter(day),
        "Day_of_Week": weekday,
        "Is_Weekend": (weekday >= 5).cast("int"),
    }


def year_month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def weekday_name(day: Column) -> Column:
    return F.date_format(day, "EEEE")


def flag_label(flag: Column, off: str, on: str) -> Column:
    return F.when(flag == 0, off).when(flag == 1, on)


def effective_price(requested: Column, catalog: Column) -> Column:
    """The requested price unless it is missing or zero."""
    return F.coalesce(F.nullif(requested, F.lit(0).cast("double")), catalog)


def unfold(df: DataFrame, rows: Sequence[Column]) -> DataFrame:
    """Turn each wide row into several narrow ones; each element of ``rows`` is a struct."""
    return df.select(F.inline(F.array(*rows)))
