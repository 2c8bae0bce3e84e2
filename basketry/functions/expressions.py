"""Column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_window(date: Column, as_of, months: int) -> Column:
    """True from `months` months before `as_of` to `as_of`, both ends included."""
    day = F.lit(as_of).cast("date")
    return date.between(F.add_months(day, -months), day)


def fiscal_period(date: Column, months_back: int = 3) -> Column:
    """YYYYMM of the month `months_back` months before the date."""
    day = F.add_months(date, -months_back)
    return (F.year(day) * 100 + F.month(day)).cast("int")


def days_between(later: Column, earlier: Column) -> Column:
    return F.abs(F.datediff(later, earlier)).cast("bigint")


def unit_price(gross: Column, units: Column) -> Column:
    """Gross sales per unit, null when no unit was sold."""
    return F.try_divide(gross, units)


def valid_type(type_id: str, description: str) -> Column:
    """Product types worth recommending. A null description fails the test."""
    return (F.col(type_id) > 0) & (F.col(description) != "UNKNOWN")


def region_of(territory: Column, codes: Mapping[str, Sequence[str]], default: str) -> Column:
    """Region of a territory code, whatever its case and padding."""
    code = F.upper(F.trim(territory))
    branches = list(codes.items())
    first, rest = branches[0], branches[1:]
    chain = reduce(
        lambda acc, item: acc.when(code.isin(*item[1]), item[0]),
        rest,
        F.when(code.isin(*first[1]), first[0]),
    )
    return chain.otherwise(default)


def as_number(column: Column) -> Column:
    """Double, or null where the value is not a number."""
    number = column.try_cast("double")
    return F.when(~F.isnan(number), number)


def one_if(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also where it is null)."""
    return F.when(condition, 1).otherwise(0).cast("bigint")
