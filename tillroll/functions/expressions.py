"""Scalar and aggregate expressions.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so
it stays inside whole-stage codegen; nothing runs in Python per row.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from typing import Iterable

from pyspark.sql import Column, functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalise_text(c: ColumnOrName) -> Column:
    """``lower(trim(c))``: only blanks are trimmed, accents are kept."""
    return F.lower(F.trim(_col(c)))


def parse_ts(c: ColumnOrName) -> Column:
    """Raw text -> wall-clock timestamp, NULL when unparseable.

    Parsed as TIMESTAMP_NTZ so the value never depends on the session time
    zone; ``try_cast`` keeps junk text as NULL under ANSI mode.
    """
    return _col(c).try_cast("timestamp_ntz")


def any_null(columns: Iterable[str]) -> Column:
    """True when at least one of ``columns`` is NULL (F2)."""
    return reduce(lambda acc, c: acc | F.col(c).isNull(), columns, F.lit(False))


def first_null_reason(columns: Iterable[str], prefix: str = "null:") -> Column:
    """``'null:<name>'`` of the first NULL column in list order, else NULL."""
    return F.coalesce(*[F.when(F.col(c).isNull(), F.lit(prefix + c)) for c in columns],
                      F.lit(None).cast("string"))


def delay_flag(delivered: ColumnOrName, estimated: ColumnOrName) -> Column:
    """1 = delivered after the estimate, 0 = on time (also when the estimate
    is unknown), NULL = not delivered yet (X6, X7)."""
    d, e = _col(delivered), _col(estimated)
    return (F.when(d.isNull(), F.lit(None).cast("int"))
            .when(d > e, F.lit(1))
            .otherwise(F.lit(0)))


#: A double below 2^51 millionths that is a whole number of them is known as such.
MILLIONTHS = 1000000
MOST_MILLIONTHS = float(1 << 51)


def money_parts(c: ColumnOrName) -> dict[str, Column]:
    """Aggregates of a money column that merge by sums and ``bool_and``.

    ``units`` and ``millionths``: the sum of the amounts that are decimals of at
    most six places, in two long sums, which do not depend on the order of the
    rows; ``whole``: whether all are (NULL without amounts); ``plain``: the sum
    of the doubles.
    """
    x = _col(c)
    m = F.rint(x * float(MILLIONTHS))
    exact = (F.abs(m) < MOST_MILLIONTHS) & (m / float(MILLIONTHS) == x)
    m = F.when(exact, m.cast("long"))
    units = F.try_sum(F.floor(m / MILLIONTHS))
    whole = F.bool_and(exact)
    return {"units": units, "millionths": F.try_sum(F.pmod(m, F.lit(MILLIONTHS))),
            "whole": F.when(whole & units.isNull(), F.lit(False)).otherwise(whole), "plain": F.sum(x)}


def money_of(units: Column, millionths: Column, whole: Column, plain: Column, digits: int = 2) -> Column:
    """The amount that the (merged) parts stand for, rounded half-up once."""
    small = millionths.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-6))
    exact = F.round(units.cast("decimal(27,6)") + small, digits).cast("double")
    return F.coalesce(F.when(whole, exact), F.round(plain, digits))


def _all_exact(x: Column, kind: str) -> tuple[Column, Column]:
    """(values as decimals, whether every non-NULL value is one exactly)."""
    d = x.try_cast(kind)
    return d, F.count_if(d.cast("double") == x) == F.count(x)


def money_sum(c: ColumnOrName, digits: int = 2) -> Column:
    """``round(sum(c), digits)`` of a money column, as double.

    Where every amount is a decimal of at most six places and under 2*10^9, the
    sum is exact, so it does not depend on partitioning or row order, and is
    rounded half-up once.  Otherwise (larger or finer amounts, NaN, infinities,
    or a sum of 9*10^18 units) it is the plain double sum.
    """
    return money_of(**money_parts(c), digits=digits)


def exact_mean(c: ColumnOrName, scale: int = 12) -> Column:
    """Mean of a double; independent of summation order where every value is
    a decimal of ``scale`` places (any coordinate), else the plain mean."""
    x = _col(c)
    d, exact = _all_exact(x, f"decimal(18,{scale})")
    return F.coalesce(F.when(exact, F.try_sum(d).cast("double") / F.count(x)), F.avg(x))


def rounded_mean(c: ColumnOrName, digits: int) -> Column:
    """``round(avg(c), digits)``, half-up; NULLs ignored."""
    return F.round(F.avg(_col(c)), digits)


def first_value_by(value: ColumnOrName, order: ColumnOrName) -> Column:
    """Non-NULL value at the lowest ``order``, NULL orders last, then the
    smallest value: a total order.  NULL when every value is NULL.

    Deterministic stand-in for ``first(value, ignorenulls=True)``.
    """
    v, o = _col(value), _col(order)
    first = F.min(F.when(v.isNotNull(), F.struct(o.isNull().alias("last"), o.alias("order"), v.alias("value"))))
    return first["value"]


def sort_key(order_col: ColumnOrName | None, ties: Iterable[str]) -> list[Column]:
    """Ascending, NULLs-first sort: parsed ``order_col`` then tie-breakers."""
    keys = [] if order_col is None else [parse_ts(order_col).asc_nulls_first()]
    return keys + [F.col(c).asc_nulls_first() for c in ties]
