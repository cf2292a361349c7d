"""Grade arithmetic of the reports."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.schemas import NUMBER

# Whole numbers that the reports' decimals reach.
WHOLE = "decimal(20,0)"


def ratio(numerator: Column, denominator: Column) -> Column:
    """Decimal quotient, to the places that its type has."""
    return numerator / denominator


def zero_guarded(denominator: Column, value: Column) -> Column:
    """0 where the denominator is 0, ``value`` elsewhere (NULL stays NULL)."""
    return F.when(denominator == 0, F.lit(0)).otherwise(value)


def once(made: Callable[[Column], Column], **values: Column) -> Column:
    """What ``made`` makes of a struct of ``values``, each computed once however often it is named.

    An expression inside a branch is otherwise computed anew wherever it is named,
    with all that it consists of.
    """
    return F.transform(F.array(F.struct(*[v.alias(n) for n, v in values.items()])), made)[0]


def below_half(numerator: Column, denominator: Column, halves: Column) -> Column:
    """Whether ``numerator / denominator``, less its whole part, lies below ``halves / 200``, exactly.

    Both are positive, ``halves`` is whole and below 200.
    The denominator is split into 200 times ``whole`` and ``rest``: what is left of
    the numerator after ``whole * halves`` is compared with ``rest * halves / 200``,
    which is below 200. So no product has more digits than a decimal, whatever
    the denominator.
    """

    def split(v: Column) -> Column:
        return once(left_over, part=v.n % v.d, floor=F.floor(v.d), rest=v.d % F.lit(Decimal(200)).cast("decimal(3,0)"), halves=v.halves)

    def left_over(v: Column) -> Column:
        whole = ((v.floor - v.floor % 200) / F.lit(200)).cast(WHOLE)
        return once(compared, left=F.floor(v.part) - (whole * v.halves).cast(WHOLE), part=v.part, rest=v.rest, halves=v.halves)

    def compared(v: Column) -> Column:
        small = v.left.try_cast("decimal(3,0)") + (v.part % F.lit(Decimal(1))).cast("decimal(18,18)")
        near = small * F.lit(Decimal(200)).cast("decimal(3,0)") < v.rest.cast("decimal(21,18)") * v.halves
        return (v.left < 0) | ((v.left < 200) & near)

    return once(split, n=numerator, d=denominator, halves=halves)


def magnitude(value: Column) -> Column:
    """The absolute value; ``abs`` rounds negative decimals of more than 34 digits."""
    return F.when(value < 0, F.substring(value.cast("string"), 2, 64).cast(NUMBER)).otherwise(value)


def grade(numerator: Column, denominator: Column) -> Column:
    """Ratio rounded half away from zero to two places, 0 for a zero denominator.

    The quotient is itself rounded, so one just below a half may look like it.
    Such a one is told by the remainder, which is exact.
    """

    def with_fraction(v: Column) -> Column:
        # The quotient has six places; a double holds its fraction exactly enough to count them.
        fraction = F.abs((v.quotient % F.lit(Decimal(1))).cast("double"))
        return once(settled, n=v.n, d=v.d, quotient=v.quotient, millionths=F.rint(fraction * 1e6).cast("int"))

    def settled(v: Column) -> Column:
        looks_half = v.millionths % 10_000 == 5_000
        halves = (v.millionths / 5_000).cast("decimal(3,0)")
        rounded = F.round(v.quotient, 2)
        down = rounded - F.signum(v.quotient).cast("decimal(1,0)") * F.lit(Decimal("0.01"))
        return F.when(looks_half & below_half(magnitude(v.n), magnitude(v.d), halves), down).otherwise(rounded)

    return zero_guarded(denominator, once(with_fraction, n=numerator, d=denominator, quotient=ratio(numerator, denominator)))
