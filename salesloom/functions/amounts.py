"""Exact money, shares and changes.

Money is added up as whole numbers of the smallest amount that staging keeps, a
hundredth of a cent: a total does not depend on the order in which partitions
are merged, and adding bigints is several times cheaper than adding decimals.
The number is read off the amount itself. An amount that is no whole number of
these stops the job; it is never rounded.

A bigint holds one amount, but not the total of many large ones. ``Wide`` adds
up the low and the high bits of a number in columns of their own, level by
level, and joins them to a decimal once few rows are left. Its columns hold the
sums of 2.2e12 rows whose amounts stay below 400 million, of 3.9e7 rows of the
largest amount there is; beyond that ANSI mode, Spark's default, stops the job
rather than let a total wrap.

Totals become doubles only at the end, each the double closest to the exact
total. Every division yields null on a zero divisor, also under ANSI mode.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from itertools import zip_longest

from pyspark.sql import Column
from pyspark.sql import functions as F

# Staged as decimals of a machine word; what they cannot hold exactly is refused, not rounded.
SCALE = 4
MONEY = f"decimal(18,{SCALE})"
RATE = f"decimal(9,{SCALE})"
UNITS = 10**SCALE

_LIMB_BITS = 22
_LIMB = (1 << _LIMB_BITS) - 1
# below this many of the smallest amounts, a double times their number in one is right to the half
EXACT_AS_DOUBLE = 1 << 50


def units(amount: Column | str) -> Column:
    """An amount or a rate in its smallest kept parts, 10,000 to one, as a bigint."""
    return _scaled(_column(amount), UNITS)


def cents(amount: Column | str, per_unit: int = 100) -> Column:
    """A money amount in hundredths; also a rate in percent points.

    ``per_unit`` is how many of the smallest amounts make one. An amount between
    two of them is an error, as is one that is infinite; null stays null.
    """
    return _scaled(_column(amount), per_unit)


def _scaled(amount: Column, per_unit: int) -> Column:
    """The exact number of 1/per_unit in a decimal of at most four places, or in a double.

    Decimal arithmetic costs many times what a double costs, so it is left to
    the amounts of which doubles are too coarse: of a decimal below the bound,
    the double's error times ``per_unit`` stays below a half.
    """
    rough = amount.cast("double")
    whole = F.rint(rough * per_unit)
    # the double closest to a decimal is also the closest to its parts divided again
    near = F.when(whole / per_unit == rough, whole.cast("bigint"))
    exact = amount.try_cast(f"decimal(22,{SCALE})")
    many = (exact * per_unit).cast(f"decimal(28,{SCALE})")
    far = F.when((exact.cast("double") == rough) & (F.floor(many) == many), F.floor(many).cast("bigint"))
    found = F.when(F.abs(rough) < EXACT_AS_DOUBLE / per_unit, near).otherwise(far)
    message = F.concat(F.lit(f"not a whole number of 1/{per_unit}: "), amount.cast("string"))
    return F.when(amount.isNotNull(), F.coalesce(found, F.raise_error(message).cast("bigint")))


def from_cents(total: Column | str) -> Column:
    return _column(total).cast("double") / 100


def from_units(total: Column | str, places: int = SCALE) -> Column:
    """The double closest to a whole number of 10^-places."""
    whole = _column(total).cast(f"decimal({37 - places},0)")
    return (whole * F.lit(Decimal(1).scaleb(-places))).cast("double")


def money_sum(amount: Column | str) -> Column:
    """Exact sum of a money column, as a double."""
    return Wide.of(units(amount)).sum().amount()


def wide_sum(whole: Column) -> Column:
    """Sum of bigints as a decimal, added up in parts that do not overflow."""
    return Wide.of(whole).sum().whole()


@dataclass(frozen=True)
class Wide:
    """A whole number as columns: the sum of the i-th times 2^(22 i).

    Adding up each column adds up the numbers, so partial sums stay bigints
    through any number of aggregates and joins. Null is null in all columns.
    """

    limbs: tuple[Column, ...]

    @classmethod
    def of(cls, whole: Column) -> Wide:
        return cls((whole.bitwiseAND(F.lit(_LIMB)), F.shiftright(whole, _LIMB_BITS)))

    @classmethod
    def named(cls, name: str, limbs: int = 2) -> Wide:
        """The number that ``columns`` wrote under a name."""
        return cls(tuple(F.col(f"{name}_{i}") for i in range(limbs)))

    def columns(self, name: str) -> list[Column]:
        return [limb.alias(f"{name}_{i}") for i, limb in enumerate(self.limbs)]

    def times(self, factor: Column) -> Wide:
        """The number, of two limbs, times a bigint whose product with either is one too."""
        low, high = self.limbs
        low = low * factor
        high = high * factor + F.shiftright(low, _LIMB_BITS)
        return Wide((low.bitwiseAND(F.lit(_LIMB)), *Wide.of(high).limbs))

    def minus(self, other: Wide) -> Wide:
        pairs = zip_longest(self.limbs, other.limbs)
        nothing = self.limbs[0] * 0, other.limbs[0] * 0  # null where the number is
        return Wide(tuple((nothing[0] if a is None else a) - (nothing[1] if b is None else b) for a, b in pairs))

    def sum(self) -> Wide:
        return Wide(tuple(F.sum(limb) for limb in self.limbs))

    def whole(self) -> Column:
        """The number as a decimal."""
        parts = [limb.cast("decimal(19,0)") * F.lit(Decimal(1 << i * _LIMB_BITS)) for i, limb in enumerate(self.limbs)]
        total = parts[0]
        for part in parts[1:]:
            total = total + part
        return total.cast("decimal(38,0)")

    def amount(self, places: int = SCALE) -> Column:
        """The number of 10^-places as a double."""
        return from_units(self.whole(), places)


def fraction(part: Column | str, whole: Column | str) -> Column:
    return F.try_divide(_column(part).cast("double"), _column(whole).cast("double"))


def percent(part: Column | str, whole: Column | str) -> Column:
    return fraction(part, whole) * 100


def growth_percent(now: Column | str, before: Column | str) -> Column:
    """Change against an earlier value; null without one or when it is zero."""
    now, before = _column(now).cast("double"), _column(before).cast("double")
    return F.try_divide(now - before, before) * 100


def guarded_change(now: Column | str, before: Column | str) -> Column:
    """Percent change with fixed answers at zero: 100 from zero, -100 to zero."""
    now, before = _column(now).cast("double"), _column(before).cast("double")
    return (
        F.when(before == 0, F.lit(100.0))
        .when(now == 0, F.lit(-100.0))
        .otherwise(F.try_divide(now - before, before) * 100)
    )


def zero_if_null(value: Column | str) -> Column:
    return F.coalesce(_column(value), F.lit(0))


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
