"""Number expressions that keep a missing value missing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Numbers as they are read and repaired, wider and finer than declared: a value that does not
# fit is refused with its number when it is published, not lost before. Products of them are
# wider still.
MONEY = T.DecimalType(18, 4)
AMOUNT = T.DecimalType(38, 4)
_LARGEST = 2**63 - 1


def whole(c: Column) -> Column:
    """Integer from text; `12.0` is 12, anything not a whole number is missing."""
    exact = c.try_cast("decimal(38,15)")
    return F.coalesce(
        c.try_cast("bigint"), F.when(exact == F.floor(exact), exact.try_cast("bigint"))
    )


def money(c: Column) -> Column:
    return c.try_cast(MONEY)


def clipped(c: Column, low: Column, high: Column) -> Column:
    return F.when(c < low, low).when(c > high, high).otherwise(c)


def outside(c: Column, low, high) -> Column:
    return F.coalesce((c < low) | (c > high), F.lit(False))


def hit(condition: Column) -> Column:
    """A condition that is unknown because of a missing value counts as not met."""
    return F.coalesce(condition, F.lit(False))


def percent_off(amount: Column, percent: Column) -> Column:
    """amount * (1 - percent/100) to the cent, ties to even, in exact decimals."""
    hundredths = F.bround(amount * (F.lit(100) - percent), 0)
    return (hundredths * F.lit("0.01").cast("decimal(2,2)")).try_cast(AMOUNT)


def cents(amount: Column) -> Column:
    """An amount in whole cents; one beyond BIGINT counts as the largest."""
    largest = F.lit(_LARGEST).cast("decimal(19,0)")
    whole_cents = (amount * 100).cast("decimal(38,0)")
    bounded = F.greatest(F.least(whole_cents, largest), -largest)
    return F.when(amount.isNotNull(), bounded.cast("bigint"))
