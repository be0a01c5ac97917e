"""Date expressions: unreadable text becomes missing, never an error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_date(c: Column, formats: Sequence[str] = ("yyyy-MM-dd",)) -> Column:
    return F.coalesce(*[F.try_to_date(c, f) for f in formats])


def month_start(c: Column) -> Column:
    return F.trunc(c, "MM")


def parse_month(c: Column, formats: Sequence[str] = ("yyyy-MM-dd",)) -> Column:
    """First day of the month from `Apr-18`, or from a full date.

    Two-digit years 69..99 lie in the 1900s.
    """
    label = F.try_to_date(F.initcap(c), "MMM-yy")
    label = F.when(F.year(label) >= 2069, F.add_months(label, -1200)).otherwise(label)
    return month_start(F.coalesce(label, parse_date(c, formats)))
