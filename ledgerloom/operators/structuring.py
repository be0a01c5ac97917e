"""From text to types: dates, keys, numbers, and first profiles of the data."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import parse_date, parse_month
from ..functions.numbers import money, whole
from ..functions.text import product_key
from ..rules import Rules
from ..schemas import REFUSED, STAR, UNREADABLE, joined_notes
from ..sources.raw import stacked

# Columns whose raw form differs from the declared type.
_SPECIAL = {
    ("fact_opex", "month"): "month label",
    ("fact_purchase_order", "quantity_ordered"): "number",
}

_READ = "_read_"

DISCRETE = (
    ("dim_product", "category"),
    ("fact_sales", "payment_mode"),
    ("dim_employee", "role"),
)


def _typed(table: str, name: str, declared: T.DataType, rules: Rules) -> Column:
    c = F.col(name)
    special = _SPECIAL.get((table, name))
    if name == "product_id":
        return product_key(c)
    if special == "month label":
        return parse_month(c, rules.date_formats)
    if special == "number" or isinstance(declared, T.DecimalType):
        return money(c)
    if isinstance(declared, T.DateType):
        return parse_date(c, rules.date_formats)
    if isinstance(declared, (T.LongType, T.IntegerType)):
        return whole(c)
    return c


def _may_be_unreadable(table: str, name: str, declared: T.DataType) -> bool:
    """Dates and ordered quantities are read with errors taken as missing."""
    special = _SPECIAL.get((table, name))
    return special is not None or isinstance(declared, T.DateType)


def structure_table(table: str, raw: DataFrame, rules: Rules) -> DataFrame:
    """Type one raw table, with notes of the texts that could not be read.

    An unreadable date or ordered quantity is missing, and noted in `unreadable_values`.
    Any other unreadable number is noted in `refused_values`, with which a row is not loaded.
    Whole numbers are read as BIGINT and money with four decimals, whatever is declared: the
    rules see large values, and only publishing narrows them.

    Each text is read once, into a column of its own; value and note both come from that column,
    and a note is only put together in a row that has lost a text.
    """
    declared = STAR[table]
    read, lost = {}, {REFUSED: [], UNREADABLE: []}
    for c in raw.columns:
        read[_READ + c] = _typed(table, c, declared[c].dataType, rules)
        if not isinstance(declared[c].dataType, T.StringType) and c != "product_id":
            kind = UNREADABLE if _may_be_unreadable(table, c, declared[c].dataType) else REFUSED
            lost[kind].append(c)
    notes = []
    for kind, columns in lost.items():
        missing = {c: F.col(c).isNotNull() & F.col(_READ + c).isNull() for c in columns}
        texts = [F.when(m, F.concat(F.lit(c + "="), F.col(c))) for c, m in missing.items()]
        some = reduce(or_, missing.values(), F.lit(False))
        notes.append(F.when(some, joined_notes(texts)).alias(kind))
    typed = [F.col(_READ + c).alias(c) for c in raw.columns]
    return raw.withColumns(read).select(*typed, *notes)


def structure(raw: dict[str, DataFrame], rules: Rules) -> dict[str, DataFrame]:
    return {name: structure_table(name, df, rules) for name, df in raw.items()}


def table_profile(tables: dict[str, DataFrame], weight: str = "copies") -> DataFrame:
    """Rows and missing values per date column after parsing, one pass per table.

    One line per date column, or a single line without a column for a table that
    has no dates. Rows of a table with a `copies` column count that many times.
    """
    parts = []
    for name, df in tables.items():
        size = F.col(weight) if weight in df.columns else F.lit(1)
        dates = [c for c, kind in df.dtypes if kind == "date"]
        counts = df.agg(
            F.coalesce(F.sum(size), F.lit(0)).alias("n_rows"),
            *[
                F.coalesce(F.sum(F.when(F.col(c).isNull(), size)), F.lit(0)).alias(c)
                for c in dates
            ],
        )
        if dates:
            lines = counts.unpivot("n_rows", dates, "column_name", "n_missing")
        else:
            lines = counts.withColumns(
                {"column_name": F.lit(None).cast("string"), "n_missing": F.lit(0).cast("bigint")}
            )
        parts.append(
            lines.select(F.lit(name).alias("table_name"), "n_rows", "column_name", "n_missing")
        )
    return stacked(parts)


def missing_dates(tables: dict[str, DataFrame]) -> DataFrame:
    profile = table_profile(tables).where("column_name is not null")
    return profile.select("table_name", "column_name", "n_missing")


def domain_profile(
    tables: dict[str, DataFrame], columns: Iterable[tuple[str, str]] = DISCRETE
) -> DataFrame:
    """How often each value of a discrete column occurs; missing is a value too."""
    return stacked(
        tables[table]
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(f"{table}.{column}").alias("column_name"), "value", "n")
        for table, column in columns
    )


def distinct_rows(df: DataFrame) -> DataFrame:
    """Equal rows once, with the number of copies in `copies`.

    Copies are counted before the shuffle, so a row repeated a billion times
    travels once per task. The counts also give the raw figures without a rescan.
    """
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies"))


def grain_check(rows: DataFrame, keys: Sequence[str] = ("transaction_id", "product_id")):
    """Number of rows, copies included, that share their grain with another row."""
    return (
        rows.groupBy(*keys)
        .agg(F.sum("copies").alias("n"))
        .where("n > 1")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"))
    )
