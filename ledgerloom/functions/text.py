"""Text expressions: missing tokens, whitespace, keys, title case, lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Field texts a raw file uses for "no value".
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# The characters counted as whitespace, Unicode spaces included.
WHITESPACE_CODES = (
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
WHITESPACE = "".join(map(chr, WHITESPACE_CODES))
# A character no text contains, to mark places inside an expression.
MARK = chr(1) + " "


def missing_to_null(df: DataFrame) -> DataFrame:
    """Turn every missing token of an all-text table into NULL."""
    return df.select(
        [F.when(~F.col(c).isin(*MISSING_TOKENS), F.col(c)).alias(c) for c in df.columns]
    )


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def product_key(c: Column) -> Column:
    """`12.0`, ` 12 ` and `12` are the same product; a missing key stays missing."""
    return strip(F.regexp_replace(c, r"\.0$", ""))


def title_case(c: Column) -> Column:
    """Capital after every non-letter; initcap alone only looks at spaces."""
    opened = F.regexp_replace(c, r"([^\p{L}])", "$1" + MARK)
    return F.replace(F.initcap(opened), F.lit(MARK), F.lit(""))


def mapped(c: Column, table: dict[str, str]) -> Column:
    """Exact-match lookup in a literal table, NULL where there is no entry."""
    pairs = [F.lit(part) for item in table.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), c)
