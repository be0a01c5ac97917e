"""Raw text files in, all columns as text, missing tokens as NULL."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import missing_to_null
from ..schemas import OPTIONAL, RAW_TABLES, raw_columns
from ..session import freed_shuffles
from .stitched import has_line_breaks, records

_CSV = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


# Holds the line where it has not as many fields as the header.
_MALFORMED = "_malformed"


def _rows(spark: SparkSession, path: str, multiline: bool, mode: str) -> DataFrame:
    reader = spark.read.options(**_CSV)
    columns = [T.StructField(c, T.StringType()) for c in reader.csv(path).columns]
    options = {**_CSV, "mode": mode}
    if mode == "PERMISSIVE":
        columns.append(T.StructField(_MALFORMED, T.StringType()))
        options["columnNameOfCorruptRecord"] = _MALFORMED
    schema = T.StructType(columns)
    if multiline and has_line_breaks(spark, path):
        declared = ", ".join(f"`{c.name}` string" for c in columns)
        row = F.from_csv("record", declared, {k: v for k, v in options.items() if k != "header"})
        # Through a generator, so that each record is read once and with all of its fields.
        return records(spark, path).select(F.inline(F.array(row)))
    # Lines are only held against the header if all of their fields are read.
    options |= {"enforceSchema": "false", "columnPruning": "false"}
    return reader.options(**options).schema(schema).csv(path)


def _malformed(rows: DataFrame) -> Column:
    """A text that is empty for a good line. Spark refuses to scan nothing but the lines that
    are malformed, so that it also looks at a column, if only rows are counted."""
    first = F.coalesce(rows.columns[0], F.lit(""))
    return F.coalesce(F.concat(first, F.col(_MALFORMED)), F.lit(""))


def scan_text(
    spark: SparkSession, path: str, multiline: bool = True, skip_malformed: bool = False
) -> DataFrame:
    """A text file, or a folder of them, by header; all columns as text.

    Files of a folder whose headers differ are an error, and so is a record with fewer or more
    fields than the header; to skip such records, read them with `malformed_lines` as well.
    Quoted texts may hold line breaks: where a first look at the quotes finds any, lines are put
    together to records (see `stitched`). Without `multiline` that look is spared, and either half
    of a quoted line break is malformed.
    """
    if not skip_malformed:
        return missing_to_null(_rows(spark, path, multiline, "FAILFAST"))
    rows = _rows(spark, path, multiline, "PERMISSIVE")
    return missing_to_null(rows.where(_malformed(rows) == "").drop(_MALFORMED))


def malformed_lines(
    spark: SparkSession,
    folder: str,
    tables: Iterable[str] = RAW_TABLES,
    multiline: bool = True,
) -> DataFrame:
    """table_name and line of all records that `skip_malformed` leaves out."""
    parts = []
    for table in tables:
        rows = _rows(spark, f"{folder}/{table}.csv", multiline, "PERMISSIVE")
        found = rows.where(_malformed(rows) != "")
        parts.append(found.select(F.lit(table).alias("table_name"), F.col(_MALFORMED).alias("line")))
    return stacked(parts)


def scan_raw(
    spark: SparkSession,
    folder: str,
    tables: Iterable[str] = RAW_TABLES,
    multiline: bool = True,
    skip_malformed: bool = False,
) -> dict[str, DataFrame]:
    """Read `<folder>/<table>.csv` for every table; columns may stand in any order."""
    scanned = {}
    for table in tables:
        df = scan_text(spark, f"{folder}/{table}.csv", multiline, skip_malformed)
        expected = raw_columns(table)
        unknown = set(df.columns) - set(expected)
        missing = set(expected) - set(df.columns) - OPTIONAL.get(table, set())
        if unknown or missing:
            raise ValueError(f"{table}: header lacks {sorted(missing)}, adds {sorted(unknown)}")
        scanned[table] = df.select([c for c in expected if c in df.columns])
    return scanned


# A packed text file is read by one task, so it holds no more rows than this.
_PACKED_ROWS = 1_000_000


def write_csv(df: DataFrame, path: str, packed: bool = False) -> None:
    """A folder of text files with headers; `packed` ones are compressed, and many if they must."""
    writer = df.write.mode("overwrite").options(**_CSV)
    if packed:
        writer = writer.options(compression="gzip", maxRecordsPerFile=str(_PACKED_ROWS))
        # A fifth larger than at the usual level, for a quarter of the time that packing takes.
        writer = writer.option("zlib.compress.level", "BEST_SPEED")
    with freed_shuffles(df.sparkSession):
        writer.csv(path)


def raw_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, df in tables.items()
    ]
    return stacked(parts)


def stacked(parts: Iterable[DataFrame]) -> DataFrame:
    parts = list(parts)
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
