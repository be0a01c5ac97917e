"""Schema constraints as reports: keys, references, required columns, widths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import PRIMARY_KEYS, REFERENCES, REQUIRED, STAR
from ..sources.raw import stacked


def key_violations(df: DataFrame, key: str) -> DataFrame:
    """Key values that are missing or occur more than once."""
    return (
        df.groupBy(F.col(key).cast("string").alias("key_value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .where((F.col("n") > 1) | F.col("key_value").isNull())
    )


def audit_keys(tables: dict[str, DataFrame], keys: dict[str, str] | None = None) -> DataFrame:
    return stacked(
        key_violations(tables[table], key).select(
            F.lit(table).alias("table_name"), "key_value", "n"
        )
        for table, key in (keys or PRIMARY_KEYS).items()
    )


def orphans(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Referring values without a partner, counted before the join; NULL is allowed."""
    used = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return used.join(parent.select(F.col(key).alias("value")), "value", "left_anti")


def audit_references(tables: dict[str, DataFrame], references=REFERENCES) -> DataFrame:
    """One row per orphaned value of each reference."""
    return stacked(
        orphans(tables[child], column, tables[parent], PRIMARY_KEYS[parent]).select(
            F.lit(child).alias("table_name"),
            F.lit(column).alias("column_name"),
            F.col("value").cast("string").alias("value"),
            "n",
        )
        for child, column, parent in references
    )


def _counted(table: str, df: DataFrame, conditions: dict[str, Column], name: str) -> DataFrame:
    """All conditions of a table in one aggregate, then one row per column."""
    counts = df.agg(*[F.count_if(cond).alias(c) for c, cond in conditions.items()])
    return counts.unpivot([], list(conditions), "column_name", name).select(
        F.lit(table).alias("table_name"), "column_name", name
    )


def audit_required(tables: dict[str, DataFrame], required=REQUIRED) -> DataFrame:
    return stacked(
        _counted(table, tables[table], {c: F.col(c).isNull() for c in columns}, "n_missing")
        for table, columns in required.items()
    )


def _too_wide(field: T.StructField) -> Column | None:
    c = F.col(field.name)
    if isinstance(field.dataType, T.DecimalType):
        return F.abs(c) >= 10 ** (field.dataType.precision - field.dataType.scale)
    if field.metadata.get("width"):
        return F.char_length(c) > field.metadata["width"]
    return None


def audit_widths(tables: dict[str, DataFrame], schemas=STAR) -> DataFrame:
    """Values that do not fit the declared text width or number range, per column."""
    parts = []
    for table, df in tables.items():
        checks = {f.name: _too_wide(f) for f in schemas[table].fields if f.name in df.columns}
        checks = {c: cond for c, cond in checks.items() if cond is not None}
        if checks:
            parts.append(_counted(table, df, checks, "n_too_wide"))
    return stacked(parts)
