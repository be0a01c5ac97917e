"""The star schema: declared types, the sentinel employee, the load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..rules import Rules
from ..schemas import LAYOUT, REFUSED, STAR, joined_notes
from ..session import PACKED, freed_shuffles
from ..sources.raw import stacked


def _conformed(df: DataFrame, field: T.StructField) -> Column:
    if field.name not in df.columns:
        return F.lit(None).cast(field.dataType)
    if df.schema[field.name].dataType == field.dataType:
        return F.col(field.name)
    return F.col(field.name).try_cast(field.dataType)


def apply_schema(df: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Cast to the declared types and note every value that does not fit.

    The note travels with the row, so accepted and refused rows are two filters on
    one table rather than two passes. What the table itself has noted stays in the note.
    A column the table lacks is missing throughout.
    """
    given = dict(zip(df.columns, df.schema.fields, strict=True))
    notes = [F.col(REFUSED)] if REFUSED in given else []
    notes += [
        F.when(
            F.col(f.name).isNotNull() & _conformed(df, f).isNull(),
            F.concat(F.lit(f.name + "="), F.col(f.name).cast("string")),
        )
        for f in schema.fields
        if f.name in given and given[f.name].dataType != f.dataType
    ]
    return df.select(
        *[_conformed(df, f).alias(f.name) for f in schema.fields],
        joined_notes(notes).alias(REFUSED),
        *keep,
    )


def accepted(df: DataFrame) -> DataFrame:
    return df.where(F.col(REFUSED).isNull()).drop(REFUSED)


def refused(df: DataFrame) -> DataFrame:
    return df.where(F.col(REFUSED).isNotNull())


def add_sentinel_employee(employee: DataFrame, rules: Rules) -> DataFrame:
    """The row that sales without an employee refer to; a second run adds nothing."""
    spark = employee.sparkSession
    given = {
        "employee_id": F.lit(rules.sentinel_employee),
        "role": F.lit("Unknown"),
        "employment_type": F.lit("Unknown"),
    }
    row = spark.range(1).select(
        [
            given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in employee.schema.fields
        ]
    )
    others = employee.where(~F.col("employee_id").eqNullSafe(rules.sentinel_employee))
    return others.unionByName(row)


def load_star(published: dict[str, DataFrame], rules: Rules) -> dict[str, DataFrame]:
    """The twelve tables under their declared types, the sentinel employee included.

    Published tables already have these types and are read in place; tables read back
    from text are cast, and rows with a value that does not fit are left out.
    """
    star = {}
    for table, schema in STAR.items():
        df = published[table]
        layout = [c for c in LAYOUT.get(table, ()) if c in df.columns]
        if REFUSED in df.columns:
            star[table] = accepted(df.select(*schema.fieldNames(), REFUSED, *layout))
        else:
            star[table] = accepted(apply_schema(df, schema, tuple(layout)))
    star["dim_employee"] = add_sentinel_employee(star["dim_employee"], rules)
    return star


def write_star(star: dict[str, DataFrame], folder: str) -> None:
    """Full refresh of a second copy, for consumers that want plain table folders."""
    for table in STAR:
        df = star[table]
        layout = [c for c in LAYOUT.get(table, ()) if c in df.columns]
        with freed_shuffles(df.sparkSession):
            df.write.mode("overwrite").options(**PACKED).partitionBy(*layout).parquet(f"{folder}/{table}")


def load_verification(star: dict[str, DataFrame]) -> DataFrame:
    tables = ("fact_sales", "fact_sales_quarantine", "dim_product", "dim_employee")
    return stacked(
        star[t].agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("tbl"), "n") for t in tables
    )
