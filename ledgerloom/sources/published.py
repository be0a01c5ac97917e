"""Published tables: clean, quarantine and the working tables between steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import month_start
from ..session import materialised as materialised
from ..session import PACKED, freed_shuffles, write_table
from .raw import scan_text, write_csv

CLEAN = "clean"
QUARANTINE = "quarantine"


def publish_clean(
    tables: dict[str, DataFrame], folder: str, form: str = "parquet", packed: bool = False
) -> None:
    """`packed` gives text files in the form of `write_csv`; Parquet always is."""
    for name, df in tables.items():
        _write(df, _named(folder, f"{name}_clean", form), form, packed)


def publish_quarantine(df: DataFrame, folder: str, form: str = "parquet") -> None:
    """Written even when empty, so that readers always find the schema."""
    _write(df, _named(folder, "quarantined_fact_sales", form), form)


def read_published(spark: SparkSession, folder: str, name: str, form: str) -> DataFrame:
    path = _named(folder, name, form)
    return scan_text(spark, path) if form == "csv" else spark.read.format(form).load(path)


def _named(folder: str, name: str, form: str) -> str:
    return f"{folder}/{name}.csv" if form == "csv" else f"{folder}/{name}"


def _write(df: DataFrame, path: str, form: str, packed: bool = False) -> None:
    if form == "csv":
        write_csv(df, path, packed)
    elif form == "parquet":
        with freed_shuffles(df.sparkSession):
            write_table(df, path)
    else:
        df.write.mode("overwrite").format(form).save(path)


def write_routed(sales: DataFrame, path: str, sales_date: str = "date_id") -> None:
    """Clean and quarantined rows in one pass, one folder per route and month.

    The rebalance gathers a month in few files and splits a heavy month over many.
    """
    (
        sales.withColumn(
            "route",
            F.when(F.col("quarantine_reason").isNull(), CLEAN).otherwise(QUARANTINE),
        )
        .withColumn("sale_month", month_start(F.col(sales_date)))
        .hint("rebalance", "route", "sale_month")
        .write.mode("overwrite")
        .options(**PACKED)
        .partitionBy("route", "sale_month")
        .parquet(path)
    )


def read_routed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    layout = T.StructType(
        [
            *schema.fields,
            T.StructField("route", T.StringType()),
            T.StructField("sale_month", T.DateType()),
        ]
    )
    return spark.read.schema(layout).parquet(path)
