"""What the operators share: input tables, tables that cut lineage, code for the executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import ledgerloom
from ledgerloom.session import _CLEANUP as _CLEANUP
from ledgerloom.session import freed_shuffles, shared_folder

# Bytes of text that a Python task turns over at once, whatever the Arrow batch holds.
SLICE_BYTES = 4 * 1024 * 1024
BATCH_BYTES = 16 * 1024 * 1024
FILTER_BITS = 27  # of the bitmap of wanted keys: 16 MB

_shipped: set[str] = set()
kept: dict[str, tuple[bytes, object]] = {}  # what a worker holds from task to task


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: it cuts the lineage, and a
    lost executor costs no more than the stage that reads it. The shuffles that made it are not
    read again, so their files go at once."""
    spark = df.sparkSession
    app = spark.sparkContext.applicationId
    folder = f"{shared_folder(spark)}/ledgerloom-llm/{app}/{name}-{uuid.uuid4().hex}"
    with freed_shuffles(spark):
        df.write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def text_key(text: str | Column) -> Column:
    """16 bytes of a text's SHA-256: texts with the same key are taken as equal."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def likely(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The rows whose key is likely to be in `wanted`, a table of one column: none that is in it
    is lost, and few others stay as long as there are fewer keys than bits. It keeps long texts
    that no join will find from being shuffled to it. The bitmap has a fixed size, whatever the
    input; where the keys outnumber its bits, it lets all rows pass, and the join does its work."""
    bit = F.expr(f"xxhash64(`{key}`) & {(1 << FILTER_BITS) - 1}") + 1
    marks = (
        wanted.select(F.xxhash64(wanted.columns[0]).alias("__h"))
        .select((F.expr(f"__h & {(1 << FILTER_BITS) - 1}") + 1).alias("__bit"))
        .groupBy(F.expr("bitmap_bucket_number(__bit)").alias("__part"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(__bit))").alias("__marks"))
    )
    byte = F.expr("substring(__marks, cast(__place div 8 as int) + 1, 1)")
    marked = F.conv(F.hex(byte), 16, 10).cast("int").bitwiseAND(
        F.expr("shiftleft(1, cast(__place % 8 as int))")
    )
    return (
        rows.withColumn("__bit", bit)
        .withColumn("__part", F.expr("bitmap_bucket_number(__bit)"))
        .withColumn("__place", F.expr("bitmap_bit_position(__bit)"))
        .join(F.broadcast(marks), "__part")
        .where(marked != 0)
        .drop("__bit", "__part", "__place", "__marks")
    )


def prepare(spark: SparkSession) -> None:
    """Send this package to the executors once per application, and bound Arrow batches."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = os.path.dirname(os.path.abspath(ledgerloom.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="ledgerloom-code-"), "ledgerloom.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("ledgerloom", os.path.relpath(path, top)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into row ranges of about `limit` bytes of a text column."""
    sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_pylist()
    start = total = 0
    for i, size in enumerate(sizes):
        if total and total + size > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield batch.slice(start)


def map_arrow(
    df: DataFrame,
    work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str | T.StructType,
    keep: bool = False,
) -> DataFrame:
    """mapInArrow. Workers outlive their tasks: what is kept in one goes as soon as it gets a task
    that does not say `keep`, so that a model takes no memory from the steps that follow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keep:
            forget()
        yield from work(batches)

    prepare(df.sparkSession)
    return df.mapInArrow(run, schema)


def forget() -> None:
    kept.clear()
