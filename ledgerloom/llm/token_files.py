"""Token-ID output: documents' ids in ascending order of doc_id, packed by Simple-8b.

Documents are range partitioned by id; each partition is a shard. A shard is a sequence of pages,
a page some whole documents: their ids packed as in simple8b, with the documents' ids and lengths.
Pages are written as rows of a binary column through Spark's own writer, so that retried tasks
leave no half-written files and any store that Spark reaches will do.

Null text is read as empty: such a document holds only the end id. Rows with the same doc_id all
stay, in order of their text's hash; a null doc_id comes first. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm import simple8b, word_bpe
from ledgerloom.llm.store import map_arrow, slices, written

END = 2
PAGE_IDS = 1 << 17  # a page is closed with the document that reaches this
PAGES = (
    "shard int, page long, first long, n_ids long, doc_ids array<bigint>, "
    "lengths array<bigint>, packed binary"
)


def write_pages(docs: DataFrame, path: str | None = None, end: int = END) -> DataFrame:
    """Encode documents and return the pages, to be written by any writer of Spark."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_bpe.loaded(path)
        tail = end.to_bytes(4, "little")
        shard, page, first = TaskContext.get().partitionId(), 0, 0
        names: list[int | None] = []
        held: list[bytes] = []

        def close() -> pa.RecordBatch:
            nonlocal page, first, names, held
            ids = np.frombuffer(b"".join(held), "<u4")
            row = {
                "shard": shard, "page": page, "first": first, "n_ids": len(ids),
                "doc_ids": names, "lengths": [len(h) // 4 for h in held],
                "packed": simple8b.pack(ids),
            }
            page, first, names, held = page + 1, first + len(ids), [], []
            return pa.RecordBatch.from_pylist([row], schema=_ARROW)

        size = 0
        for batch in batches:
            for part in slices(batch, "text"):
                texts = [t or "" for t in part.column("text").to_pylist()]
                ids = tokenizer.encode(texts)
                for name, x in zip(part.column("doc_id").to_pylist(), ids, strict=True):
                    names.append(name)
                    held.append(x + tail)
                    size += len(x) // 4 + 1
                    if size >= PAGE_IDS:
                        size = 0
                        yield close()
        if names:
            yield close()

    order = [F.col("doc_id"), F.xxhash64("text")]
    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(*order)
    return map_arrow(ordered.sortWithinPartitions(*order), work, PAGES)


_ARROW = pa.schema(
    [
        ("shard", pa.int32()), ("page", pa.int64()), ("first", pa.int64()),
        ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())), ("packed", pa.binary()),
    ]
)


def read_ids(pages: DataFrame) -> DataFrame:
    """doc_id, shard, first (ids before it in its shard) and ids (little-endian unsigned 32-bit
    integers) of each document, from written pages."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = simple8b.unpack(row["packed"]).astype("<u4").tobytes()
                ends = np.cumsum(np.array(row["lengths"], np.int64))
                starts = ends - row["lengths"]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array(row["doc_ids"], pa.int64()),
                        "shard": pa.array([row["shard"]] * len(ends), pa.int32()),
                        "first": pa.array(starts + row["first"], pa.int64()),
                        "ids": pa.array(
                            [ids[4 * a : 4 * b] for a, b in zip(starts, ends, strict=True)],
                            pa.binary(),
                        ),
                    }
                )

    return map_arrow(pages, work, "doc_id long, shard int, first long, ids binary")


def shard_starts(pages: DataFrame) -> DataFrame:
    """Ids before each shard. The window sees one row per shard, so it is as long as there are
    partitions, never as there are documents."""
    totals = pages.groupBy("shard").agg(F.sum("n_ids").alias("total"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))


def op9(docs: DataFrame) -> DataFrame:
    pages = written(write_pages(docs), "token-pages")
    # One row per shard: a few bytes for each partition of the shuffle.
    starts = F.broadcast(shard_starts(pages))
    return (
        read_ids(pages)
        .join(starts, "shard")
        .select(
            "doc_id",
            (F.col("base") + F.col("first")).alias("start"),
            (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
            F.crc32("ids").alias("ids_crc32"),
        )
    )


def files(spark: SparkSession, folder: str) -> DataFrame:
    """Pages that `write_pages(...).write.parquet(folder)` has left."""
    return spark.read.schema(PAGES).parquet(folder)
