"""Exact dedup by an extendible-hash index on shared files.

A bucket holds the texts whose 64-bit hash begins with its bits. Starting from one bucket, a bucket
of more than BUCKET_BYTES is split by one more bit, and where its depth is that of the directory,
the directory doubles; sizes come from a histogram of hash prefixes, which is all the driver sees.
Tasks combine equal texts, then each bucket's owner chains the texts of one hash and compares them
byte by byte, so texts that only share a hash stay apart. Owners write the index: per distinct text
its bucket, hash, place in the chain, digest, kept id and number of copies. Documents look their
text up in it.

Null text is read as empty. Of the rows that repeat both the text and the kept id one is kept. A
null id is less than any other; if a group has no other, one of its rows is kept and keep_id is
null. Other columns are not read by the index.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.store import map_arrow, slices, written

BUCKET_BYTES = 1 << 20
MAX_DEPTH = 18  # bits of the directory, and hence 2**18 rows of the histogram at most
_ENTRIES = "bucket int, hash long, chain int, text_sha256 string, keep_id long, group_size long"


def directory(sizes: dict[int, int], depth: int, capacity: int) -> np.ndarray:
    """Bucket of each hash prefix, from the bytes of each prefix of `depth` bits. The directory
    has as many bits as its deepest bucket; a prefix that is overfull by itself keeps its bucket."""
    full = np.zeros(1 << depth, np.int64)
    for prefix, size in sizes.items():
        full[prefix] = size
    levels = [full]
    while len(levels[0]) > 1:
        levels.insert(0, levels[0].reshape(-1, 2).sum(axis=1))
    buckets = np.zeros(1, np.int64)  # the directory: bucket of each prefix of as many bits
    local = np.zeros(1, np.int64)  # depth of each bucket
    for bits in range(depth):
        over = levels[bits] > capacity
        splits = over & (local[buckets] == bits)
        if not splits.any():
            break
        buckets = np.repeat(buckets, 2)  # doubling
        at = np.flatnonzero(splits)
        new = len(local) + np.arange(len(at))
        local[buckets[2 * at]] += 1
        local = np.append(local, np.full(len(at), bits + 1))
        buckets[2 * at + 1] = new
    return buckets.astype(np.int32)


def _combined(texts: DataFrame, buckets: np.ndarray) -> DataFrame:
    """One row per distinct text of a batch, with its bucket."""
    bits = len(buckets).bit_length() - 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[bytes, list] = {}
            names = batch.column("doc_id").to_pylist()
            hashes = batch.column("hash").to_pylist()
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for name, key, text in zip(names, hashes, texts, strict=True):
                entry = held.setdefault(text, [key, name, 0])
                entry[2] += 1
                if entry[1] is None or (name is not None and name > entry[1]):
                    entry[1] = name
            keys = np.array([e[0] for e in held.values()], np.int64)
            prefix = (keys.view(np.uint64) >> np.uint64(64 - bits)) if bits else keys * 0
            yield pa.RecordBatch.from_pydict(
                {
                    "bucket": pa.array(buckets[prefix.astype(np.int64)]),
                    "hash": pa.array(keys),
                    "text": pa.array(held, pa.binary()),
                    "keep_id": pa.array([e[1] for e in held.values()], pa.int64()),
                    "group_size": pa.array([e[2] for e in held.values()], pa.int64()),
                }
            )

    schema = "bucket int, hash long, text binary, keep_id long, group_size long"
    return map_arrow(texts, work, schema)


def _owned(entries: DataFrame) -> DataFrame:
    """The index entries of buckets whose texts come one bucket after the other."""

    def close(bucket: int, chains: dict[int, list[list]]) -> pa.RecordBatch:
        rows = [
            (bucket, key, i, hashlib.sha256(text).hexdigest(), keep, size)
            for key, chain in chains.items()
            for i, (text, keep, size) in enumerate(chain)
        ]
        names = [c.split()[0] for c in _ENTRIES.split(", ")]
        types = [pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, chains = None, {}
        for batch in batches:
            for part in slices(batch, "text"):
                for row in part.to_pylist():
                    if row["bucket"] != now:
                        if chains:
                            yield close(now, chains)
                        now, chains = row["bucket"], {}
                    chain = chains.setdefault(row["hash"], [])
                    for entry in chain:
                        if entry[0] == row["text"]:
                            entry[2] += row["group_size"]
                            if entry[1] is None or (
                                row["keep_id"] is not None and row["keep_id"] > entry[1]
                            ):
                                entry[1] = row["keep_id"]
                            break
                    else:
                        chain.append([row["text"], row["keep_id"], row["group_size"]])
        if chains:
            yield close(now, chains)

    return map_arrow(entries, work, _ENTRIES)


def _hash(text: str) -> F.Column:
    return F.xxhash64(text)


def build_index(
    docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, max_depth: int = MAX_DEPTH, hash_of=_hash
) -> DataFrame:
    """The index of the distinct texts of `docs` (doc_id, text), on the shared folder."""
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.withColumn("hash", hash_of("text"))
    prefix = F.shiftrightunsigned("hash", 64 - max_depth).alias("prefix")
    sizes = texts.groupBy(prefix).agg(F.sum(F.octet_length("text") + 16).alias("size")).toArrow()
    found = zip(sizes["prefix"].to_pylist(), sizes["size"].to_pylist(), strict=True)
    buckets = directory(dict(found), max_depth, bucket_bytes)
    entries = _combined(texts, buckets).repartition("bucket").sortWithinPartitions("bucket")
    return written(_owned(entries), "hash-index")


def mark(docs: DataFrame, index: DataFrame, hash_of=_hash) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of each document."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long"),
        F.sha2(text, 256).alias("text_sha256"),
        hash_of(text).alias("hash"),
    )
    entries = index.select("hash", "text_sha256", "keep_id", "group_size")
    once = F.row_number().over(Window.partitionBy("text_sha256", "doc_id").orderBy("hash")) == 1
    return rows.join(entries, ["hash", "text_sha256"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & once).alias("kept"),
        "text_sha256",
    )


def op5(docs: DataFrame) -> DataFrame:
    return mark(docs, build_index(docs))


OP5_SQL = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents) d
"""
