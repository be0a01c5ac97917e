"""Packing by lexical retrieval: each sequence holds a document and the documents most like it.

Texts are tokenized once and written. A document of at least a sequence's length fills sequences of
its own; what is left of each document is a unit. Units are dealt to shards by range of a signature
(least hashes of their tokens), so that alike units tend to lie in the same shard and equal ones
side by side. A shard is what a task packs: it has one inverted index over the token ids of all its
units with BM25 weights; document frequencies and the mean length are those of all units of the
corpus (one number a vocabulary entry at most), counted while they are tokenized. The first unused
unit is the seed of a window. The index scores all unused units of the shard for the seed, and they
fill the window greedily: the best one that still fits, and so on; when none fits, the best one is
cut, its head fills the window and its tail is the next seed. So no window but a shard's last has
room left, and that one is cut into sequences whose lengths are powers of two, which need no padding.

Every seed meets every unused unit of its shard, so the work for an id grows with the shard, whose
size is bounded. Units of other shards are no neighbours: which units are unused is known to one task.

Each id lies in exactly one piece. Null text is read as empty: a document of the end id only.
Repeated rows and ids are packed again each; a null id stays null. Ties of the score go to the
unit that comes first in its shard. An empty table gives no pieces. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import byte_ids
from ledgerloom.llm.store import map_arrow, slices, written
from ledgerloom.llm.words import mix

END = 1
LENGTH = 2048
SHARD_IDS = 1 << 22  # ids in a shard, about: some 30 MB of postings
SHARD_UNITS = 1 << 15  # units in a shard, about
LEAST_IDS = 1 << 18  # of a shard, where there are fewer ids than that for each partition
K1, B = 1.2, 0.75  # the usual parameters of BM25
_PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)


def _signature(tokens: np.ndarray) -> int:
    """Two least hashes of distinct tokens in one number: equal texts have the same, alike texts
    often the same first half."""
    tokens = tokens.astype(np.uint64)
    first = int(mix(tokens).min()) >> 33
    return first << 32 | int(mix(tokens + np.uint64(1 << 40)).min()) >> 32


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def units(docs: DataFrame, length: int = LENGTH, path: str | None = None) -> DataFrame:
    """Per document: doc_id, doc_tokens, `crcs` of the windows it fills, the ids left (`rest`,
    little-endian), their number n and signature. One more row a task, with a null doc_tokens, has
    in `crcs` how many of its units hold each token, and in n and signature the numbers of its
    units and of their ids."""
    schema = "doc_id long, doc_tokens long, crcs array<long>, rest binary, n long, signature long"
    kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.int64(), pa.int64())
    names = [c.split()[0] for c in schema.split(", ")]

    def rows(columns) -> pa.RecordBatch:
        held = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(held, names=names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = byte_ids.loaded(path, plain=False)
        end = np.array([END], tokenizer.dtype)
        seen = np.zeros(tokenizer.size, np.int64)
        n_units = n_ids = 0
        for batch in batches:
            for part in slices(batch, "text"):
                out = []
                texts = [t or "" for t in part.column("text").to_pylist()]
                for doc, ids in zip(part.column("doc_id").to_pylist(), tokenizer.encode(texts), strict=True):
                    ids = np.concatenate([ids, end])
                    whole = len(ids) // length * length
                    rest, signature = ids[whole:], 0
                    if len(rest):
                        tokens = np.unique(rest)
                        seen[tokens] += 1
                        n_units, n_ids = n_units + 1, n_ids + len(rest)
                        signature = _signature(tokens)
                    crcs = [_crc(ids[at : at + length]) for at in range(0, whole, length)]
                    out.append((doc, len(ids), crcs, rest.tobytes(), len(rest), signature))
                yield rows(zip(*out, strict=True))
        yield rows([[None], [None], [seen], [None], [n_units], [n_ids]])

    return map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), work, schema)


def _ids(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, f"<u{len(raw) // n}")


def frequencies(held: DataFrame) -> DataFrame:
    """token and the number of units that hold it; token -1 has the units, -2 all their ids."""
    counts = F.concat(F.array(-F.col("signature"), -F.col("n")), "crcs")
    each = held.where("doc_tokens is null").select(F.posexplode(counts).alias("at", "units"))
    each = each.where("units <> 0").groupBy((F.col("at") - 2).alias("token"))
    return each.agg(F.abs(F.sum("units")).alias("units"))


class Index:
    """Postings of units by token, each with its BM25 weight. Tokens are numbered within the index.
    A token that more than one unit in DENSE holds is a row over all units instead."""

    DENSE = 8

    def __init__(self, held: list[np.ndarray], idf: np.ndarray, mean: float):
        lengths = np.array([len(x) for x in held])
        owner = np.repeat(np.arange(len(held)), lengths)
        keys = (np.concatenate(held).astype(np.int64) << 32) | owner
        keys, often = np.unique(keys, return_counts=True)
        token, unit = keys >> 32, keys & 0xFFFFFFFF
        long = K1 * (1 - B + B * lengths[unit] / mean)
        weight = idf[token] * often * (K1 + 1) / (often + long)
        tokens, token = np.unique(token, return_inverse=True)
        self.n = len(held)
        order = np.argsort(unit, kind="stable")
        self.of_unit = np.split(token[order], np.cumsum(np.bincount(unit, minlength=self.n))[:-1])
        self.left = np.arange(self.n)  # the units that have postings
        size = np.bincount(token, minlength=len(tokens))
        frequent = np.flatnonzero(size * self.DENSE > self.n)
        self.row = np.full(len(tokens), -1)
        self.row[frequent] = np.arange(len(frequent))
        self.rows = np.zeros((len(frequent), self.n), np.float32)
        dense = self.row[token] >= 0
        self.rows[self.row[token[dense]], unit[dense]] = weight[dense]
        self._file(token[~dense], unit[~dense], weight[~dense])

    def _file(self, token: np.ndarray, unit: np.ndarray, weight: np.ndarray) -> None:
        self.token, self.unit, self.weight = token, unit, weight
        self.first = np.searchsorted(token, np.arange(len(self.row) + 1))

    def drop(self, used: np.ndarray) -> None:
        """Take the postings of used units out."""
        stays = ~used[self.left]
        number = np.cumsum(stays) - 1
        left = stays[self.unit]
        self._file(self.token[left], number[self.unit[left]], self.weight[left])
        self.rows = self.rows[:, stays]
        self.left = self.left[stays]

    def scores(self, seed: int) -> np.ndarray:
        """Of each unit for the distinct tokens of one of them."""
        query = self.of_unit[seed]
        rows = self.row[query]
        found = np.zeros(len(self.left), np.float32)
        for row in rows[rows >= 0]:
            found += self.rows[row]
        parts = [slice(self.first[t], self.first[t + 1]) for t in query[rows < 0]]
        out = np.zeros(self.n)
        out[self.left] = found
        if parts:
            units = np.concatenate([self.unit[p] for p in parts])
            weights = np.concatenate([self.weight[p] for p in parts])
            out[self.left] += np.bincount(units, weights, len(self.left))
        return out


class Windows:
    """Windows that are filled one after the other, with the pieces in them."""

    def __init__(self, length: int, first: int):
        self.length, self.room, self.sequence = length, length, first
        self.out: list[tuple] = []
        self.open: list[tuple] = []  # doc_id, start, ids, doc_tokens

    def put(self, doc, start: int, ids: np.ndarray, doc_tokens: int) -> None:
        self.open.append((doc, start, ids, doc_tokens))
        self.room -= len(ids)
        if not self.room:
            self._close([self.length])

    def _close(self, sizes: list[int]) -> None:
        """Write the open pieces as sequences of these sizes."""
        sizes = sizes[::-1]
        offset, size = 0, sizes.pop()
        for doc, start, ids, doc_tokens in self.open:
            while len(ids):
                if offset == size:
                    offset, size = 0, sizes.pop()
                    self.sequence += 1
                part = ids[: size - offset]
                self.out.append(
                    (doc, start, len(part), _crc(part), doc_tokens, self.sequence, offset)
                )
                start, ids, offset = start + len(part), ids[len(part) :], offset + len(part)
        self.sequence += 1
        self.open, self.room = [], self.length

    def end(self) -> None:
        left = self.length - self.room
        if left:
            self._close([1 << b for b in reversed(range(left.bit_length())) if left >> b & 1])


def fill(windows: Windows, shard: list[tuple], idf: np.ndarray, mean: float) -> None:
    """Put a shard's units (doc_id, start, ids, doc_tokens) into windows, neighbours of each seed
    first. The last window may stay open."""
    if not shard:
        return
    index = Index([u[2] for u in shard], idf, mean)
    used = np.zeros(len(shard), bool)
    sizes = np.array([len(u[2]) for u in shard])
    left, seed = len(shard), 0
    indexed = left

    def put(i: int, n: int) -> None:
        """The next n ids of unit i."""
        nonlocal left
        doc, start, ids, doc_tokens = shard[i]
        at = len(ids) - int(sizes[i])
        windows.put(doc, start + at, ids[at : at + n], doc_tokens)
        sizes[i] -= n
        if not sizes[i]:
            used[i] = True
            left -= 1

    while left:
        while used[seed]:
            seed += 1
        # A window that is open when the first seed comes is filled up with its neighbours too.
        now = seed
        while True:
            query = now
            put(now, min(int(sizes[now]), windows.room))
            if not left or windows.room == windows.length and not sizes[now]:
                break
            if windows.room == windows.length:
                continue  # the seed itself was cut
            if left * 2 < indexed:
                index.drop(used)
                indexed = left
            scores = index.scores(query)
            scores[used] = -1
            cut = -1
            while windows.room < windows.length and left:
                best = int(np.argmax(np.where(sizes <= windows.room, scores, -1)))
                if scores[best] < 0 or sizes[best] > windows.room:
                    cut = int(np.argmax(scores))
                    break
                scores[best] = -1
                put(best, int(sizes[best]))
            if cut < 0:
                break
            now = cut  # its head fills the window, its tail is the next seed


def _shards(rest: DataFrame, n_ids: int, n_units: int) -> DataFrame:
    """Units in ranges of their signature; the uid keeps many equal ones from one range."""
    spark = rest.sparkSession
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = max(1, min(usual, n_ids // LEAST_IDS), -(-n_ids // SHARD_IDS), -(-n_units // SHARD_UNITS))
    dealt = rest.repartitionByRange(n, "signature", "uid")
    return dealt.sortWithinPartitions("signature", "uid")


def pack(held: DataFrame, length: int = LENGTH) -> DataFrame:
    """Pieces and their places, of a table as `units` makes it."""
    held = written(held.withColumn("uid", F.monotonically_increasing_id()), "units")
    alone = (
        held.where("doc_tokens is not null and size(crcs) > 0")
        .select("doc_id", "doc_tokens", F.posexplode("crcs").alias("window", "ids_crc32"))
        .select(
            "doc_id",
            (F.col("window") * F.lit(length).cast("long")).alias("start"),
            F.lit(length).cast("long").alias("length"),
            "ids_crc32",
            "doc_tokens",
            (-1 - F.monotonically_increasing_id()).alias("sequence_id"),
            F.lit(0).cast("long").alias("offset"),
        )
    )
    rest = held.where("doc_tokens is not null and n > 0")
    # One number for each entry of the vocabulary at most.
    seen = {r["token"]: r["units"] for r in frequencies(held).collect()}
    n_units, n_ids = seen.pop(-1, 0), seen.pop(-2, 0)
    if not n_units:
        return alone
    often = np.zeros(max(seen) + 1, np.int64)
    often[list(seen)] = list(seen.values())
    idf = np.log1p((n_units - often + 0.5) / (often + 0.5)).astype(np.float32)
    mean = n_ids / n_units

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(length, TaskContext.get().partitionId() << 40)
        shard: list[tuple] = []
        for batch in batches:
            for doc, n, raw, total in zip(
                *(batch.column(c).to_pylist() for c in ("doc_id", "n", "rest", "doc_tokens")),
                strict=True,
            ):
                shard.append((doc, total - n, _ids(raw, n), total))
        fill(windows, shard, idf, mean)
        windows.end()
        columns = list(zip(*windows.out, strict=True)) or [()] * 7
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns],
            names=[c.split()[0] for c in _PIECES.split(", ")],
        )

    shards = _shards(rest, n_ids, n_units).select("doc_id", "n", "rest", "doc_tokens")
    return alone.unionByName(map_arrow(shards, work, _PIECES))


def op12(docs: DataFrame) -> DataFrame:
    return pack(units(docs))
