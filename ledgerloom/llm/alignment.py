"""Cross-tokenizer alignment: how the tokens of two tokenizers overlap, text by text and corpus-wide.

Both tokenizers read a space and the text. If the bytes of either one's tokens are not those bytes,
the text has no tokens. Byte offsets where tokens of both end cut the tokens into groups. Two tokens
are linked if their byte ranges overlap; two ranges overlap in one stretch without an end inside,
so links are the stretches between all ends. An id pair's count is the number of documents of the
corpus that hold it linked.

A task numbers its documents in blocks and inverts the links of a block: for each id pair a bitmap
of the documents that hold it, and multiplicity planes, bitmap j for the documents whose number of
further links of the pair has bit j set. A bitmap of few documents is kept as their numbers.
Bitmaps of the parts of a block are merged (OR). Popcounts give a pair's documents and links of a
block; blocks hold different documents, so Spark adds them up. The counts, and which pairs have their
A id's greatest count, go back to each block that holds the pair, and its postings add them up for
each document.

Null and empty texts have no tokens: zeros, and an empty digest. Repeated rows and ids count as
documents of their own. Ties for the greatest count all count. An empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import byte_ids
from ledgerloom.llm.store import map_arrow, slices, written

PIECES = "piece_bpe_32k.model"
BLOCK_BYTES = 32 * 1024 * 1024  # of text in a block
BLOCK_DOCS = 1 << 16  # at most, so a number takes 16 bits
DENSE = 16  # a bitmap is kept as numbers if less than one in so many documents is in it


class Tokens:
    """Both tokenizers and the bytes and decimal forms of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        self.a = byte_ids.loaded(path_a, plain=True)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        n_a, n_b = self.a.size, self.b.get_piece_size()
        bytes_a = [self.a.bytes.get(i, b"") for i in range(n_a)]
        bytes_b = [self._piece(i) for i in range(n_b)]
        self.bytes = (bytes_a, bytes_b)
        self.sizes = tuple(np.array([len(x) for x in t], np.int64) for t in self.bytes)
        # The decimal form of an id and what follows it: within its side of a group, at its end.
        self.first_b = 2 * n_a
        self.forms = [b"%d%c" % (i, c) for i in range(n_a) for c in b",|"]
        self.forms += [b"%d%c" % (i, c) for i in range(n_b) for c in b",;"]

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.encode().replace("▁".encode(), b" ")

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of each text by both; none where the joined bytes are not the text's."""
        ids_a = self.a.encode([" " + t for t in texts])
        ids_b = self.b.encode(texts, num_threads=1)
        none = np.zeros(0, np.int64)
        out: tuple[list, list] = ([], [])
        for t, a, b in zip(texts, ids_a, ids_b, strict=True):
            if t and all(
                b"".join(map(form.__getitem__, ids)) == b" " + t.encode()
                for form, ids in zip(self.bytes, (a.tolist(), b), strict=True)
            ):
                out[0].append(a.astype(np.int64))
                out[1].append(np.array(b, np.int64))
            else:
                out[0].append(none)
                out[1].append(none)
        return out


_loaded: dict[tuple[str, str], Tokens] = {}


def loaded(path_a: str | None, path_b: str | None) -> Tokens:
    """One pair of tokenizers per worker process."""
    key = (
        path_a or public_tokenizers.path(byte_ids.VOCABULARY),
        path_b or public_tokenizers.path(PIECES),
    )
    if key not in _loaded:
        _loaded[key] = Tokens(*key)
    return _loaded[key]


class Aligned:
    """The alignment of many texts at once. Both tokenizers end a token at the end of each text,
    so the texts one after the other align like one."""

    def __init__(self, ids_a: list[np.ndarray], ids_b: list[np.ndarray], tokens: Tokens):
        n = len(ids_a)
        self.n_a, self.n_b = (np.array([len(x) for x in ids], np.int64) for ids in (ids_a, ids_b))
        none = np.zeros(0, np.int64)
        a, b = np.concatenate([none, *ids_a]), np.concatenate([none, *ids_b])
        ends_a, ends_b = np.cumsum(tokens.sizes[0][a]), np.cumsum(tokens.sizes[1][b])
        ends = np.concatenate([ends_a, ends_b])
        ends.sort(kind="stable")
        ends = ends[np.append(ends[1:] != ends[:-1], True)] if len(ends) else ends
        at_a, at_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        owner = np.repeat(np.arange(n), self.n_a)
        self.owner = owner[at_a]
        self.pair = a[at_a] << 32 | b[at_b]
        self.n_links = np.bincount(self.owner, minlength=n)
        # Whether a token is the last one of its group.
        both = (ends_a[at_a] == ends) & (ends_b[at_b] == ends)
        last_a, last_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        last_a[at_a[both]] = True
        last_b[at_b[both]] = True
        self.n_groups = np.bincount(self.owner[both], minlength=n)
        # Forms in the order of the groups: a group's A tokens, then its B tokens.
        forms = np.zeros(len(a) + len(b), np.int64)
        if len(forms):
            through_a, through_b = np.flatnonzero(last_a) + 1, np.flatnonzero(last_b) + 1
            group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
            before_b = np.append(0, through_b)[group_a]
            forms[np.arange(len(a)) + before_b] = 2 * a + last_a
            forms[np.arange(len(b)) + through_a[group_b]] = tokens.first_b + 2 * b + last_b
        self.digests = []
        stop = 0
        for size in (self.n_a + self.n_b).tolist():
            start, stop = stop, stop + size
            text = b"".join(map(tokens.forms.__getitem__, forms[start:stop].tolist()))
            self.digests.append(hashlib.sha256(text[:-1]).hexdigest() if text else "")


class Bitmaps:
    """Sets of documents of many keys: numbers where there are few, bits where there are many."""

    def __init__(self, key: np.ndarray, doc: np.ndarray, n_docs: int):
        """Of (key, doc), each pair once, in the order of the keys; keys count from 0."""
        self.n_docs = n_docs
        self.keys, size = np.unique(key, return_counts=True)
        dense = size * DENSE >= n_docs
        of = np.repeat(dense, size)
        self.size = np.where(dense, 0, size)
        self.numbers = doc[~of].astype(np.uint16)
        row = np.repeat(np.cumsum(dense) - 1, size)[of]
        bits = np.zeros((int(dense.sum()), n_docs), bool)
        bits[row, doc[of]] = True
        self.bits = np.packbits(bits, axis=1)
        self.dense = np.flatnonzero(dense)

    def popcounts(self, n_keys: int) -> np.ndarray:
        out = np.zeros(n_keys, np.int64)
        out[self.keys] = self.size
        out[self.keys[self.dense]] = np.bitwise_count(self.bits).sum(axis=1)
        return out

    def members(self) -> tuple[np.ndarray, np.ndarray]:
        """(key, doc) of all members."""
        bits = np.unpackbits(self.bits, axis=1, count=self.n_docs) if len(self.bits) else np.zeros((0, 0))
        row, doc = np.nonzero(bits)
        return (
            np.concatenate([np.repeat(self.keys, self.size), self.keys[self.dense[row]]]),
            np.concatenate([self.numbers.astype(np.int64), doc]),
        )

    def add_up(self, values: np.ndarray, sums: np.ndarray) -> None:
        """Add each key's value to the sums of its documents."""
        np.add.at(sums, self.numbers, np.repeat(values[self.keys], self.size))
        step = max(1, (1 << 24) // self.n_docs)
        for i in range(0, len(self.bits), step):
            bits = np.unpackbits(self.bits[i : i + step], axis=1, count=self.n_docs)
            held = values[self.keys[self.dense[i : i + step]]]
            sums += held @ bits.astype(np.int64)

    def packed(self) -> list[bytes]:
        return [
            np.ascontiguousarray(x).tobytes()
            for x in (self.keys.astype("<i8"), self.size.astype("<i8"), self.numbers, self.bits)
        ]

    @classmethod
    def unpacked(cls, parts: list[bytes], n_docs: int) -> Bitmaps:
        self = cls.__new__(cls)
        self.n_docs = n_docs
        self.keys, self.size = (np.frombuffer(x, "<i8") for x in parts[:2])
        self.numbers = np.frombuffer(parts[2], np.uint16)
        self.bits = np.frombuffer(parts[3], np.uint8).reshape(-1, -(-n_docs // 8))
        self.dense = np.flatnonzero(self.size == 0)
        return self


class Postings:
    """The inverted pairs of a block: a bitmap and multiplicity planes for each id pair."""

    def __init__(self, pairs: np.ndarray, planes: list[Bitmaps], n_docs: int):
        self.pairs, self.planes, self.n_docs = pairs, planes, n_docs

    @classmethod
    def of(cls, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], n_docs: int) -> Postings:
        """Merge the distinct (pair, document, links) of a block's parts."""
        pair, doc, links = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((doc, pair))
        pair, doc, further = pair[order], doc[order], links[order] - 1
        pairs, key = np.unique(pair, return_inverse=True)
        planes = [Bitmaps(key, doc, n_docs)]
        for j in range(int(further.max(initial=0)).bit_length()):
            of = (further >> j & 1).astype(bool)
            planes.append(Bitmaps(key[of], doc[of], n_docs))
        return cls(pairs, planes, n_docs)

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Documents and links of each pair."""
        held, *further = (p.popcounts(len(self.pairs)) for p in self.planes)
        return held, held + sum(x << j for j, x in enumerate(further))

    def scores(self, values: np.ndarray) -> np.ndarray:
        """The sum of the values of all links of each document."""
        sums = np.zeros(self.n_docs, np.int64)
        self.planes[0].add_up(values, sums)
        for j, plane in enumerate(self.planes[1:]):
            plane.add_up(values << j, sums)
        return sums


_OF_DOCUMENT = ("doc_id", "n_a", "n_b", "n_groups", "n_links")
_BLOCKS = (
    "block long, " + ", ".join(f"{c} array<long>" for c in _OF_DOCUMENT) + ", "
    "groups_sha256 array<string>, pairs array<long>, docs array<long>, links array<long>, "
    "planes array<array<binary>>"
)


def blocks(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """A row per block of documents: what each document has, and the postings of its pairs."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = loaded(path_a, path_b)
        number = TaskContext.get().partitionId() << 32
        columns: dict[str, list] = {c: [] for c in (*_OF_DOCUMENT, "groups_sha256")}
        parts: list[tuple] = []
        held = 0

        def block() -> pa.RecordBatch:
            nonlocal number, held
            n_docs = len(columns["doc_id"])
            postings = Postings.of(parts, n_docs)
            n_held, n_links = postings.counts()
            row: dict[str, pa.Array] = {"block": pa.array([number])}
            for c, values in columns.items():
                kind = pa.string() if c == "groups_sha256" else pa.int64()
                row[c] = pa.array([values.copy()], pa.list_(kind))
                values.clear()
            for c, values in (("pairs", postings.pairs), ("docs", n_held), ("links", n_links)):
                row[c] = pa.array([values], pa.list_(pa.int64()))
            planes = [p.packed() for p in postings.planes]
            row["planes"] = pa.array([planes], pa.list_(pa.list_(pa.binary())))
            parts.clear()
            number, held = number + 1, 0
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            for part in slices(batch, "text"):
                texts = [t or "" for t in part.column("text").to_pylist()]
                before = len(columns["doc_id"])
                if before and (before + len(texts) > BLOCK_DOCS or held >= BLOCK_BYTES):
                    yield block()
                    before = 0
                aligned = Aligned(*tokens.encode(texts), tokens)
                # Vocabularies have fewer than 2^24 entries, a slice fewer than 2^16 documents.
                a, b = aligned.pair >> 32, aligned.pair & 0xFFFFFFFF
                keys, links = np.unique((a << 24 | b) << 16 | aligned.owner, return_counts=True)
                pair, owner = keys >> 16, keys & 0xFFFF
                parts.append(((pair >> 24) << 32 | pair & 0xFFFFFF, owner + before, links))
                columns["doc_id"] += part.column("doc_id").to_pylist()
                for c in _OF_DOCUMENT[1:]:
                    columns[c] += getattr(aligned, c).tolist()
                columns["groups_sha256"] += aligned.digests
                held += sum(map(len, texts))
        if columns["doc_id"]:
            yield block()

    return map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), work, _BLOCKS)


def pair_counts(held: DataFrame) -> DataFrame:
    """Corpus-wide, for each linked pair of ids: a, b, the number of documents, of links, and
    whether no pair of the A id has more documents."""
    each = held.select(F.explode(F.arrays_zip("pairs", "docs", "links")).alias("x"))
    counts = each.groupBy(F.col("x.pairs").alias("pair")).agg(
        F.sum("x.docs").alias("docs"), F.sum("x.links").alias("links")
    )
    counts = written(counts, "pair-counts")
    a = F.shiftright("pair", 32)
    # As many rows as the vocabulary has entries, at most.
    most = counts.groupBy(a.alias("a")).agg(F.max("docs").alias("most"))
    return counts.withColumn("a", a).join(most, "a").select(
        "pair",
        "a",
        F.expr("pair & 4294967295").alias("b"),
        "docs",
        "links",
        (F.col("docs") == F.col("most")).alias("best"),
    )


def _scored(held: DataFrame, counts: DataFrame) -> DataFrame:
    """Per document of each block, the sums over its links."""
    wanted = held.select(F.col("block").alias("of"), F.explode("pairs").alias("pair"))
    of_block = wanted.join(counts.select("pair", "docs", "best"), "pair")
    schema = (
        ", ".join(f"{c} long" for c in (*_OF_DOCUMENT, "n_best", "count_sum"))
        + ", groups_sha256 string"
    )

    def work(key, block: pa.Table, found: pa.Table) -> pa.Table:
        row = block.to_batches()[0]
        doc_ids = row.column("doc_id")[0].values
        n_docs = len(doc_ids)
        pairs = row.column("pairs")[0].values.to_numpy()
        order = np.argsort(found.column("pair").to_numpy())
        docs = found.column("docs").to_numpy()[order]
        best = found.column("best").to_numpy()[order].astype(np.int64)
        planes = [Bitmaps.unpacked(p, n_docs) for p in row.column("planes")[0].as_py()]
        postings = Postings(pairs, planes, n_docs)
        columns = {c: row.column(c)[0].values for c in _OF_DOCUMENT}
        columns["n_best"] = pa.array(postings.scores(best))
        columns["count_sum"] = pa.array(postings.scores(docs))
        columns["groups_sha256"] = row.column("groups_sha256")[0].values
        return pa.table(columns)

    rows = held.select("block", *_OF_DOCUMENT, "groups_sha256", "pairs", "planes")
    return rows.groupBy("block").cogroup(of_block.groupBy("of")).applyInArrow(work, schema)


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    held = written(blocks(docs, path_a, path_b), "alignment-blocks")
    return _scored(held, written(pair_counts(held), "pair-counts"))


def op11(docs: DataFrame) -> DataFrame:
    return align(docs)
