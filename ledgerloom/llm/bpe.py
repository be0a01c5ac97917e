"""Byte-level BPE encoding and decoding with a segment tree over byte positions.

Every position of a word that starts a token is a leaf with the rank of the pair it forms with
its right neighbour; an inner node holds the least (rank, position) below it, so the root is the
leftmost pair of least rank. A merge joins two tokens and updates three leaves: the vanished
right token, the merged token and its left neighbour, each by one walk to the root. Words of
similar length are merged in step, one merge of every word at a time, as numpy rows.

Null text is read as empty. An empty text has no ids. A repeated row is encoded again. Columns
other than the id and the text are not read, so their names cannot clash.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.store import map_arrow, slices

RANKS = "byte_bpe_50k.tiktoken"
CACHE_WORDS = 400_000  # words whose ids a worker remembers; it starts anew when they are full
CELLS = 1 << 15  # leaves of the trees that are merged in step; they stay in the CPU's cache
# Cuts a text into pieces that no match of public_tokenizers.PATTERN crosses: a run without
# white space and a space before it, or white space. Most pieces are in the cache, so the
# pattern itself is only applied to new ones. A caller's own pattern is applied to whole texts.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECES = re.compile(rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
_NONE = np.iinfo(np.int64).max
_SHIFT = 32


class ByteBpe:
    """Ranks as in a rank file: token bytes to rank, which is also the token's id."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.pieces = PIECES if pattern == public_tokenizers.PATTERN else None
        self.cache: dict[str, bytes] = {}
        self.piece_cache: dict[str, bytes] = {}
        left, right, merged = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        pairs = (np.array(left, np.int64) << _SHIFT) | np.array(right, np.int64)
        order = np.argsort(pairs)
        self.pairs = np.append(pairs[order], _NONE)
        self.merged = np.append(np.array(merged, np.int64)[order], 0)
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int64)

    @classmethod
    def load(cls, path: str, pattern: str) -> ByteBpe:
        with open(path, "rb") as f:
            lines = (line.split() for line in f if line.strip())
            return cls({base64.b64decode(token): int(rank) for token, rank in lines}, pattern)

    def _keys(self, a: np.ndarray, b: np.ndarray, position: np.ndarray, valid: np.ndarray):
        """(rank, position) as one number, or none where the two tokens form no token."""
        pair = np.where(valid, (a << _SHIFT) | b, -1)
        at = np.searchsorted(self.pairs, pair)
        return np.where(self.pairs[at] == pair, (self.merged[at] << _SHIFT) | position, _NONE)

    def merge(self, words: list[bytes], size: int) -> list[bytes]:
        """Ids of words of at most `size` bytes, a power of two, as little-endian bytes."""
        n = len(words)
        lengths = np.fromiter(map(len, words), np.int64, n)
        raw = np.frombuffer(b"".join(w.ljust(size, b"\0") for w in words), np.uint8)
        place = np.arange(size)
        token = self.bytes[raw].reshape(n, size)
        live = place < lengths[:, None]
        after = np.broadcast_to(place + 1, (n, size)).copy()
        before = np.broadcast_to(place - 1, (n, size)).copy()
        tree = np.full((n, 2 * size), _NONE)
        if size > 1:
            tree[:, size : 2 * size - 1] = self._keys(
                token[:, :-1], token[:, 1:], place[:-1], live[:, 1:]
            )
        level = size // 2
        while level:
            tree[:, level : 2 * level] = np.minimum(
                tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2]
            )
            level //= 2
        rows = np.flatnonzero(tree[:, 1] != _NONE)
        while len(rows):
            least = tree[rows, 1]
            here, made = least & 0xFFFFFFFF, least >> _SHIFT
            gone = after[rows, here]
            right = after[rows, gone]
            left = before[rows, here]
            token[rows, here] = made
            live[rows, gone] = False
            after[rows, here] = right
            has_right = right < lengths[rows]
            before[rows[has_right], right[has_right]] = here[has_right]
            has_left = left >= 0
            tree[rows, size + gone] = _NONE
            tree[rows, size + here] = self._keys(
                made, token[rows, np.minimum(right, size - 1)], here, has_right
            )
            tree[rows[has_left], size + left[has_left]] = self._keys(
                token[rows[has_left], left[has_left]], made[has_left], left[has_left], True
            )
            node = np.stack([gone, here, np.where(has_left, left, here)]) + size
            while node[0, 0] > 1:
                node >>= 1
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
            rows = rows[tree[rows, 1] != _NONE]
        ids = token[live].astype("<u4").tobytes()
        ends = np.cumsum(live.sum(axis=1)) * 4
        return [ids[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def _learn(self, words: set[str]) -> None:
        """Put the ids of words into the cache."""
        by_size: dict[int, list[tuple[str, bytes]]] = {}
        for word in words:
            raw = word.encode()
            whole = self.ranks.get(raw)
            if whole is not None:
                self.cache[word] = whole.to_bytes(4, "little")
            else:
                by_size.setdefault(1 << (len(raw) - 1).bit_length(), []).append((word, raw))
        for size, found in by_size.items():
            step = max(1, CELLS // size)
            for i in range(0, len(found), step):
                part = found[i : i + step]
                ids = self.merge([raw for _, raw in part], size)
                self.cache.update(zip((word for word, _ in part), ids, strict=True))

    def _ids(self, texts: list[str]) -> list[bytes]:
        split = [self.pattern.findall(t) for t in texts]
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        self._learn(set().union(*split) - self.cache.keys())
        return [b"".join(map(self.cache.__getitem__, words)) for words in split]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if self.pieces is None:
            return self._ids(texts)
        split = [self.pieces.findall(t) for t in texts]
        known = self.piece_cache
        if len(known) > CACHE_WORDS:
            known.clear()
        new = list(set().union(*split) - known.keys())
        known.update(zip(new, self._ids(new), strict=True))
        return [b"".join(map(known.__getitem__, pieces)) for pieces in split]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_loaded: dict[tuple[str, str], ByteBpe] = {}


def loaded(path: str, pattern: str) -> ByteBpe:
    """One encoder per worker process."""
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = ByteBpe.load(path, pattern)
    return _loaded[path, pattern]


def encode(
    df: DataFrame,
    path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    id_column: str = "doc_id",
    text_column: str = "text",
    decoded: bool = False,
) -> DataFrame:
    """The id of each row, `ids` (little-endian unsigned 32-bit, binary) and, if asked for,
    `decoded`, the bytes that the ids stand for."""
    path = path or public_tokenizers.path(RANKS)
    kind = df.schema[id_column].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = loaded(path, pattern)
        for batch in batches:
            for part in slices(batch, "text"):
                ids = coder.encode([t or "" for t in part.column("text").to_pylist()])
                columns = {"id": part.column("id"), "ids": pa.array(ids, pa.binary())}
                if decoded:
                    columns["decoded"] = pa.array(map(coder.decode, ids), pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    schema = f"id {kind}, ids binary" + ", decoded binary" * decoded
    rows = df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return map_arrow(rows, work, schema).withColumnRenamed("id", id_column)


def decode(df: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN,
           id_column: str = "doc_id") -> DataFrame:
    """The id of each row and `decoded`, the bytes of its `ids`; null ids are read as none."""
    path = path or public_tokenizers.path(RANKS)
    kind = df.schema[id_column].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = loaded(path, pattern)
        for batch in batches:
            for part in slices(batch, "ids"):
                texts = [coder.decode(x or b"") for x in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_pydict(
                    {"id": part.column("id"), "decoded": pa.array(texts, pa.binary())}
                )

    rows = df.select(F.col(id_column).alias("id"), "ids")
    return map_arrow(rows, work, f"id {kind}, decoded binary").withColumnRenamed("id", id_column)


def op1(docs: DataFrame) -> DataFrame:
    return encode(docs, decoded=True).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
