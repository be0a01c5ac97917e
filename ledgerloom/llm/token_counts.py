"""Token counts by greedy longest match, without building the pieces.

A trie of the vocabulary has, at each node, a failure link and the number of pieces that are
settled when it is followed: the longest match of the node's text is popped, again and again, until
what is left is a node again. So one walk over a word, with no step back in the text, counts its
pieces in linear time (Song et al., Fast WordPiece Tokenization, 2021).

Words are matches of a pattern in the text's NFC in lower case, as bytes. A vocabulary whose later
pieces carry a prefix has a root of its own for those. A mark at the end of pieces that may end a
word is taken off: greedy matching would else find no piece for many ends. A word of which some
part is in no piece counts as one unknown token.

Null text is read as empty; an empty text has no words and no tokens. Repeated rows are counted
again each. Other columns are not read.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.store import map_arrow, slices
from ledgerloom.llm.word_bpe import byte_alphabet

VOCABULARY = "word_bpe_49k.json"
WORDS = r"\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
CACHE_WORDS = 400_000  # a worker's memory of words starts anew when it is full
_CHUNK = re.compile("[\t-\r ]+")


class LongestMatch:
    def __init__(self, first: Iterable[bytes], later: Iterable[bytes] | None):
        """`later`: pieces that may follow others; None if they are the same as `first`."""
        self.next: list[dict[int, int]] = [{}]
        self.piece = [False]
        self._insert(0, first)
        self.follow = 0
        if later is not None:
            self.follow = self._node()
            self._insert(self.follow, later)
        n = len(self.next)
        self.failure: list[int] = [-1] * n
        self.pops = [0] * n
        self._link()

    def _node(self) -> int:
        self.next.append({})
        self.piece.append(False)
        return len(self.next) - 1

    def _insert(self, root: int, pieces: Iterable[bytes]) -> None:
        for piece in pieces:
            node = root
            for s in piece:
                if s not in self.next[node]:
                    self.next[node][s] = self._node()
                node = self.next[node][s]
            self.piece[node] = self.piece[node] or bool(piece)

    def _link(self) -> None:
        level = [0] if self.follow == 0 else [0, self.follow]
        while level:
            below = []
            for node in level:
                for s, child in self.next[node].items():
                    below.append(child)
                    if self.piece[child]:
                        self.failure[child], self.pops[child] = self.follow, 1
                        continue
                    at, popped = self.failure[node], self.pops[node]
                    while at >= 0 and s not in self.next[at]:
                        popped += self.pops[at]
                        at = self.failure[at]
                    if at >= 0:
                        self.failure[child], self.pops[child] = self.next[at][s], popped
            level = below

    def count(self, word: bytes) -> int:
        """Pieces of one word; 1 if it has a part that no piece covers."""
        after, failure, pops = self.next, self.failure, self.pops
        node = found = 0
        for s in word:
            while s not in after[node]:
                found += pops[node]
                node = failure[node]
                if node < 0:
                    return 1
            node = after[node][s]
        while node != self.follow and node != 0:
            found += pops[node]
            node = failure[node]
            if node < 0:
                return 1
        return found


class TokenCounter:
    def __init__(self, vocabulary: Iterable[str], end: str = "</w>", prefix: str = "",
                 byte_level: bool = True):
        """`end` marks pieces that end a word, `prefix` those that follow others; empty if the
        vocabulary has no such mark."""
        byte_of = {c: b for b, c in byte_alphabet().items()} if byte_level else {}

        def raw(piece: str) -> bytes:
            body = piece.removesuffix(end)
            known = byte_level and all(c in byte_of for c in body)
            return bytes(byte_of[c] for c in body) if known else body.encode()

        listed = list(vocabulary)
        if prefix:
            first = [raw(p) for p in listed if not p.startswith(prefix)]
            later = [raw(p.removeprefix(prefix)) for p in listed if p.startswith(prefix)]
            self.automaton = LongestMatch(first, later)
        else:
            self.automaton = LongestMatch(map(raw, listed), None)
        self.pattern = regex.compile(WORDS)
        self.chunks: dict[str, tuple[int, int]] = {}

    def _chunk(self, chunk: str) -> tuple[int, int]:
        words = self.pattern.findall(unicodedata.normalize("NFC", chunk).lower())
        return len(words), sum(self.automaton.count(w.encode()) for w in words)

    def count(self, texts: list[str]) -> list[tuple[int, int]]:
        """Words and tokens of each text."""
        split = [[c for c in _CHUNK.split(t) if c] for t in texts]
        known = self.chunks
        if len(known) > CACHE_WORDS:
            known.clear()
        for chunk in set().union(*split) - known.keys():
            known[chunk] = self._chunk(chunk)
        out = []
        for chunks in split:
            counts = [known[c] for c in chunks]
            out.append((sum(c[0] for c in counts), sum(c[1] for c in counts)))
        return out


_loaded: dict[str, TokenCounter] = {}


def loaded(path: str) -> TokenCounter:
    """One automaton per worker process, from the vocabulary of a tokenizer file."""
    if path not in _loaded:
        with open(path, encoding="utf-8") as f:
            held = json.load(f)
        special = {t["content"] for t in held["added_tokens"]}
        _loaded[path] = TokenCounter(p for p in held["model"]["vocab"] if p not in special)
    return _loaded[path]


def token_counts(df: DataFrame, path: str | None = None, id_column: str = "doc_id",
                 text_column: str = "text") -> DataFrame:
    """The id of each row, n_words and n_tokens."""
    path = path or public_tokenizers.path(VOCABULARY)
    kind = df.schema[id_column].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = loaded(path)
        for batch in batches:
            for part in slices(batch, "text"):
                found = counter.count([t or "" for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": part.column("id"),
                        "n_words": pa.array([f[0] for f in found], pa.int64()),
                        "n_tokens": pa.array([f[1] for f in found], pa.int64()),
                    }
                )

    rows = df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    schema = f"id {kind}, n_words long, n_tokens long"
    return map_arrow(rows, work, schema).withColumnRenamed("id", id_column)


def op7(docs: DataFrame) -> DataFrame:
    return token_counts(docs)
