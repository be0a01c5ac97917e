"""Toxicity by the nearest labelled examples, with their votes as evidence.

Features are all words and beginnings of words (runs of letters in lower case) that the labelled
examples hold. A text is its TF-IDF vector over them, scaled to length one; document frequencies are
counted over all documents, and a feature that is more frequent in toxic examples than chance would
have it weighs more, by its log-likelihood ratio. The nearest examples by cosine come from an
inverted index of all examples. Two texts share so many features that bounds of blocks of examples
leave most blocks in, and cost more than they save, so all postings of a text are added up. The few
features that most examples hold would fill the postings: their weights are columns of a matrix, and
the texts of a slice are multiplied with it at once, in single precision. Only examples that may be
among the nearest by that sum are added up in double precision.

Neighbours vote with a power of their similarity, times the weight of their class (the examples are
a sample by class, the weights undo it), against a prior vote for the rate of toxic examples, so a
score reads as a chance. A text without features gets the rate among the examples without any, or
the rate of all where there is no such example.

The examples are the bound of the model: EXAMPLES of each class at most, those of least hash of the
id. Everything else is over all rows. Words that no example holds count for nothing. Null texts are read as empty. Labels that are null are left
out; if a document has several, one toxic label makes it toxic. Without labels, or without a toxic
one, there are no features and the score is the rate there is (0 without labels). Documents of equal
text get the same score, repeated rows too. Other columns are not read by a score.
"""

from __future__ import annotations

import dataclasses
import functools
import hashlib
import itertools
import math
import pickle
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.store import kept, map_arrow, slices

EXAMPLES = 5000  # of each class
BEGINNINGS = (4, 5, 6)  # letters of the beginnings of words
EVIDENCE = 25.0  # the log-likelihood ratio that doubles the weight of a feature
MEMO = 1 << 18  # words whose features a worker remembers
QUERIES = 64  # texts that are compared with the columns at once
NEIGHBOURS = 16
COLUMNS = 512  # features that are kept as columns, the most frequent ones of the examples
ROUNDING = 1e-5  # what a cosine in single precision may lack
POWER = 2  # of the similarity in a vote
PRIOR_VOTE = 0.2
THRESHOLD = 0.3
_LETTERS = re.compile(r"[^\W\d_]+")


def features(text: str) -> Counter[str]:
    """Words, and beginnings of longer words marked by a star, with their counts."""
    words = Counter(_LETTERS.findall(text.lower()))
    found = Counter(words)
    for n in BEGINNINGS:
        for word, count in words.items():
            if len(word) > n:
                found[word[:n] + "*"] += count
    return found


class Vocabulary:
    """The features of the examples, by number."""

    def __init__(self, names: list[str]):
        self.names = names
        self.known: dict[str, int] = {}  # made where it is used, in the workers
        self.memo: dict[str, tuple[int, ...]] = {}

    def __len__(self) -> int:
        return len(self.names)

    @functools.cached_property
    def packed(self) -> bytes:
        return zlib.compress("\n".join(self.names).encode())

    def __reduce__(self):
        return _vocabulary, (self.packed,)

    def _of(self, word: str) -> tuple[int, ...]:
        if not self.known:
            self.known.update((name, i) for i, name in enumerate(self.names))
        held = [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) > n)]
        found = tuple(self.known[x] for x in held if x in self.known)
        if len(self.memo) >= MEMO:
            self.memo.clear()
        self.memo[word] = found
        return found

    def counts(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """As features(), but only those that are known: their numbers, ascending, and counts."""
        words = Counter(_LETTERS.findall(text.lower()))
        memo = self.memo
        held = [memo[word] if word in memo else self._of(word) for word in words]
        sizes = np.fromiter(map(len, held), np.int64, len(held))
        numbers = np.fromiter(itertools.chain.from_iterable(held), np.int32, int(sizes.sum()))
        each = np.repeat(np.fromiter(words.values(), np.int32, len(words)), sizes)
        order = np.argsort(numbers)
        numbers = numbers[order]
        first = np.flatnonzero(np.diff(numbers, prepend=-1))
        return numbers[first], np.add.reduceat(each[order], first, dtype=np.int32) if len(first) else each


def _once(kind: str, packed: bytes, make):
    """What `make` gives, made anew in a worker only where the packed form is another one."""
    key = hashlib.sha256(packed).digest()
    if kept.get(kind, (b"",))[0] != key:
        kept[kind] = (key, make())
    return kept[kind][1]


def _vocabulary(packed: bytes) -> Vocabulary:
    def make() -> Vocabulary:
        text = zlib.decompress(packed).decode()
        return Vocabulary(text.split("\n") if text else [])

    return _once("vocabulary", packed, make)


def _ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The numbers of all the ranges, one after the other."""
    sizes = last - first
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + sizes, sizes)


@dataclasses.dataclass
class Index:
    """An inverted index of the examples. Postings are ordered by feature and place."""

    ids: np.ndarray
    toxic: np.ndarray
    posts: np.ndarray  # first posting of each feature
    places: np.ndarray
    weights: np.ndarray
    column: np.ndarray  # of each feature, -1 if it has postings
    matrix: np.ndarray  # weights of the examples in the columns

    @classmethod
    def build(cls, ids, toxic, vectors: list[dict[int, float]], n_features: int) -> Index:
        sizes = [len(v) for v in vectors]
        features = np.array([f for v in vectors for f in v], np.int32)
        weights = np.array([w for v in vectors for w in v.values()], np.float32)
        return cls.of(ids, toxic, sizes, features, weights, n_features)

    @classmethod
    def of(cls, ids, toxic, sizes, features, weights, n_features: int) -> Index:
        """From the vectors one after the other, with their sizes."""
        n = len(sizes)
        places = np.repeat(np.arange(n, dtype=np.uint16 if n < 1 << 16 else np.int32), np.array(sizes, np.int64))
        frequency = np.bincount(features, minlength=n_features)
        column = np.full(n_features, -1, np.int32)
        common = np.argsort(-frequency, kind="stable")[:COLUMNS]
        column[common] = np.arange(len(common), dtype=np.int32)
        matrix = np.zeros((n, len(common)), np.float32)
        held = column[features] >= 0
        matrix[places[held], column[features[held]]] = weights[held]
        features, places, weights = features[~held], places[~held], weights[~held]
        order = np.argsort(features, kind="stable")
        # One after the other: of millions of postings no copies are held longer than needed.
        features = features[order]
        places = places[order]
        weights = weights[order]
        posts = np.searchsorted(features, np.arange(n_features + 1))
        return cls(np.array(ids, np.int64), np.array(toxic, np.int64), posts, places, weights, column, matrix)

    def nearest(self, query: dict[int, float], k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the k nearest examples that share a feature; the earlier place
        wins a tie."""
        features = np.fromiter(query, np.int64, len(query))
        weights = np.fromiter(query.values(), np.float64, len(query))
        return next(self.search([(features, weights)], k))

    def search(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int):
        """As nearest(), of each query in two arrays."""
        n = len(self.ids)
        across = np.zeros((len(queries), self.matrix.shape[1]))
        rest = []
        for row, (features, weights) in zip(across, queries, strict=True):
            columns = self.column[features]
            common = columns >= 0
            row[columns[common]] = weights[common]
            rest.append((features[~common], weights[~common]))
        dense = across.astype(np.float32) @ self.matrix.T
        for row, near, (features, weights) in zip(across, dense, rest, strict=True):
            first, last = self.posts[features], self.posts[features + 1]
            at = _ranges(first, last)
            products = np.repeat(weights, last - first) * self.weights[at]
            sums = np.bincount(self.places[at], products, n)
            # The product of the matrices is in single precision: it says who may be among the k.
            near = near + sums
            least = np.partition(near, n - k)[n - k] if n > k else 0.0
            found = np.flatnonzero(near >= least - ROUNDING)
            yield self._top(found, (sums[found] + self.matrix[found] @ row).round(12), k)

    def _top(self, places: np.ndarray, sums: np.ndarray, k: int):
        some = sums > 0
        places, sums = places[some], sums[some]
        if len(places) > k:
            some = sums >= np.partition(sums, len(sums) - k)[len(sums) - k]
            places, sums = places[some], sums[some]
        best = np.lexsort((places, -sums))[:k]
        return places[best], sums[best]


@dataclasses.dataclass
class Examples:
    """Counts of the features of the examples, one after the other. Their vectors follow from them,
    so this is all of the index that is sent to the workers, and they make it."""

    ids: np.ndarray
    toxic: np.ndarray
    sizes: np.ndarray
    features: np.ndarray  # ascending in each example
    counts: np.ndarray

    def index(self, weight: np.ndarray) -> Index:
        n = len(self.ids)
        raw = ((1 + np.log(self.counts)) * weight[self.features]).astype(np.float32)
        ends = np.cumsum(self.sizes)
        starts = ends - self.sizes
        parts = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        # Examples with the same foremost feature lie in the same blocks, so bounds differ by block.
        foremost = np.array([self.features[a + x.argmax()] for a, x in zip(starts.tolist(), parts, strict=True)])
        for x in parts:
            x /= math.sqrt(float(x.astype(np.float64) @ x))
        order = np.lexsort((np.arange(n), foremost)) if n else np.zeros(0, np.int64)
        at = _ranges(starts[order], ends[order])
        return Index.of(self.ids[order], self.toxic[order], self.sizes[order], self.features[at], raw[at], len(weight))


@dataclasses.dataclass
class Model:
    vocabulary: Vocabulary
    weight: np.ndarray  # of each feature
    examples: Examples
    class_weight: tuple[float, float]
    base: float  # the rate of toxic texts
    bare: float  # and among those without a feature

    @functools.cached_property
    def index(self) -> Index:
        return self.examples.index(self.weight)

    @functools.cached_property
    def packed(self) -> bytes:
        held = self.examples
        steps = np.diff(held.features, prepend=held.features.dtype.type(0))
        fields = (held.ids, held.toxic, held.sizes, steps, held.counts)
        return zlib.compress(pickle.dumps((self.weight, fields, self.class_weight, self.base, self.bare), protocol=5))

    def __reduce__(self):
        return _model, (self.vocabulary, self.packed)

    def vector(self, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
        raw = (1 + np.log(counts)) * self.weight[features]
        return raw / math.sqrt(float(raw @ raw)) if len(raw) else raw

    def scores(self, texts: list[str]) -> Iterator[tuple[float, list[tuple[int, float, int]]]]:
        """Of each text the score, and id, similarity and label of the neighbours it comes from."""
        for start in range(0, len(texts), QUERIES):
            held = [self.vocabulary.counts(t) for t in texts[start : start + QUERIES]]
            queries = [(f, self.vector(f, c)) for f, c in held if len(f)]
            found = self.index.search(queries, NEIGHBOURS)
            for features, _ in held:
                yield self._voted(*next(found)) if len(features) else (self.bare, [])

    def _voted(self, places: np.ndarray, cosines: np.ndarray):
        toxic = self.index.toxic[places]
        votes = np.maximum(cosines, 0) ** POWER * np.array(self.class_weight)[toxic]
        score = (float(votes @ toxic) + PRIOR_VOTE * self.base) / (float(votes.sum()) + PRIOR_VOTE)
        ids = self.index.ids[places].tolist()
        return score, list(zip(ids, cosines.tolist(), toxic.tolist(), strict=True))


def _model(vocabulary: Vocabulary, packed: bytes) -> Model:
    def make() -> Model:
        weight, fields, *rest = pickle.loads(zlib.decompress(packed))
        ids, toxic, sizes, steps, counts = fields
        features = np.cumsum(steps, dtype=steps.dtype)
        return Model(vocabulary, weight, Examples(ids, toxic, sizes, features, counts), *rest)

    return _once("model", packed, make)


def examples(docs: DataFrame, labels: DataFrame, limit: int) -> tuple[DataFrame, dict[int, int]]:
    """Up to `limit` labelled documents of each class (doc_id, text, toxic), and how many documents
    of each class there are."""
    known = labels.where("doc_id is not null and toxic is not null")
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    totals = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    parts = [
        known.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
        for c in (0, 1)
    ]
    # Two integers for each of at most 2 * limit rows.
    chosen = F.broadcast(parts[0].union(parts[1]))
    return docs.select("doc_id", "text").join(chosen, "doc_id"), totals


def _selected(held: DataFrame) -> tuple[list[str], np.ndarray]:
    """The features of the examples, and the log-likelihood ratio of those that speak for toxic
    ones, 0 of the others."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(*(batch.column(c).to_pylist() for c in ("text", "toxic")), strict=True):
                counts[toxic].update(features(text or "").keys())
        names = list(counts[1])
        yield pa.RecordBatch.from_pydict(
            {
                "feature": pa.array([*names, *(counts[0].keys())], pa.string()),
                "toxic": pa.array([1] * len(names) + [0] * len(counts[0]), pa.int32()),
                "n": pa.array([*(counts[1][x] for x in names), *counts[0].values()], pa.int64()),
            }
        )

    sizes = {r["toxic"]: float(r["count"]) for r in held.groupBy("toxic").count().collect()}
    if not sizes.get(1) or not sizes.get(0):
        return [], np.zeros(0)
    n1, n0 = sizes[1], sizes[0]
    counted = (
        map_arrow(held.select("text", "toxic"), work, "feature string, toxic int, n long")
        .groupBy("feature")
        .agg(
            F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("a"),
            F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("b"),
        )
        .toArrow()  # at most the words of 2 * limit documents
        .sort_by("feature")
    )
    a, b = (counted.column(c).to_numpy().astype(float) for c in ("a", "b"))
    total = n1 + n0

    def part(n: np.ndarray, expected: np.ndarray) -> np.ndarray:
        held = n > 0
        return np.where(held, n * np.log(np.where(held, n, 1) / np.where(held, expected, 1)), 0.0)

    ratio = 2 * (
        part(a, (a + b) * n1 / total)
        + part(b, (a + b) * n0 / total)
        + part(n1 - a, (total - a - b) * n1 / total)
        + part(n0 - b, (total - a - b) * n0 / total)
    )
    ratio = np.where(a / n1 > b / n0, np.maximum(ratio, 0), 0)
    return counted.column("feature").to_pylist(), ratio


def _document_frequencies(docs: DataFrame, vocabulary: Vocabulary) -> tuple[np.ndarray, int]:
    """Documents that have each feature, and documents, over all of them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n = np.zeros(len(vocabulary), np.int64), 0
        for batch in batches:
            for part in slices(batch, "text"):
                for text in part.column("text").to_pylist():
                    n += 1
                    counts[vocabulary.counts(text or "")[0]] += 1
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict(
            {
                "feature": pa.array(np.append(-1, held), pa.int32()),
                "n": pa.array(np.append(n, counts[held]), pa.int64()),
            }
        )

    found = np.zeros(len(vocabulary) + 1, np.int64)
    counted = map_arrow(docs.select("text"), work, "feature int, n long", keep=True)
    rows = counted.groupBy("feature").agg(F.sum("n").alias("n")).toArrow()
    found[rows.column("feature").to_numpy()] = rows.column("n").to_numpy()
    return found[:-1], int(found[-1])


def learn(docs: DataFrame, labels: DataFrame, limit: int = EXAMPLES) -> Model:
    """A model from labelled documents; `labels` has doc_id and toxic (0 or 1)."""
    held, totals = examples(docs, labels, limit)
    names, ratio = _selected(held)
    vocabulary = Vocabulary(names)
    frequency, n = _document_frequencies(docs, vocabulary)
    weights = (np.log((1 + n) / (1 + frequency)) + 1) * (1 + ratio / EVIDENCE)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [vocabulary.counts(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id").cast(pa.int64()),
                    "toxic": batch.column("toxic"),
                    "features": pa.array([f.tobytes() for f, _ in counts], pa.binary()),
                    "counts": pa.array([c.tobytes() for _, c in counts], pa.binary()),
                }
            )

    schema = "doc_id long, toxic int, features binary, counts binary"
    rows = map_arrow(held, work, schema, keep=True).distinct().collect()  # at most 2 * limit documents
    rows.sort(key=lambda r: (r["doc_id"], r["toxic"], r["features"], r["counts"]))
    sampled = Counter(r["toxic"] for r in rows)
    class_weight = tuple(totals.get(c, 0) / sampled[c] if sampled[c] else 0.0 for c in (0, 1))

    def rate(of: Counter) -> float:
        mass = [of[c] * class_weight[c] for c in (0, 1)]
        return mass[1] / sum(mass) if sum(mass) else 0.0

    base = rate(sampled)
    empty = Counter(r["toxic"] for r in rows if not r["features"])
    rows = [r for r in rows if r["features"]]

    def joined(column: str) -> np.ndarray:
        return np.frombuffer(b"".join(r[column] for r in rows), np.int32)

    held = Examples(
        np.array([r["doc_id"] for r in rows], np.int64),
        np.array([r["toxic"] for r in rows], np.int64),
        np.array([len(r["features"]) // 4 for r in rows], np.int64),
        joined("features"),
        joined("counts"),
    )
    return Model(vocabulary, weights, held, class_weight, base, rate(empty) if empty else base)


_EVIDENCE = T.ArrayType(
    T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("similarity", T.DoubleType()),
            T.StructField("toxic", T.IntegerType()),
        ]
    )
)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted and evidence (the three nearest examples) of each document."""
    kind = pa.list_(
        pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("toxic", pa.int32())])
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = list(model.scores([t or "" for t in part.column("text").to_pylist()]))
                near = [
                    [dict(zip(("doc_id", "similarity", "toxic"), x, strict=True)) for x in e[:3]]
                    for _, e in found
                ]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part.column("doc_id"),
                        "score": pa.array([s for s, _ in found], pa.float64()),
                        "predicted": pa.array([int(s >= THRESHOLD) for s, _ in found], pa.int32()),
                        "evidence": pa.array(near, kind),
                    }
                )

    schema = T.StructType(
        [
            docs.schema["doc_id"],
            T.StructField("score", T.DoubleType()),
            T.StructField("predicted", T.IntegerType()),
            T.StructField("evidence", _EVIDENCE),
        ]
    )
    return map_arrow(docs.select("doc_id", "text"), work, schema, keep=True)


def reject(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that are not predicted to be toxic, with all their columns."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                scores = model.scores([t or "" for t in part.column("text").to_pylist()])
                yield part.filter(pa.array([x < THRESHOLD for x, _ in scores], pa.bool_()))

    return map_arrow(docs, work, docs.schema, keep=True)


def fold() -> F.Column:
    """The fold of a document: the CRC-32 of its id as text, modulo 4."""
    return F.crc32(F.col("doc_id").cast("string")) % 4


def op4(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = learn(docs, labels.where(fold() != 2))
    held_out = F.coalesce(fold() == 2, F.lit(False)).alias("held_out")
    return score(docs, model).select("doc_id", held_out, "score", "predicted", "evidence")
