"""Substring dedup: words that lie in a repeated run of WINDOW words are cut out.

The reference is the corpus itself, in shards. A window's shard is its anchor, the run of ANCHOR
words in it with the least hash, so equal windows meet in one shard. Consecutive windows of a text
with the same anchor form one segment. Segments whose anchor no other segment has cannot repeat and
go no further. A shard's segments are streamed through a suffix automaton of those before them:
where the matching statistic reaches WINDOW, the window and its first occurrence are repeated.

Equal segments (the inside of a passage that many documents share) are one segment of their shard,
repeated as a whole. An anchor of very many different segments is split into chunks with an
automaton each; the distinct windows of the chunks are compared by their hashes.

Texts that are equal as a whole are one reference text; all its windows are repeated. Null and
empty texts have no words. Repeated rows count as copies. Other columns stay as they are. Word
sequences are compared by 64-bit hashes of words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.store import likely, map_arrow, slices, text_key, written
from ledgerloom.llm.words import Words, shingles

WINDOW = 35
ANCHOR = 16
CHUNK = 2048  # different segments whose automaton a task builds at once
_KEY, _SPANS = "__text_key", "__spans"


def _anchors(words: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """The anchor of each window, and a number that tells its occurrences in the text apart: of
    several in a window, the first counts."""
    runs = shingles(words, anchor)
    values, rank = np.unique(runs, return_inverse=True)
    least = rank * len(runs) + np.arange(len(runs))
    span, wanted = 1, window - anchor + 1
    while span < wanted:
        more = min(span, wanted - span)
        least = np.minimum(least[:-more], least[more:])
        span += more
    return values[least // len(runs)], least


def segments(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """key, doc_id, and a text's segments: anchor, first window and number of windows of each.
    Texts shorter than a window have none and are left out."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(part.column("text"))
                rows, anchors, starts, counts = [], [], [], []
                for i in np.flatnonzero(np.diff(words.bounds) >= window).tolist():
                    anchor_of, place = _anchors(words.of(i), window, anchor)
                    at = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
                    rows.append(i)
                    anchors.append(anchor_of[at].view(np.int64))
                    starts.append(at)
                    counts.append(np.diff(np.append(at, len(place))))
                held = part.take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": held.column("key"),
                        "doc_id": held.column("doc_id"),
                        "anchors": pa.array(anchors, pa.list_(pa.int64())),
                        "starts": pa.array(starts, pa.list_(pa.int32())),
                        "counts": pa.array(counts, pa.list_(pa.int32())),
                    }
                )

    schema = "key binary, doc_id long, anchors array<bigint>, starts array<int>, counts array<int>"
    return map_arrow(docs.select("key", "doc_id", "text"), work, schema)


def repeated(held: list[np.ndarray], window: int) -> list[np.ndarray]:
    """For each sequence, which of its windows occur more than once in all sequences."""
    classes: dict[bytes, int] = {}
    kind = [classes.setdefault(h.tobytes(), len(classes)) for h in held]
    distinct = [np.frombuffer(c, np.uint64) for c in classes]
    if len(distinct) == 1 < len(held):  # copies of one sequence, as in most shards
        return [np.ones(len(h) - window + 1, bool) for h in held]
    hit = bytearray(sum(map(len, distinct)))  # by the place of a window's last word
    after: list[dict[int, int]] = [{}]
    link, length, first = [-1], [0], [0]
    last = place = 0
    for number, words in enumerate(distinct):
        state = matched = 0
        for symbol in (*words.tolist(), -1 - number):
            step = after[state].get(symbol)
            while step is None and state:
                state = link[state]
                matched = length[state]
                step = after[state].get(symbol)
            if step is not None:
                state, matched = step, matched + 1
                if matched >= window:
                    hit[place] = 1
                    node = state
                    while length[link[node]] >= window:
                        node = link[node]
                    hit[first[node]] = 1
            new = len(after)
            after.append({})
            length.append(length[last] + 1)
            first.append(place)
            link.append(0)
            p = last
            while p >= 0 and symbol not in after[p]:
                after[p][symbol] = new
                p = link[p]
            if p >= 0:
                q = after[p][symbol]
                if length[p] + 1 == length[q]:
                    link[new] = q
                else:
                    clone = len(after)
                    after.append(after[q].copy())
                    length.append(length[p] + 1)
                    first.append(first[q])
                    link.append(link[q])
                    while p >= 0 and after[p].get(symbol) == q:
                        after[p][symbol] = clone
                        p = link[p]
                    link[q] = link[new] = clone
                    while state and matched <= length[link[state]]:
                        state = link[state]
            last = new
            place += symbol >= 0
    found, at = [], 0
    for words in distinct:
        found.append(np.frombuffer(hit, np.uint8, len(words), at)[window - 1 :] > 0)
        at += len(words)
    copies = np.bincount(kind, minlength=len(distinct))
    return [found[k] | (copies[k] > 1) for k in kind]


def _runs(hits: np.ndarray) -> np.ndarray:
    """Starts and ends of runs of true values, as rows."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hits.astype(np.int8), [0]])))
    return edges.reshape(-1, 2)


_HITS = "content binary, first int, last int, window_hash long"


def _stream(shards: DataFrame, window: int) -> DataFrame:
    """Repeated runs of windows (content, first, last) of sorted segments that occur once. For
    comparison with the other chunks of its anchor, each window of a chunk also comes with its
    hash: one that is not known to be repeated in its place, of all others one, without a place."""

    def found(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        held = [np.frombuffer(words, np.uint64) for _, words, _, _ in rows]
        content, first, last, hashes = [], [], [], []
        known: set[int] = set()
        for (key, _, several, chunked), words, hits in zip(
            rows, held, repeated(held, window), strict=True
        ):
            if not several:
                for x, y in _runs(hits).tolist():
                    content.append(key)
                    first.append(x)
                    last.append(y)
                    hashes.append(None)
            if chunked:
                sums = shingles(words, window).view(np.int64)
                hits = hits | several
                known.update(sums[hits].tolist())
                for x in np.flatnonzero(~hits).tolist():
                    content.append(key)
                    first.append(x)
                    last.append(x + 1)
                    hashes.append(int(sums[x]))
        for name in (content, first, last):
            name.extend([None] * len(known))
        hashes.extend(known)
        if hashes:
            yield pa.RecordBatch.from_pydict(
                {
                    "content": pa.array(content, pa.binary()),
                    "first": pa.array(first, pa.int32()),
                    "last": pa.array(last, pa.int32()),
                    "window_hash": pa.array(hashes, pa.int64()),
                }
            )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        now = None
        columns = ("anchor", "chunk", "content", "words", "several", "chunked")
        for batch in batches:
            for part in slices(batch, "words", 1 << 20):
                listed = (part.column(c).to_pylist() for c in columns)
                for anchor, chunk, *row in zip(*listed, strict=True):
                    if (anchor, chunk) != now:
                        if rows:
                            yield from found(rows)
                        rows, now = [], (anchor, chunk)
                    rows.append(tuple(row))
        if rows:
            yield from found(rows)

    return map_arrow(shards, work, _HITS)


def _sequences(held: DataFrame, window: int) -> DataFrame:
    """The segments that may repeat, with a digest of their words; the words themselves come with
    the first of equal segments of a slice, so that those that many texts share travel once."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(part.column("text"))
                out: dict[str, list] = {c.split()[0]: [] for c in schema.split(", ")}
                seen: set[bytes] = set()
                tids = part.column("tid").to_pylist()
                for i, listed in enumerate(part.column("held").to_pylist()):
                    own = words.of(i)
                    for s in listed:
                        span = own[s["start"] : s["start"] + s["count"] + window - 1].tobytes()
                        key = hashlib.blake2b(span, digest_size=16).digest()
                        out["anchor"].append(s["anchor"])
                        out["content"].append(key)
                        out["tid"].append(tids[i])
                        out["start"].append(s["start"])
                        out["words"].append(None if key in seen else span)
                        seen.add(key)
                types = {"words": pa.binary(), "content": pa.binary(), "start": pa.int32()}
                yield pa.RecordBatch.from_pydict(
                    {k: pa.array(v, types.get(k, pa.int64())) for k, v in out.items()}
                )

    schema = "anchor long, content binary, tid long, start int, words binary"
    return map_arrow(held.select("tid", "text", "held"), work, schema)


def _repeated_runs(found: DataFrame, window: int) -> DataFrame:
    """content and the runs of its windows that are repeated, of all segments in `found`."""
    place = F.struct("tid", "start")
    contents = written(
        found.groupBy("anchor", "content").agg(
            F.first("words", ignorenulls=True).alias("words"),
            # The same document may be given twice; its segments are one.
            (F.min(place) != F.max(place)).alias("several"),
        ),
        "segment-contents",
    )
    others = contents.groupBy("anchor").agg(F.count("*").alias("m")).where("m > 1")
    shards = (
        contents.join(others, "anchor")
        .withColumn("chunk", F.expr(f"pmod(xxhash64(content), ceil(m / {CHUNK}))"))
        .withColumn("chunked", F.col("m") > CHUNK)
        .drop("m")
        .repartition("anchor", "chunk")
        .sortWithinPartitions("anchor", "chunk", "content")
    )
    hits = written(_stream(shards, window), "repeated-windows")
    open_ = hits.where("window_hash is not null")
    across = open_.groupBy("window_hash").agg(F.count("*").alias("n")).where("n > 1")
    open_ = open_.where("content is not null").join(across, "window_hash")
    runs = hits.where("window_hash is null").drop("window_hash")
    runs = runs.unionByName(open_.select("content", "first", "last"))
    # A segment that occurs twice is repeated as a whole.
    whole = contents.where("several").select(
        "content",
        F.lit(0).alias("first"),
        F.expr(f"cast(octet_length(words) div 8 - {window - 1} as int)").alias("last"),
    )
    runs = runs.unionByName(whole)
    return runs.groupBy("content").agg(F.collect_list(F.struct("first", "last")).alias("runs"))


def spans(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """For each text with repeated windows: its `key`, and `spans`, the ranges of windows
    (first, last + 1) that are repeated."""
    docs = docs.select(text_key("text").alias("key"), F.col("doc_id").cast("long"), "text")
    # One row per distinct text: its segments, its copies, and a document that has it.
    texts = written(
        segments(docs.where("text is not null"), window, anchor)
        .groupBy("key")
        .agg(
            *(F.first(c).alias(c) for c in ("anchors", "starts", "counts")),
            F.min("doc_id").alias("doc_id"),
            F.count("*").alias("copies"),
        )
        .withColumn("tid", F.monotonically_increasing_id()),
        "segments",
    )
    zipped = F.explode(F.arrays_zip("anchors", "starts", "counts")).alias("run")
    runs = texts.select("tid", zipped).select(
        "tid",
        F.col("run.anchors").alias("anchor"),
        F.col("run.starts").alias("start"),
        F.col("run.counts").alias("count"),
    )
    shared = runs.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
    wanted = (
        runs.join(shared, "anchor")
        .groupBy("tid")
        # At most as many as the text has segments.
        .agg(F.collect_list(F.struct("anchor", "start", "count")).alias("held"))
    )
    held = texts.select("tid", F.col("key").alias("text_key"), F.col("doc_id").alias("rep"))
    held = written(held.join(wanted, "tid"), "wanted-segments")
    same = (docs["key"] == held["text_key"]) & docs["doc_id"].eqNullSafe(held["rep"])
    same = (F.col("key") == F.col("text_key")) & F.col("doc_id").eqNullSafe(F.col("rep"))
    candidates = likely(docs, "key", held.select("text_key")).join(held, same)
    candidates = candidates.select("tid", "text", "held")
    found = written(_sequences(candidates, window), "candidate-segments")
    runs = found.select("content", "tid", "start").join(_repeated_runs(found, window), "content")
    hits = runs.select("tid", "start", F.explode("runs").alias("run")).select(
        "tid",
        (F.col("start") + F.col("run.first")).alias("first"),
        (F.col("start") + F.col("run.last")).alias("last"),
    )
    found = hits.groupBy("tid").agg(F.collect_list(F.struct("first", "last")).alias("found"))
    whole = F.when(
        F.col("copies") > 1,
        F.array(F.struct(F.lit(0).alias("first"), F.lit(2**31 - 1).alias("last"))),
    )
    return (
        texts.select("tid", "key", "copies")
        .join(found, "tid", "left")
        .select("key", F.coalesce(whole, "found").alias("spans"))
        .where("spans is not null")
    )


def cut(docs: DataFrame, found: DataFrame, window: int = WINDOW, report: bool = False) -> DataFrame:
    """The documents with their repeated words cut out of `text`; a null text stays null. With
    `report`, also n_words and n_removed. A word goes with the white space behind it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(part.column("text"), places=True)
                texts = part.column("text").cast(pa.binary()).to_pylist()
                removed = np.zeros(len(texts), np.int64)
                for i, listed in enumerate(part.column(_SPANS).to_pylist()):
                    a, b = int(words.bounds[i]), int(words.bounds[i + 1])
                    if not listed or a == b:
                        continue
                    change = np.zeros(b - a + 1, np.int64)
                    for s in listed:
                        change[s["first"]] += 1
                        change[min(s["last"] + window - 1, b - a)] -= 1
                    gone = np.cumsum(change[:-1]) > 0
                    removed[i] = gone.sum()
                    begin = np.append(words.starts[a:b], words.offsets[i + 1]) - words.offsets[i]
                    lead = int(begin[0])
                    kept = [texts[i][:lead]]
                    kept += [texts[i][begin[x] : begin[y]] for x, y in _runs(~gone).tolist()]
                    texts[i] = b"".join(kept)
                columns = {c: part.column(c) for c in part.schema.names if c != _SPANS}
                columns["text"] = pa.array(texts, pa.binary()).cast(part.column("text").type)
                if report:
                    columns["n_words"] = pa.array(np.diff(words.bounds), pa.int64())
                    columns["n_removed"] = pa.array(removed, pa.int64())
                yield pa.RecordBatch.from_pydict(columns)

    found = found.select(F.col("key").alias(_KEY), F.col("spans").alias(_SPANS))
    joined = docs.withColumn(_KEY, text_key("text")).join(found, _KEY, "left").drop(_KEY)
    counts = [T.StructField(c, T.LongType()) for c in ("n_words", "n_removed")]
    return map_arrow(joined, work, T.StructType(docs.schema.fields + counts * report))


def op10(docs: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text")
    done = cut(docs, spans(docs), report=True)
    words = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return done.select(
        "doc_id", "n_words", "n_removed", F.sha2(words, 256).alias("kept_sha256")
    )
