"""N-gram Jaccard join: documents whose shingle sets are similar, by a grouped prefix join.

All shingles are put in one order: by the hash of the shingle, but those that many documents share
come last, the most frequent at the very end. Two sets of the wanted similarity then share a
shingle among the first few of each (the prefix). Documents with the same prefix and size form one
group. Groups that share a prefix shingle are candidates if their sizes and the shingle's places
allow enough overlap. The pairs are expanded to the groups' distinct sets, and each is verified on
the whole sets. Components of the links follow by alternating star steps.

Each set has a parity bitmap: bit i tells whether an odd number of its shingles hash to i. The bits
in which two bitmaps differ are at most the shingles that one set only has, so a pair with too many
of them is no link, and its texts are not read.

A shingle that many groups have in their prefix would give the square of their number of pairs. So
its groups are first paired with one of them only, their pivot; a second round pairs those that are
not connected by then. In the same way a pair of groups is first a pair of one set of each. Sets in
the same group are treated alike. No link between two components is lost that way, and connected
sets are not compared again. Sets of one template share many frequent shingles; the second round
pairs them under the first one only. Each entry has the frequent shingles before its own, EARLIER
at most, and entries that have one of them in common are a pair there.

The order only decides what work is done, not what is found, so the frequent shingles may come from
a bounded list: those that repeat in stretches of the corpus, counted over all of it.

Null and empty texts, and texts without words, have no shingles and link with nothing; a text with
fewer words than a shingle has one shingle of all its words. Rows with equal sets are linked, copies
and repeated ids too; component_id is null where no row of the component has an id. Shingles are
compared by 64-bit hashes. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.components import components, pivoted, unconnected
from ledgerloom.llm.store import likely, map_arrow, slices, text_key, written
from ledgerloom.llm.words import Words, shingles

WORDS = 4
SIMILARITY = 85  # per cent
FREQUENT = 16  # documents from which a shingle is put to the end
LISTED = 1 << 18  # frequent shingles that are listed, the most frequent first
STRETCH = 1 << 21  # shingles that are counted at once to find frequent ones
BITMAP = 4  # words of 64 bits of the parity bitmap of a set
PAIRS = 1 << 18  # candidate pairs that a task gives out at once
EARLIER = 64  # frequent shingles of a prefix that later ones are told of


def _sets(part: pa.RecordBatch, size: int) -> Iterator[np.ndarray]:
    words = Words(part.column("text"), lower=True)
    for i in range(len(words)):
        yield np.unique(shingles(words.of(i), size))


def frequent_shingles(docs: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that many documents share, sorted, and the logarithm of how many do."""

    def repeats(held: list[np.ndarray]) -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        more = counts > 1
        return pa.RecordBatch.from_arrays(
            [pa.array(values[more].view(np.int64)), pa.array(counts[more])], names=["shingle", "n"]
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0
        for batch in batches:
            for part in slices(batch, "text"):
                for values in _sets(part, size):
                    held.append(values)
                    total += len(values)
                    if total > STRETCH:
                        yield repeats(held)
                        held, total = [], 0
        if held:
            yield repeats(held)

    found = (
        map_arrow(docs.select("text"), work, "shingle long, n long")
        .groupBy("shingle")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= FREQUENT)
        .orderBy(F.desc("n"), "shingle")
        .limit(LISTED)
        .toArrow()
    )
    values = found["shingle"].to_numpy().view(np.uint64)
    order = np.argsort(values)
    return values[order], np.log2(found["n"].to_numpy()[order].astype(float)).astype(np.int8)


def parity(values: np.ndarray) -> np.ndarray:
    """The parity bitmap of a set of shingles. The upper bits choose, the order is by all bits."""
    places = ((values * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)) % np.uint64(64 * BITMAP)
    odd = np.bincount(places.astype(np.int64), minlength=64 * BITMAP) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def prefix_length(n: int, similarity: int) -> int:
    """So many first shingles cannot all be outside the other set: it has similarity * n of them."""
    return n - -(-similarity * n // 100) + 1


def _members(docs: DataFrame, size: int, similarity: int, frequent) -> DataFrame:
    """Per document: size, key and parity bitmap of its set, its prefix, the prefix's key, and how
    many of its first shingles are not frequent."""
    listed, rarity = frequent

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                n, keys, prefixes, prefix_keys, rare, marks = [], [], [], [], [], []
                for values in _sets(part, size):
                    n.append(len(values))
                    if not len(values):
                        for column in (keys, prefixes, prefix_keys, rare, marks):
                            column.append(None)
                        continue
                    keys.append(hashlib.blake2b(values.tobytes(), digest_size=16).digest())
                    marks.append(parity(values))
                    length = prefix_length(len(values), similarity)
                    least = length
                    if len(listed):
                        at = np.minimum(np.searchsorted(listed, values), len(listed) - 1)
                        rank = np.where(listed[at] == values, rarity[at], 0)
                        values = values[np.argsort(rank, kind="stable")]
                        least = int((rank == 0).sum())
                    prefix = values[:length]
                    prefixes.append(prefix.view(np.int64))
                    rare.append(min(least, length))
                    held = len(values).to_bytes(8, "little") + prefix.tobytes()
                    prefix_keys.append(hashlib.blake2b(held, digest_size=16).digest())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), part.column("text_key"),
                        pa.array(n, pa.int32()), pa.array(keys, pa.binary()),
                        pa.array(prefix_keys, pa.binary()),
                        pa.array(prefixes, pa.list_(pa.int64())), pa.array(rare, pa.int32()),
                        pa.array(marks, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "text_key", "n", "set_key", "prefix_key", "prefix", "rare", "marks"],
                )

    schema = (
        "doc_id long, text_key binary, n int, set_key binary, prefix_key binary, "
        "prefix array<bigint>, rare int, marks array<bigint>"
    )
    return map_arrow(docs, work, schema)


def _near(similarity: int) -> str:
    """SQL: do the bitmaps m_a and m_b of two sets differ in no more bits than alike sets can?"""
    least = f"div({similarity} * (n_a + n_b) + {99 + similarity}, {100 + similarity})"
    bits = " + ".join(f"bit_count(m_a[{i}] ^ m_b[{i}])" for i in range(BITMAP))
    return f"{bits} <= n_a + n_b - 2 * {least}"


def _fits(similarity: int) -> str:
    """SQL: may two sets of sizes n_a and n_b whose first common shingle is at p_a and p_b be
    similar enough?"""
    least = f"div({similarity} * (n_a + n_b) + {99 + similarity}, {100 + similarity})"
    return (
        f"100 * least(n_a, n_b) >= {similarity} * greatest(n_a, n_b)"
        f" and least(n_a - p_a, n_b - p_b) >= {least} and {_near(similarity)}"
    )


def _expanded(group_pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs of sets (a, b) of pairs of groups that may be similar enough; of sets with a label
    those of different ones."""
    for side in ("a", "b"):
        own = sets.select(F.col("group").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in sets.columns if c != "group"))
        group_pairs = group_pairs.join(own, side)
    fits = _near(similarity) + (" and label_a <> label_b" if "label" in sets.columns else "")
    return group_pairs.where(fits).select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))


def _rare_pairs(postings: DataFrame, similarity: int) -> DataFrame:
    """Candidate pairs of groups (a, b) of the shingles that few groups have in their prefix."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # the last shingle's postings so far

        def pairs(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            token, group, n, place = (np.concatenate(c) for c in zip(*rows, strict=True))
            here = np.arange(len(token))
            lag, kept_a, kept_b, total = 1, [], [], 0
            while len(here):
                here = here[here + lag < len(token)]
                here = here[token[here] == token[here + lag]]
                # Sizes ascend within a shingle, so a set too large stays so for larger lags.
                here = here[100 * n[here] >= similarity * n[here + lag]]
                there = here + lag
                overlap = np.minimum(n[here] - place[here], n[there] - place[there])
                both = n[here] + n[there]
                fits = overlap * (100 + similarity) >= similarity * both
                kept_a.append(group[here[fits]])
                kept_b.append(group[there[fits]])
                total += int(fits.sum())
                lag += 1
                if total > PAIRS or not len(here):
                    a, b = np.concatenate(kept_a), np.concatenate(kept_b)
                    low, high = np.minimum(a, b), np.maximum(a, b)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(low), pa.array(high)], names=["a", "b"]
                    )
                    kept_a, kept_b, total = [], [], 0

        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in ("token", "group", "n", "place")]
            if not batch.num_rows:
                continue
            held.append(columns)
            last = np.searchsorted(columns[0], columns[0][-1])
            if last > 0:
                done = [*held[:-1], [c[:last] for c in columns]]
                held = [[c[last:] for c in columns]]
                yield from pairs(done)
        if held:
            yield from pairs(held)

    ordered = postings.repartition("token").sortWithinPartitions("token", "n", "group")
    return map_arrow(ordered, work, "a long, b long").distinct()


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, size: int, similarity: int):
    """The pairs of sets (a, b) that are similar enough, on their whole sets."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in slices(b, "text_a")):
            linked = []
            sides = (_sets(batch.select([f"text_{x}"]).rename_columns(["text"]), size) for x in "ab")
            for a, b in zip(*sides, strict=True):
                both = len(np.intersect1d(a, b, assume_unique=True))
                linked.append(100 * both >= similarity * (len(a) + len(b) - both))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    pairs = written(pairs, "candidates")
    wanted = pairs.select(F.col("a").alias("set_key")).union(pairs.select("b")).distinct()
    wanted = wanted.join(nodes, "set_key").select("set_key", F.col("rep.*"))
    wanted = wanted.withColumnsRenamed({"doc_id": "rep_id", "text_key": "rep_key"})
    wanted = written(wanted, "candidate-sets")
    same = (F.col("text_key") == F.col("rep_key")) & F.col("doc_id").eqNullSafe(F.col("rep_id"))
    held = likely(docs, "text_key", wanted.select("rep_key")).join(wanted, same)
    # A text for each set: texts are shorter than the hashes of their shingles, and compress.
    held = written(held.groupBy("set_key").agg(F.first("text").alias("text")), "candidate-texts")
    for side in ("a", "b"):
        own = held.select(F.col("set_key").alias(side), F.col("text").alias(f"text_{side}"))
        pairs = pairs.join(own, side)
    return map_arrow(pairs, compare, "a binary, b binary")


def join(docs: DataFrame, size: int = WORDS, similarity: int = SIMILARITY) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id and label of each row of `docs` (doc_id, text);
    the label is a set of the component, null if there are no shingles."""
    docs = docs.select(
        F.col("doc_id").cast("long"), "text", text_key(F.coalesce("text", F.lit(""))).alias("text_key")
    )
    frequent = frequent_shingles(docs, size)
    members = written(_members(docs, size, similarity, frequent), "shingle-sets")
    fits = _fits(similarity)
    some = members.where("set_key is not null")
    groups = written(
        some.groupBy("prefix_key", "n")
        .agg(
            F.first("prefix").alias("prefix"),
            F.first("rare").alias("rare"),
            F.min("set_key").alias("first_set"),
            F.max("set_key").alias("last_set"),
        )
        .withColumn("group", F.monotonically_increasing_id()),
        "prefix-groups",
    )
    postings = groups.select("group", "n", "rare", F.posexplode("prefix").alias("place", "token"))
    rare = postings.where("place < rare").select("token", "group", "n", "place")
    group_pairs = written(_rare_pairs(rare, similarity), "group-pairs")

    # From here on the nodes are distinct sets.
    nodes = some.groupBy("set_key", "prefix_key", "n").agg(
        F.min(F.struct("doc_id", "text_key")).alias("rep"), F.first("marks").alias("marks")
    )
    keys = groups.selectExpr("prefix_key", "n", "group", "first_set", "first_set <> last_set several")
    nodes = written(nodes.join(keys, ["prefix_key", "n"]).drop("prefix_key"), "set-groups")
    sets = nodes.select("group", F.col("set_key").alias("node"), "n", F.col("marks").alias("m"))
    # Buckets of any size: frequent shingles, and groups of several sets.
    last = F.expr("slice(prefix, rare + 1, size(prefix) - rare)")
    frequent_postings = groups.select("group", "rare", last.alias("last")).select(
        "group", "rare", "last", F.posexplode("last").alias("i", "bucket")
    )
    buckets = (
        frequent_postings.join(sets, "group")
        .selectExpr("bucket", "node", "n", "rare + i p", "m", f"slice(last, 1, least(i, {EARLIER})) earlier")
        .union(nodes.where("several").selectExpr("group", "set_key", "n", "0", "marks", "cast(array() as array<bigint>)"))
    )
    buckets = written(buckets, "shared-prefixes")

    rep = nodes.select("set_key", "rep")
    one = nodes.where("set_key = first_set").select("group", F.col("set_key").alias("node"), "n", F.col("marks").alias("m"))
    first = _expanded(group_pairs, one, similarity).union(pivoted(buckets.drop("earlier"), fits)).distinct()
    links = written(_verified(first, rep, docs, size, similarity), "set-links")
    labels = written(components(links), "set-labels")
    # Pairs of groups with several sets, of which not all are connected yet.
    own = sets.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    own = written(own, "labelled-sets")
    ends = own.groupBy("group").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("sets")
    )
    open_pairs = group_pairs
    for side in ("a", "b"):
        open_pairs = open_pairs.join(ends.select(F.col("group").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in ("low", "high", "sets"))), side)
    open_pairs = open_pairs.where(
        "sets_a + sets_b > 2 and least(low_a, low_b) <> greatest(high_a, high_b)"
    ).select("a", "b")
    fits += " and not arrays_overlap(earlier_a, earlier_b)"
    second = _expanded(open_pairs, own, similarity).union(unconnected(buckets, labels, fits))
    links = links.union(_verified(second.distinct(), rep, docs, size, similarity))
    labels = components(links)

    least = nodes.select(F.col("set_key").alias("node"), F.col("rep.doc_id").alias("doc_id"))
    own = least.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    ids = own.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    ids = own.join(ids, "label").select(F.col("node").alias("set_key"), "label", "component_id")
    return members.join(ids, "set_key", "left").select(
        "doc_id",
        "text_key",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        "label",
    )


def keep_one(docs: DataFrame, size: int = WORDS, similarity: int = SIMILARITY) -> DataFrame:
    """The documents without shingles and one of each component, with all their columns: the one
    of least id (a null id is greater than any), of those that repeat it the one of least digest
    of the text, and one of its repeated rows."""
    found = join(docs, size, similarity)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    kept = (
        found.where("label is not null")
        .groupBy("label")
        .agg(F.min(order).alias("first"))
        .select(F.col("first.doc_id").alias("kept_id"), F.col("first.text_key").alias("kept_key"))
    )
    bare = found.where("label is null").select("text_key").distinct()
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").cast("long"), text_key(text).alias("text_key")
    )
    one = rows.join(
        kept, (F.col("text_key") == F.col("kept_key")) & F.col("doc_id").eqNullSafe(F.col("kept_id"))
    )
    # The join has dealt and sorted the rows by these columns, so the window costs no shuffle.
    number = F.row_number().over(Window.partitionBy("text_key", "doc_id").orderBy("text_key"))
    one = one.withColumn("number", number).where("number = 1").select("row.*")
    return one.unionByName(rows.join(bare, "text_key", "left_semi").select("row.*"))


def op3(docs: DataFrame) -> DataFrame:
    return join(docs).drop("text_key", "label")
