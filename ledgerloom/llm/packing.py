"""Packing documents into sequences by a grouping genetic algorithm on islands.

Documents longer than a sequence are cut into full pieces and a rest. A full piece is a sequence of
its own. The others are dealt by hash into demes of about DEME ids, hundreds of sequences; one row
of a table holds a deme. Several islands, each a row and hence a task of its own, evolve packings of the same deme:
the first one starts from best-fit decreasing, further ones from best-fit in disturbed orders. An
offspring takes well-filled bins of one parent whole, drops the other parent's bins that share a
piece with them, and puts the displaced pieces back by best-fit. After each round an island's best
packing migrates to the next island of its deme. The best packing of a deme is the result, but for
its emptiest sequences: the pieces of those of all demes are dealt and packed anew, until they fill
one deme. So part-filled sequences of many demes are joined, whatever the sizes of the pieces.

Null text is an empty document: it holds only the end id. Repeated rows are packed again each.
An empty table gives no sequences. Other columns are not read.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import word_bpe
from ledgerloom.llm.store import map_arrow, slices, written

END = 1
LENGTH = 4096
DEME = 1 << 20  # ids in a deme, which has no more pieces than ids
EMPTIEST = 4  # sequences of a deme that are packed anew with those of other demes
ISLANDS = 2
ROUNDS = 2
POPULATION = 4
OFFSPRING = 12  # of an island in a round
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, length: int = LENGTH, path: str | None = None) -> DataFrame:
    """Tokenize, append the end id and cut at `length` ids."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_bpe.loaded(path)
        tail = END.to_bytes(4, "little")
        for batch in batches:
            for part in slices(batch, "text"):
                out: dict[str, list] = {c.split()[0]: [] for c in _PIECES.split(", ")}
                ids = tokenizer.encode([t or "" for t in part.column("text").to_pylist()])
                for name, x in zip(part.column("doc_id").to_pylist(), ids, strict=True):
                    x += tail
                    for i, at in enumerate(range(0, len(x), 4 * length)):
                        held = x[at : at + 4 * length]
                        out["doc_id"].append(name)
                        out["piece"].append(i)
                        out["start"].append(at // 4)
                        out["length"].append(len(held) // 4)
                        out["ids_crc32"].append(zlib.crc32(held))
                types = {"piece": pa.int32()}
                yield pa.RecordBatch.from_pydict(
                    {k: pa.array(v, types.get(k, pa.int64())) for k, v in out.items()}
                )

    return map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), work, _PIECES)


class Bins:
    """Bins by the room left in them: the least room that takes a piece is found in one step."""

    def __init__(self, room: np.ndarray):
        self.room = room.tolist()
        self.by_room: dict[int, list[int]] = {}
        self.rooms = 0  # a bit for each room that some bin has
        for b, r in enumerate(self.room):
            self._file(b, r)

    def _file(self, b: int, room: int) -> None:
        if room:
            self.by_room.setdefault(room, []).append(b)
            self.rooms |= 1 << room

    def put(self, size: int, capacity: int) -> int:
        fitting = self.rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            held = self.by_room[room]
            b = held.pop()
            if not held:
                self.rooms &= ~(1 << room)
            self.room[b] = room - size
        else:
            b, room = len(self.room), capacity
            self.room.append(capacity - size)
        self._file(b, self.room[b])
        return b


def best_fit(order: np.ndarray, sizes: list[int], bins: np.ndarray, room: np.ndarray, capacity: int):
    """Put the pieces in `order` into `bins` (bin of each piece), given the bins' room."""
    open_bins = Bins(room)
    for i in order.tolist():
        bins[i] = open_bins.put(sizes[i], capacity)
    return bins


def _renumber(bins: np.ndarray) -> np.ndarray:
    return np.unique(bins, return_inverse=True)[1]


def fitness(bins: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer bins first, then bins as uneven as can be: full ones and emptied ones."""
    fill = np.bincount(bins, sizes)
    return -len(fill), float(np.mean((fill / capacity) ** 2))


def cross(mother: np.ndarray, father: np.ndarray, sizes: np.ndarray, capacity: int, rng) -> np.ndarray:
    """Well-filled bins of the father go whole into the mother's packing."""
    fill = np.bincount(father, sizes)
    well = (fill >= np.quantile(fill, 0.5)) & (rng.random(len(fill)) < 0.3)
    injected = well[father]
    # The mother's bins that share a piece with them dissolve, and so do her emptiest few.
    dissolved = np.bincount(mother, injected) > 0
    own = np.bincount(mother, sizes)
    dissolved[np.argsort(own)[: max(2, len(own) // 50)]] = True
    displaced = dissolved[mother] & ~injected
    child = np.where(injected, father + len(own), mother)
    kept = ~displaced
    child[kept] = _renumber(child[kept])
    room = capacity - np.bincount(child[kept], sizes[kept]).astype(np.int64) if kept.any() else []
    order = np.flatnonzero(displaced)
    order = order[np.argsort(-sizes[order], kind="stable")]
    return best_fit(order, sizes.tolist(), child, np.array(room, np.int64), capacity)


def evolve(sizes: np.ndarray, capacity: int, seed: int, elites: list[np.ndarray],
           population: int = POPULATION, offspring: int = OFFSPRING) -> np.ndarray:
    """One island's round. `elites` are its own best packing and an immigrant, if any."""
    rng = np.random.default_rng(seed)
    n, listed = len(sizes), sizes.tolist()
    people = list(elites)
    none = np.zeros(0, np.int64)
    least = -(-int(sizes.sum()) // capacity)
    while len(people) < population:
        if people and int(people[-1].max()) < least:  # no packing has fewer
            return people[-1]
        # The disturbance grows with each packing; there is none in the first of the first island.
        noise = 0.1 * (len(people) + seed % ISLANDS) * rng.random(n)
        order = np.argsort(-(sizes * (1 - noise)), kind="stable")
        people.append(best_fit(order, listed, np.zeros(n, np.int64), none, capacity))
    scored = sorted(((fitness(p, sizes, capacity), i) for i, p in enumerate(people)), reverse=True)
    people = [people[i] for _, i in scored]
    scores = [s for s, _ in scored]
    for _ in range(offspring):
        if -scores[0][0] <= least:
            break
        a, b = sorted(rng.choice(len(people), 2, replace=False).tolist())
        child = _renumber(cross(people[a], people[b], sizes, capacity, rng))
        score = fitness(child, sizes, capacity)
        if score > scores[-1]:
            at = next(i for i, s in enumerate(scores) if score > s)
            people.insert(at, child)
            scores.insert(at, score)
            people.pop()
            scores.pop()
    return people[0]


_DEMES = "deme long, island int, uids array<bigint>, sizes array<int>, bins array<int>, n_bins int, fitness double"


def _round(demes: DataFrame, capacity: int, number: int) -> DataFrame:
    """Evolve each island; `bins` and `immigrant` are packings of the round before, or null."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                sizes = row.column("sizes")[0].values.to_numpy().astype(np.int64)
                elites = [
                    row.column(c)[0].values.to_numpy().astype(np.int64)
                    for c in ("bins", "immigrant")
                    if row.column(c)[0].is_valid
                ]
                deme, island = row.column("deme")[0].as_py(), row.column("island")[0].as_py()
                seed = (deme * ROUNDS + number) * ISLANDS + island
                best = evolve(sizes, capacity, seed, elites)
                score = fitness(best, sizes, capacity)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(row.column(c) for c in ("deme", "island", "uids", "sizes")),
                        pa.array([best.astype(np.int32)], pa.list_(pa.int32())),
                        pa.array([-score[0]], pa.int32()),
                        pa.array([score[1]]),
                    ],
                    names=["deme", "island", "uids", "sizes", "bins", "n_bins", "fitness"],
                )

    return map_arrow(demes, work, _DEMES)


def _offsets(best: DataFrame, capacity: int) -> DataFrame:
    """A row per piece: uid, bin, the place in its sequence, and whether that is one of the emptiest
    of its deme that are not full."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                uids = row.column("uids")[0].values.to_numpy()
                sizes = row.column("sizes")[0].values.to_numpy().astype(np.int64)
                bins = row.column("bins")[0].values.to_numpy().astype(np.int64)
                order = np.argsort(bins, kind="stable")
                before = np.cumsum(sizes[order]) - sizes[order]
                first = np.searchsorted(bins[order], bins[order])
                fill = np.bincount(bins, sizes)
                loose = np.zeros(len(fill), bool)
                loose[np.argsort(fill, kind="stable")[:EMPTIEST]] = True
                loose &= fill < capacity
                yield pa.RecordBatch.from_pydict(
                    {
                        "uid": pa.array(uids[order]),
                        "sequence_id": pa.array(
                            row.column("deme")[0].as_py() * (1 << 24) + bins[order], pa.int64()
                        ),
                        "offset": pa.array(before - before[first], pa.int64()),
                        "length": pa.array(sizes[order], pa.int32()),
                        "loose": pa.array(loose[bins[order]], pa.bool_()),
                    }
                )

    schema = "uid long, sequence_id long, offset long, length int, loose boolean"
    return map_arrow(best, work, schema)


def _packed(rest: DataFrame, n_demes: int, salt: int, capacity: int) -> DataFrame:
    """Deal pieces (uid, length) into demes and evolve their packings: a row per piece."""
    demes = (
        rest.groupBy(F.pmod(F.xxhash64("uid", F.lit(salt)), F.lit(n_demes)).alias("deme"))
        # About DEME ids each, as the numbers of the rows are dealt by hash.
        .agg(F.sort_array(F.collect_list(F.struct("uid", "length"))).alias("held"))
        .select("deme", F.col("held.uid").alias("uids"), F.col("held.length").alias("sizes"))
    )
    island = F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island")
    nothing = F.lit(None).cast("array<int>")
    now = demes.select("*", island, nothing.alias("bins"), nothing.alias("immigrant"))
    for number in range(ROUNDS):
        now = written(_round(now.repartition("deme", "island"), capacity, number), "islands")
        if number < ROUNDS - 1:
            migrants = now.select(
                "deme",
                ((F.col("island") + 1) % ISLANDS).alias("island"),
                F.col("bins").alias("immigrant"),
            )
            now = now.join(migrants, ["deme", "island"])
    best = now.groupBy("deme").agg(
        F.max_by(
            F.struct("uids", "sizes", "bins"), F.struct(-F.col("n_bins"), "fitness", "island")
        ).alias("b")
    )
    return written(_offsets(best.select("deme", "b.*"), capacity), "places")


def pack(parts: DataFrame, capacity: int = LENGTH) -> DataFrame:
    """Add sequence_id and offset to a table of pieces that has a `length` of at least one and at
    most `capacity` each. Its other columns stay."""
    parts = written(parts.withColumn("__uid", F.monotonically_increasing_id()), "pieces")
    full = F.col("length") == capacity
    rest = parts.where(~full).select(F.col("__uid").alias("uid"), F.col("length").cast("int"))
    places = []
    while True:
        # Each turn takes a few sequences of each deme, so there are few turns: the logarithm of the
        # number of demes, to the base of the number of sequences in a deme over EMPTIEST.
        n_demes = max(1, -(-(rest.agg(F.sum("length")).first()[0] or 0) // max(DEME, 4 * EMPTIEST * capacity)))
        done = _packed(rest, n_demes, len(places), capacity)
        kept = done if n_demes == 1 else done.where("not loose")
        # The numbers of a turn lie apart from those of the others.
        number = (F.col("sequence_id") * 64 + len(places)).alias("sequence_id")
        places.append(kept.select("uid", number, "offset"))
        if n_demes == 1:
            break
        rest = done.where("loose").select("uid", "length")
    placed = functools.reduce(DataFrame.unionByName, places)
    alone = parts.where(full).select(
        F.col("__uid").alias("uid"),
        (-1 - F.col("__uid")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    places = placed.unionByName(alone).withColumnRenamed("uid", "__uid")
    return parts.join(places, "__uid").drop("__uid")


def op6(docs: DataFrame) -> DataFrame:
    return pack(pieces(docs))
