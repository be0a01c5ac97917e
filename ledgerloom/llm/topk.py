"""Exact top-k search by inner product with MaxScore, on shards of the vectors.

A term is a component with the sign of the query's value there; its postings are the vectors with
that sign in it, in order of impact, and its bound is the largest product it can add in the shard.
The query's terms are sorted by bound. As many of the least ones as cannot, all together, lift a
vector over the k-th best score so far are not essential: a vector in no posting of an essential
term need not be scored. The vectors in the essential postings are scored over the essential terms,
then the other terms are probed, the largest bound first, for the vectors that can still compete.
Scores are integers, so ties are exact; they go to the smaller id.

A shard is one row that holds about SHARD vectors, a block one row of QUERIES queries, and both are
written. Each block meets each shard in a Cartesian product, so that no table is copied for the other
one, neither on disk nor through the driver. A task takes some blocks through some shards; the best of
a block so far give the bar that the next shard begins with. The tasks' best are merged per query.

Vectors that are null, empty or hold a null or non-finite component take no part, nor do rows
without an id. Rows that repeat an id with different vectors are candidates and queries each, and
such a row is a candidate for the others too; rows that repeat both count once. Only vectors of the
same length are compared: those of another length than the query are no candidates. If there are fewer than k
candidates, all are given. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.store import map_arrow, written

SHARD = 4096
QUERIES = 256
SHARDS = 16  # of a task, about; they are what it holds in memory, 32 MB at 64 components
BLOCKS = 4  # of a task, about
SCALE = 1024


class Shard:
    """Vectors by component, ids ascending, with the postings of each component by value."""

    def __init__(self, uids: np.ndarray, ids: np.ndarray, vectors: np.ndarray):
        order = np.lexsort((uids, ids))
        self.uids, self.ids = uids[order], ids[order]
        self.by_component = np.ascontiguousarray(vectors[order].T)
        self.by_value = np.argsort(self.by_component, axis=1)
        self.least = self.by_component.min(axis=1)
        self.most = self.by_component.max(axis=1)
        self.negative = (self.by_component < 0).sum(axis=1)
        self.positive = (self.by_component > 0).sum(axis=1)

    def postings(self, component: int, sign: int) -> np.ndarray:
        held = self.by_value[component]
        if sign > 0:
            return held[len(held) - self.positive[component] :]
        return held[: self.negative[component]]

    def search(
        self, query: np.ndarray, k: int, own: int, bar: int | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best vectors but the query's own row. Where k vectors with scores
        of `bar` or more are known already, those below it may be left out."""
        bounds = np.maximum(0, np.maximum(query * self.least, query * self.most))
        terms = np.argsort(-bounds, kind="stable")
        terms = terms[bounds[terms] > 0]
        # Full scores of the vectors of most impact in the first terms give a first k-th best.
        first = [self.postings(int(t), int(np.sign(query[t]))) for t in terms[:4]]
        first = [p[-2 * k :] if query[t] > 0 else p[: 2 * k] for p, t in zip(first, terms, strict=False)]
        seeds = np.unique(np.concatenate([np.zeros(0, np.int64), *first]))
        seeds = seeds[self.uids[seeds] != own]
        seed_scores = query @ self.by_component[:, seeds]
        bar = np.iinfo(np.int64).min if bar is None else bar
        if len(seeds) >= k:
            bar = max(bar, np.partition(seed_scores, -k)[-k])
        enough = bar > np.iinfo(np.int64).min
        rest = np.cumsum(bounds[terms][::-1])[::-1]  # what the terms from here on can add
        essential = int((rest >= bar).sum()) if enough else len(terms)
        if enough and bar > 0:
            seen = np.zeros(len(self.ids), bool)
            for t in terms[:essential]:
                seen[self.postings(int(t), int(np.sign(query[t])))] = True
            alive = np.flatnonzero(seen)
        else:  # a vector without any posting has a score of zero or less and may be among the best
            alive = np.arange(len(self.ids))
        alive = alive[self.uids[alive] != own]
        scores = np.zeros(len(alive), np.int64)
        for i, t in enumerate(terms):
            scores += query[t] * self.by_component[t, alive]
            if i % 4 == 3 and enough and i + 1 < len(terms):
                # Terms with no bound only lower scores, so they need not be known here.
                competitive = scores + rest[i + 1] >= bar
                if len(alive) - competitive.sum() > len(alive) // 8:
                    alive, scores = alive[competitive], scores[competitive]
        for t in np.flatnonzero((bounds <= 0) & (query != 0)):
            scores += query[t] * self.by_component[t, alive]
        best = np.lexsort((self.ids[alive], -scores))[:k]
        return self.ids[alive[best]], scores[best]


_FOUND = "query_uid long, query_id long, vec_id long, score long"


def _packed(vectors: DataFrame, group: str) -> DataFrame:
    """One row per group and length: ids and components, one vector after the other."""
    # Groups are dealt by hash of a unique id, so each holds about as many as was asked for.
    held = vectors.groupBy(group, "size").agg(F.collect_list(F.struct("uid", "vec_id", "vector")).alias("v"))
    return held.select(
        group, "size", F.col("v.uid").alias("uids"), F.col("v.vec_id").alias("ids"),
        F.flatten("v.vector").alias("components"),
    )


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, shard: int = SHARD,
           block: int = QUERIES) -> DataFrame:
    """The k best vectors of each query, both tables of uid (a row's number, the same in both),
    vec_id, vector (whole numbers) and its size."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards: dict[tuple, Shard] = {}
        now, queries, best = None, (), []

        def done() -> pa.RecordBatch:
            out = [
                (np.full(len(ids), own), np.full(len(ids), name), ids, scores)
                for (own, name, _), (ids, scores) in zip(queries, best, strict=True)
            ]
            columns = [pa.array(np.concatenate(c)) for c in zip(*out, strict=True)]
            names = ["query_uid", "query_id", "vec_id", "score"]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}

                def matrix(components: str, *names: str, row: dict = row):
                    held = [row[c].values.to_numpy() for c in names]
                    return *held, row[components].values.to_numpy().reshape(len(held[0]), -1)

                size = row["size"].as_py()
                key = row["shard"].as_py(), size
                if key not in shards:
                    if len(shards) >= 2 * SHARDS:
                        shards.pop(next(iter(shards)))
                    shards[key] = Shard(*matrix("components", "uids", "ids"))
                if now != (row["block"].as_py(), size):
                    if now:
                        yield done()
                    now = row["block"].as_py(), size
                    queries = list(zip(*matrix("queries", "query_uids", "query_ids"), strict=True))
                    best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(queries)
                for at, (own, _, query) in enumerate(queries):
                    ids, scores = best[at]
                    bar = int(scores[-1]) if len(scores) == k else None
                    found = shards[key].search(query, k, own, bar)
                    ids, scores = np.append(ids, found[0]), np.append(scores, found[1])
                    first = np.lexsort((ids, -scores))[:k]
                    best[at] = ids[first], scores[first]
        if now:
            yield done()

    def dealt(df: DataFrame, size: int, name: str) -> tuple[DataFrame, int]:
        n = max(1, -(-df.count() // size))
        return df.withColumn(name, F.pmod(F.xxhash64("uid"), F.lit(n))), n

    vectors, n_shards = dealt(vectors, shard, "shard")
    queries, n_blocks = dealt(queries, block, "block")
    tasks = max(-(-n_shards // SHARDS), min(n_shards, vectors.sparkSession.sparkContext.defaultParallelism))
    shards = written(_packed(vectors, "shard"), "shards").repartition(tasks)
    blocks = written(_packed(queries, "block"), "blocks").repartition(-(-n_blocks // BLOCKS))
    blocks = blocks.select(
        "block", "size", F.col("uids").alias("query_uids"), F.col("ids").alias("query_ids"),
        F.col("components").alias("queries"),
    )
    # The rows of a block come one after the other, with all shards of the task.
    pairs = blocks.join(shards.hint("shuffle_replicate_nl"), "size")
    found = map_arrow(pairs, work, _FOUND)
    best = Window.partitionBy("query_uid").orderBy(F.desc("score"), "vec_id")
    return found.select("query_id", F.row_number().over(best).alias("rank"), "vec_id", "score").where(
        F.col("rank") <= k
    )


def whole(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, vector (the floor of each component times `scale`) and its size, each row once."""
    vector = F.transform("embedding", lambda x: x.cast("double"))
    infinite = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = embeddings.where(
        F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & ~F.coalesce(infinite, F.lit(True))
    )
    rows = good.select(
        F.col("vec_id").cast("long"),
        F.transform(vector, lambda x: F.floor(x * scale).cast("long")).alias("vector"),
    )
    return rows.distinct().withColumn("size", F.size("vector"))


def op2(embeddings: DataFrame) -> DataFrame:
    held = whole(embeddings).withColumn("uid", F.monotonically_increasing_id())
    vectors = written(held, "vectors")
    return search(vectors, vectors.where("vec_id % 100 = 0"))


OP2_SQL = """
WITH v AS (
    SELECT DISTINCT vec_id, [CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT) FOR x IN embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)
), scored AS (
    SELECT q.vec_id AS query_id, q.v AS own, c.vec_id AS vec_id,
           CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
    FROM v q JOIN v c ON (q.vec_id <> c.vec_id OR q.v <> c.v) AND len(q.v) = len(c.v)
    WHERE q.vec_id % 100 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id, own ORDER BY score DESC, vec_id) AS rank
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
