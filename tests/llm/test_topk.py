import duckdb
import numpy as np
import pandas as pd
import pytest

from ledgerloom.llm import topk

from .conftest import plan_nodes


def brute(rows, k=10):
    held = set()
    for name, vector in rows:
        if name is None or not vector or any(x is None or not np.isfinite(x) for x in vector):
            continue
        held.add((name, tuple(int(np.floor(1024 * float(x))) for x in vector)))
    out = []
    for own in held:
        q, query = own
        if q % 100 == 0:
            scored = [
                (-sum(a * b for a, b in zip(query, v, strict=True)), n)
                for n, v in held
                if (n, v) != own and len(v) == len(query)
            ]
            out += [(q, r + 1, n, -s) for r, (s, n) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def found(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return sorted(map(tuple, topk.op2(df).collect()))


@pytest.mark.parametrize("dims", [1, 3, 16])
def test_against_all_scores(spark, dims):
    rng = np.random.default_rng(dims)
    rows = [(i, (rng.integers(-3, 4, dims) / 7).astype("f4").tolist()) for i in range(0, 900, 3)]
    assert found(spark, rows) == brute(rows)


def test_several_shards_and_blocks(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [int(x) for x in rng.integers(-9, 10, 8)]) for i in range(500)]
    df = spark.createDataFrame(rows, "vec_id long, vector array<bigint>")
    df = df.selectExpr("*", "vec_id as uid", "size(vector) as size")
    got = topk.search(df, df.where("vec_id < 50"), k=7, shard=64, block=8).collect()
    v = dict(rows)
    want = []
    for q in range(50):
        scored = sorted((-int(np.dot(v[q], x)), n) for n, x in rows if n != q)[:7]
        want += [(q, r + 1, n, -s) for r, (s, n) in enumerate(scored)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, -1.0]), (1, None), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, [None, 1.0]), (5, []),
        (6, [1.0]), (None, [1.0, 1.0]), (7, [0.0, 0.0]), (8, [1.0, -1.0]), (8, [1.0, -1.0]),
        (9, [-1.0, 1.0]), (9, [2.0, 2.0]), (100, [0.0, 0.0]),
    ]
    assert found(spark, rows) == brute(rows)
    assert {r[0] for r in found(spark, rows)} == {0, 100}


def test_rows_that_repeat_an_id_are_candidates_each(spark):
    rng = np.random.default_rng(9)
    rows = [(int(i), rng.integers(-3, 4, 4).astype(float).tolist()) for i in rng.integers(0, 120, 400)]
    rows += [(1, [0.9, 0.0]), (1, [0.5, 0.0]), (100, [1.0, 0.0]), (100, [2.0, 0.0]), (100, [2.0, 0.0])]
    assert found(spark, rows) == brute(rows)
    best = [r for r in found(spark, [(1, [0.9]), (1, [0.5]), (100, [1.0])]) if r[0] == 100]
    assert best == [(100, 1, 1, 921 * 1024), (100, 2, 1, 512 * 1024)]
    with duckdb.connect() as db:
        table = pd.DataFrame(rows, columns=["vec_id", "embedding"])
        db.register("embeddings", table)
        assert sorted(db.execute(topk.OP2_SQL).fetchall()) == brute(rows)


def test_all_scores_negative(spark):
    rows = [(0, [1.0, 1.0])] + [(i, [-float(i), -1.0]) for i in range(1, 20)]
    assert found(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_blocks_are_not_copied_for_shards(spark):
    """The planner does not see how many shards meet a block, so it must not choose a broadcast."""
    rng = np.random.default_rng(6)
    rows = [(i, i, [int(x) for x in rng.integers(-9, 10, 8)], 8) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, uid long, vector array<bigint>, size int")
    plan = plan_nodes(topk.search(df, df.where("vec_id < 40"), k=3, shard=16, block=8))
    assert "CartesianProduct" in plan and "Generate" not in plan
    assert "BroadcastExchange" not in plan


def test_a_known_bar_loses_no_tie():
    rng = np.random.default_rng(8)
    vectors = rng.integers(-2, 3, (300, 6))
    ids = rng.permutation(300)
    parts = [topk.Shard(ids[a : a + 100], ids[a : a + 100], vectors[a : a + 100]) for a in (0, 100, 200)]
    for query in vectors[:40]:
        held = (np.zeros(0, int), np.zeros(0, int))
        for part in parts:
            bar = held[1][-1] if len(held[1]) == 5 else None
            found = part.search(query, 5, -1, bar)
            held = np.append(held[0], found[0]), np.append(held[1], found[1])
            first = np.lexsort((held[0], -held[1]))[:5]
            held = held[0][first], held[1][first]
        scores = vectors @ query
        want = np.lexsort((ids, -scores))[:5]
        assert held[0].tolist() == ids[want].tolist() and held[1].tolist() == scores[want].tolist()
