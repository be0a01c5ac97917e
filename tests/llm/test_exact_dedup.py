import hashlib

import duckdb
import numpy as np
from pyspark.sql import functions as F

from ledgerloom.llm import exact_dedup

from .conftest import ODD


def brute(rows):
    groups = {}
    for name, text in rows:
        groups.setdefault(text or "", []).append(name)
    out = []
    for text, names in groups.items():
        keep = max((n for n in names if n is not None), default=None)
        first = True
        for n in names:
            kept = n == keep and first
            first = first and not kept
            out.append((n, keep, len(names), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def test_odd_rows(odd):
    assert sorted(map(tuple, exact_dedup.op5(odd).collect()), key=str) == brute(ODD)


def test_texts_with_one_hash_stay_apart(documents):
    rows = [(i, f"text {i % 7}") for i in range(50)]
    df = documents(rows)

    def same(_):
        return F.lit(-5).cast("long")

    index = exact_dedup.build_index(df, bucket_bytes=100, hash_of=same)
    assert sorted(r["chain"] for r in index.collect()) == list(range(7))
    got = exact_dedup.mark(df, index, hash_of=same).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_directory_splits_and_doubles():
    sizes = {0: 10, 1: 10, 2: 1, 7: 30}
    got = exact_dedup.directory(sizes, 3, 12).tolist()
    assert len(got) == 8
    assert got[0] != got[1] and got[2] == got[3] and got[4] == got[5]
    assert len({got[0], got[1], got[2], got[4], got[6], got[7]}) == 6
    assert exact_dedup.directory({}, 4, 10).tolist() == [0]
    assert exact_dedup.directory({3: 99}, 2, 10).tolist()[3] not in exact_dedup.directory(
        {3: 99}, 2, 10
    ).tolist()[:3]


def test_buckets_hold_their_prefixes(documents):
    rows = [(i, f"text number {i}") for i in range(300)]
    index = exact_dedup.build_index(documents(rows), bucket_bytes=500).collect()
    assert len({r["bucket"] for r in index}) > 8
    prefixes = {}
    for r in index:
        prefixes.setdefault(r["bucket"], []).append(np.int64(r["hash"]).view(np.uint64))
    spans = sorted((min(v), max(v)) for v in prefixes.values())
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_statement_gives_the_same(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = con.execute(exact_dedup.OP5_SQL).fetchall()
    assert sorted(map(tuple, exact_dedup.op5(df).collect())) == sorted(want)


def test_empty_table(documents):
    assert exact_dedup.op5(documents([])).count() == 0
