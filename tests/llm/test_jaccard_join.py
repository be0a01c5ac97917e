import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import components as star
from ledgerloom.llm import jaccard_join
from ledgerloom.llm.components import components

from .conftest import ODD, texts

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingle_set(text, size):
    raw = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    words = WORD.findall(raw)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def brute(rows, size=4, similarity=85):
    """(id, size of the set, least id of the component) of each row."""
    sets = [shingle_set(t, size) for _, t in rows]
    label = list(range(len(rows)))
    for _ in rows:
        for a in range(len(rows)):
            for b in range(len(rows)):
                both = len(sets[a] & sets[b])
                if both and 100 * both >= similarity * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    ids = {}
    for (name, _), x in zip(rows, label, strict=True):
        if name is not None:
            ids[x] = min(ids.get(x, name), name)
    return sorted(
        ((name, len(s), ids.get(x) if s else name)
         for (name, _), s, x in zip(rows, sets, label, strict=True)), key=str,
    )


def found(df, **how):
    rows = jaccard_join.join(df, **how).select("doc_id", "n_shingles", "component_id")
    return sorted(map(tuple, rows.collect()), key=str)


@pytest.mark.parametrize("frequent", [3, 16, 10**9])
def test_against_all_pairs(corpus, monkeypatch, frequent):
    monkeypatch.setattr(jaccard_join, "FREQUENT", frequent)
    want = brute(texts(corpus))
    assert found(corpus) == want
    assert len({c for _, _, c in want}) < 80


def test_other_size_and_similarity(corpus):
    assert found(corpus, size=5, similarity=80) == brute(texts(corpus), 5, 80)


def test_odd_rows(odd):
    assert found(odd) == brute(ODD)


def test_similarity_at_the_line(documents):
    base = [f"w{i}" for i in range(103)]  # 100 shingles
    longer = [*base, *(f"x{i}" for i in range(17))]  # 117: 100 / 117 is 0.8547
    one_more = [*base, *(f"y{i}" for i in range(18))]  # 118: 100 / 118 is 0.8475
    rows = [(3, " ".join(base)), (2, " ".join(longer)), (1, " ".join(one_more))]
    assert found(documents(rows)) == [(1, 118, 1), (2, 117, 2), (3, 100, 2)]


def test_empty_table(documents):
    assert found(documents([])) == []


def test_keeps_one_of_each_component(corpus, odd):
    # Of the odd rows, two components have the id 1 and one has none.
    for df, n, more in ((corpus, 0, []), (odd, 4, [1])):
        rows = texts(df)
        kept = jaccard_join.keep_one(df, 5, 80)
        assert kept.columns == df.columns
        sets = [s for s in (shingle_set(t, 5) for _, t in texts(kept))]
        assert sum(not s for s in sets) == n  # those without words all stay
        kept_ids = [i for i, t in texts(kept) if shingle_set(t, 5)]
        labels = {c for _, s, c in brute(rows, 5, 80) if s}
        assert sorted(kept_ids, key=str) == sorted([*labels, *more], key=str)


def test_components_of_a_long_path(spark):
    links = [(i, i + 1) for i in range(0, 99)] + [(200, 201), (201, 200), (7, 7), (None, 3)]
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {tuple(r) for r in got} == {*((i, 0) for i in range(100)), (200, 200), (201, 200)}
    assert len(got) == 102


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sets_that_share_many_frequent_shingles_are_paired_once(documents, monkeypatch):
    # Every shingle is frequent, and bitmaps tell nothing: the shingles of the template are shared.
    rng = random.Random(11)
    template = [f"t{i}" for i in range(60)]
    texts = [" ".join(template + [f"own{rng.random()}" for _ in range(6)]) for _ in range(30)]

    def all_frequent(docs, size):
        columns = [r["text"] for r in docs.collect()]
        values = np.unique(np.concatenate(list(jaccard_join._sets(pa.record_batch({"text": columns}), size))))
        return values, np.ones(len(values), np.int8)

    seen = []

    def unconnected(buckets, labels, fits):
        a, b = (
            buckets.select("bucket", *(F.col(c).alias(f"{c}_{x}") for c in buckets.columns if c != "bucket"))
            for x in "ab"
        )
        pairs = a.join(b, "bucket").where(f"node_a < node_b and {fits}").select("node_a", "node_b")
        seen.append((pairs.count(), pairs.distinct().count()))
        return star.unconnected(buckets, labels, fits)

    monkeypatch.setattr(jaccard_join, "frequent_shingles", all_frequent)
    monkeypatch.setattr(jaccard_join, "_near", lambda similarity: "true")
    monkeypatch.setattr(jaccard_join, "unconnected", unconnected)
    rows = jaccard_join.op3(documents(list(enumerate(texts)))).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == {i: i for i in range(30)}
    [(pairs, distinct)] = seen
    # Under the first shared shingle, and once more if they are of one group.
    assert distinct > 50 and pairs <= 2 * distinct
