import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerloom.llm import retrieval_packing as packing

from .conftest import ODD, texts


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check(rows, length=2048):
    """Sequences are gapless and not too long; returns the ids of padding."""
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    padding = 0
    for held in places.values():
        at = 0
        for offset, n in sorted(held):
            assert offset == at and n > 0
            at += n
        assert at <= length
        padding += 0 if at & (at - 1) == 0 else length - at
    return padding


def whole(tokenizer, rows, got):
    """Each id of each document lies in exactly one piece. Rows that repeat an id hold several."""
    want = Counter()
    for name, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        want[name, len(ids)] += len(ids)
    held = Counter()
    for r in got:
        held[r["doc_id"], r["doc_tokens"]] += r["length"]
    assert held == want
    single = {name for name, n in Counter(n for n, _ in rows).items() if n == 1}
    for name, text in rows:
        if name in single:
            ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
            at = 0
            for r in sorted((r for r in got if r["doc_id"] == name), key=lambda r: r["start"]):
                assert r["start"] == at
                assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
                at += r["length"]
            assert at == len(ids)


@pytest.mark.parametrize("name", ["odd", "corpus"])
def test_pieces_and_places(request, tokenizer, name):
    df = request.getfixturevalue(name)
    rows = packing.op12(df).collect()
    whole(tokenizer, ODD if name == "odd" else texts(df), rows)
    assert check(rows) == 0


def test_special_token_and_exact_window(documents, tokenizer):
    rows = [(1, "x<|endoftext|>y"), (2, " a" * 2047), (3, " a" * 2048), (4, " a" * 4095)]
    got = packing.op12(documents(rows)).collect()
    whole(tokenizer, rows, got)
    assert check(got) == 0
    assert sorted(r["length"] for r in got if r["doc_id"] in (2, 4)) == [2048] * 3


def test_small_blocks_and_shards(documents, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "LEAST_IDS", 500)
    rng = random.Random(5)
    words = "the of and to in that was his he it with is for as had you".split()
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 60)))) for i in range(400)]
    rows += [(1000 + i, "one and the same text") for i in range(300)]
    got = packing.pack(packing.units(documents(rows), 64), 64).collect()
    whole(tokenizer, rows, got)
    assert check(got, 64) == 0


def test_windows_hold_neighbours():
    """Units of a topic share words; a window is filled from the seed's topic."""
    rng = np.random.default_rng(2)
    topics = rng.integers(0, 8, 400)
    block = [
        (i, 0, np.concatenate([rng.integers(0, 50, 20), 100 + t * 40 + rng.integers(0, 40, 30)]), 50)
        for i, t in enumerate(topics.tolist())
    ]
    often = np.bincount(np.concatenate([np.unique(u[2]) for u in block]), minlength=420)
    idf = np.log1p((400 - often + 0.5) / (often + 0.5))
    windows = packing.Windows(500, 0)
    packing.fill(windows, block, idf, 50.0)
    windows.end()
    held = {}
    for doc, _, n, _, _, sequence, _ in windows.out:
        held.setdefault(sequence, []).append((topics[doc], n))
    share = [
        max(sum(n for t, n in x if t == own) for own in range(8)) / sum(n for _, n in x)
        for x in held.values()
        if sum(n for _, n in x) == 500
    ]
    assert np.mean(share) > 0.8  # at random about a quarter


def test_scores_are_bm25():
    rng = np.random.default_rng(0)
    held = [rng.integers(0, 30, rng.integers(1, 40)) for _ in range(50)]
    idf = rng.random(30) + 0.1
    mean = float(np.mean([len(x) for x in held]))
    index = packing.Index(held, idf, mean)
    want = np.zeros(50)
    for u, x in enumerate(held):
        for t in set(held[7].tolist()):
            tf = int((x == t).sum())
            long = packing.K1 * (1 - packing.B + packing.B * len(x) / mean)
            want[u] += idf[t] * tf * (packing.K1 + 1) / (tf + long)
    assert np.allclose(index.scores(7), want)
    used = np.arange(50) % 2 == 0
    index.drop(used)
    assert np.allclose(index.scores(7), np.where(used, 0, want))


def test_frequencies(documents, spark):
    rows = [(1, "a b a"), (2, "b c"), (3, None)]
    held = packing.units(documents(rows))
    got = {r["token"]: r["units"] for r in packing.frequencies(held).collect()}
    units = [packing._ids(r["rest"], r["n"]) for r in held.where("doc_tokens is not null").collect()]
    assert got.pop(-1) == 3 and got.pop(-2) == sum(map(len, units))
    assert got == Counter(t for x in units for t in set(x.tolist()))


def test_empty_table(documents):
    assert packing.op12(documents([])).count() == 0


def test_neighbours_are_found_in_the_whole_shard(spark):
    """Units of one topic lie far apart in a shard; each window still holds one topic only."""
    rng = np.random.default_rng(4)
    topics = np.arange(1500) % 300
    held = [np.concatenate([rng.integers(0, 20, 10), 20 + t * 10 + rng.permutation(10)]) for t in topics]
    seen = np.bincount(np.concatenate([np.unique(x) for x in held]), minlength=3020)
    rows = [(i, 20, [], x.astype("<u2").tobytes(), 20, i) for i, x in enumerate(held)]
    rows.append((None, None, seen.tolist(), None, 1500, 30000))
    schema = "doc_id long, doc_tokens long, crcs array<long>, rest binary, n long, signature long"
    found = {}
    for r in packing.pack(spark.createDataFrame(rows, schema), 100).collect():
        found.setdefault(r["sequence_id"], set()).add(int(topics[r["doc_id"]]))
    assert len(found) == 300
    assert all(len(x) == 1 for x in found.values())
