import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerloom.llm import packing

from .conftest import ODD, texts


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def wanted_pieces(tokenizer, rows):
    out = []
    for name, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for i, at in enumerate(range(0, len(ids), 4096)):
            held = ids[at : at + 4096]
            crc = zlib.crc32(np.array(held, "<u4").tobytes())
            out.append((name, i, at, len(held), crc))
    return sorted(out, key=str)


def check(rows, capacity=4096):
    """Sequences are gapless and not too long; returns their number."""
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


@pytest.mark.parametrize("name", ["odd", "corpus"])
def test_pieces_and_places(request, tokenizer, name):
    df = request.getfixturevalue(name)
    rows = packing.op6(df).collect()
    got = sorted((tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in rows), key=str)
    assert got == wanted_pieces(tokenizer, ODD if name == "odd" else texts(df))
    least = -(-sum(r["length"] for r in rows) // 4096)
    assert check(rows) <= least + 1


def test_demes_and_islands(spark, monkeypatch):
    monkeypatch.setattr(packing, "DEME", 5000)
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 101, 1000).tolist()
    df = spark.createDataFrame([(i, x) for i, x in enumerate(sizes)], "name long, length long")
    rows = packing.pack(df, 100).collect()
    assert sorted((r["name"], r["length"]) for r in rows) == list(enumerate(sizes))
    held = np.array(sizes)
    order = np.argsort(-held, kind="stable")
    none = np.zeros(0, np.int64)
    at_once = packing.best_fit(order, sizes, np.zeros(1000, np.int64), none, 100)
    # Dealing into demes costs no more than two sequences in a hundred, in demes of fifty.
    assert check(rows, 100) <= 1.02 * (at_once.max() + 1)


def test_empty_documents_fill_sequences(documents):
    assert check(packing.op6(documents([(i, None) for i in range(24576)])).collect()) == 6


@pytest.mark.parametrize("deme", [1 << 20, 1 << 17])
def test_short_pieces(spark, monkeypatch, deme):
    monkeypatch.setattr(packing, "DEME", deme)
    sizes = np.random.default_rng(2).integers(1, 21, 60000)
    rows = packing.pack(spark.createDataFrame([(i, int(x)) for i, x in enumerate(sizes)], "name long, length long"))
    least = -(-int(sizes.sum()) // 4096)
    assert check(rows.collect()) <= least + 1


def test_evolution_beats_its_start():
    rng = np.random.default_rng(4)
    sizes = rng.choice([26, 27, 31, 35, 42, 51], 400)
    none = np.zeros(0, np.int64)
    order = np.argsort(-sizes, kind="stable")
    start = packing.best_fit(order, sizes.tolist(), np.zeros(400, np.int64), none, 100)
    best = packing.evolve(sizes, 100, 0, [], population=6, offspring=60)
    assert np.bincount(best, sizes).max() <= 100
    assert packing.fitness(best, sizes, 100) > packing.fitness(start, sizes, 100)
    elite = packing.evolve(sizes, 100, 1, [start, best])
    assert packing.fitness(elite, sizes, 100) >= packing.fitness(best, sizes, 100)


def test_offspring_packs_each_piece_once():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 60, 300)
    parents = [
        packing.best_fit(rng.permutation(300), sizes.tolist(), np.zeros(300, np.int64), np.zeros(0, np.int64), 100)
        for _ in range(2)
    ]
    for _ in range(20):
        child = packing.cross(*parents, sizes, 100, rng)
        assert len(child) == 300 and np.bincount(child, sizes).max() <= 100


def test_empty_table(documents):
    assert packing.op6(documents([])).count() == 0
