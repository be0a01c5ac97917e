import collections
import hashlib
import random
import re

import numpy as np
import pytest

from ledgerloom.llm import substring_dedup
from ledgerloom.llm.words import Words

from .conftest import ODD, texts

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute(rows, window=35):
    held = [(i, WORD.findall((t or "").encode())) for i, t in rows]
    counts = collections.Counter(
        tuple(w[k : k + window]) for _, w in held for k in range(len(w) - window + 1)
    )
    out = []
    for i, w in held:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if counts[tuple(w[k : k + window])] > 1:
                gone[k : k + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk", [2, 2048])
def test_against_all_windows(corpus, monkeypatch, chunk):
    monkeypatch.setattr(substring_dedup, "CHUNK", chunk)
    want = brute(texts(corpus))
    assert sorted(map(tuple, substring_dedup.op10(corpus).collect()), key=str) == want
    assert sum(r[2] for r in want) > 3000


def test_odd_rows(odd):
    got = sorted(map(tuple, substring_dedup.op10(odd).collect()), key=str)
    assert got == brute(ODD)


def test_repeated_rows_are_copies(documents):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text), (1, text), (2, "a " + text + " b"), (None, text)]
    assert sorted(map(tuple, substring_dedup.op10(documents(rows)).collect()), key=str) == brute(rows)
    once = [(1, text), (2, " ".join(f"v{i}" for i in range(40)))]
    assert {r["n_removed"] for r in substring_dedup.op10(documents(once)).collect()} == {0}


def test_automaton_on_random_words():
    rng = random.Random(9)
    for _ in range(300):
        window = rng.randrange(1, 5)
        held = [
            np.array([rng.randrange(3) for _ in range(rng.randrange(window, 14))], np.uint64)
            for _ in range(rng.randrange(1, 6))
        ]
        counts = collections.Counter(
            tuple(h[k : k + window].tolist()) for h in held for k in range(len(h) - window + 1)
        )
        got = substring_dedup.repeated(held, window)
        for h, hits in zip(held, got, strict=True):
            want = [counts[tuple(h[k : k + window].tolist())] > 1 for k in range(len(h) - window + 1)]
            assert hits.tolist() == want


def test_cut_keeps_layout_and_columns(documents):
    passage = " ".join(f"p{i}" for i in range(35))
    rows = [(1, f"Some\n  text {passage}  and\nmore\n"), (2, passage), (3, "clean\n text"), (4, None)]
    df = documents(rows)
    done = substring_dedup.cut(df, substring_dedup.spans(df))
    assert done.schema == df.schema
    assert sorted(texts(done)) == [(1, "Some\n  text and\nmore\n"), (2, ""), (3, "clean\n text"), (4, None)]


def test_words_in_parts(monkeypatch):
    import pyarrow as pa

    from ledgerloom.llm import words

    data = ["a bb  ccc\n" * 50, None, "", "x" * 300 + " y", " lead", "same same"] * 3
    whole = Words(pa.array(data), places=True)
    monkeypatch.setattr(words, "PART_BYTES", 64)
    parts = Words(pa.array(data), places=True)
    assert (whole.hashes == parts.hashes).all() and (whole.bounds == parts.bounds).all()
    found = [bytes(parts.data[a:b]) for a, b in zip(parts.starts, parts.ends, strict=True)]
    assert found == [w for t in data for w in WORD.findall((t or "").encode())]
    assert (Words(pa.array(["AbZ"]), lower=True).hashes == Words(pa.array(["abz"])).hashes).all()


def test_empty_table(documents):
    assert substring_dedup.op10(documents([])).count() == 0
