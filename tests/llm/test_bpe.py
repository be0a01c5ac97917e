import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from ledgerloom.llm import bpe

from .conftest import ODD


@pytest.fixture(scope="module")
def coder():
    return bpe.loaded(public_tokenizers.path(bpe.RANKS), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(coder):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={}
    )


def ids_of(library, text):
    return np.array(library.encode_ordinary(text), "<u4").tobytes()


CASES = [
    "", " ", "\n", "a", "It's  they'll\n\n we've\t x", "日本語のテキスト ½²", "a\x1cb\x85c\xa0 d",
    "ab" * 700 + "é" * 300, "a" * 999, "1234567 !!??%% ...", " 　 ​ z ", "<|endoftext|>",
]


def test_ids_are_those_of_the_library(coder, library):
    got = coder.encode(CASES)
    assert got == [ids_of(library, t) for t in CASES]
    assert [coder.decode(x) for x in got] == [t.encode() for t in CASES]


def test_cache_that_starts_anew(coder, library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 2)
    for t in CASES * 2:
        assert coder.encode([t]) == [ids_of(library, t)]


def test_own_ranks_and_pattern():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"ba": 257, b"aba": 258}
    coder = bpe.ByteBpe(ranks, r"\S+")
    assert np.frombuffer(coder.encode(["abab aba ba"])[0], "<u4").tolist() == [256, 256, 258, 257]


def test_query_on_odd_rows(odd, library):
    want = []
    for i, t in ODD:
        ids, raw = ids_of(library, t or ""), (t or "").encode()
        digests = [hashlib.sha256(x).hexdigest() for x in (ids, raw)]
        want.append((i, len(ids) // 4, *digests))
    assert sorted(map(tuple, bpe.op1(odd).collect()), key=str) == sorted(want, key=str)


def test_decode_of_a_table(spark, coder):
    ids = coder.encode(["a b"])[0]
    df = spark.createDataFrame([("x", bytearray(ids)), ("y", None)], "doc_id string, ids binary")
    assert {r[0]: bytes(r[1]) for r in bpe.decode(df).collect()} == {"x": b"a b", "y": b""}


def test_empty_table(documents):
    assert bpe.op1(documents([])).count() == 0
