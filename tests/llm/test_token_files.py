import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerloom.llm import simple8b, token_files, word_bpe

from .conftest import ODD, texts


@pytest.mark.parametrize(
    "values",
    [
        [], [0], [0] * 5000, list(range(5000)), [1 << 59, (1 << 60) - 2, (1 << 60) - 1, 1 << 63, 7] * 300,
        [1, 0, 1] * 700 + [49407] * 3 + [0] * 241, [(1 << 64) - 1],
    ],
)
@pytest.mark.parametrize("block", [256, 1024])
def test_round_trip(values, block):
    page = simple8b.pack(np.array(values, np.uint64), block)
    assert simple8b.unpack(page).tolist() == values


def test_words_are_packed_densely():
    rng = np.random.default_rng(0)
    bits = 8 * len(simple8b.pack(rng.integers(0, 1 << 12, 100_000)))
    assert bits < 13 * 100_000
    assert len(simple8b.pack(np.zeros(100_000, np.uint64))) < 5000


def test_other_bytes_are_refused():
    with pytest.raises(ValueError):
        simple8b.unpack(b"x" * 64)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


CASES = [
    "", "It's WE'LL Don'T", "Σας ΣΑΣ. áb İI ﬁ", "x<|endoftext|>y <|startoftext|>", "a\x1cb\x85c\xa0d",
    "日本語 ½²ª 1234", "ÀÉÎÕÜ ß ñ ǅ Ȃ", "😀👍🏽 ‍",
]


def test_ids_are_those_of_the_library(tokenizer):
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in CASES]
    got = word_bpe.loaded(None).encode(CASES)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == want


def test_ids_of_all_plain_characters(tokenizer):
    rng = np.random.default_rng(3)
    letters = [*map(chr, [*range(9, 14), *range(32, 127), *range(161, 592)])]
    rows = ["".join(f"{a}{b}x {b}1{a}'s{a} " for a, b in zip(letters[i : i + 20], letters[i + 7 : i + 27])) for i in range(0, len(letters), 20)]
    rows += ["".join(rng.choice([*"abst'  .,1\n\tÉß", "'re", "'LL", "İ", "<|"], 40)) for _ in range(2000)]
    rows += ["x" * 5000, "", " ", "\n", "'", "''s", ".'s", "' s"]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in rows]
    got = word_bpe.loaded(None).encode(rows)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == want


def wanted(tokenizer, rows):
    out, start = [], 0
    for name, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((name, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_rows_in_order_of_ids(corpus, tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "PAGE_IDS", 300)
    got = sorted(map(tuple, token_files.op9(corpus.repartition(5)).collect()))
    assert got == wanted(tokenizer, sorted(texts(corpus)))


def test_odd_rows(odd, tokenizer):
    rows = [tuple(r) for r in token_files.op9(odd).collect()]
    got = sorted(rows, key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((i for i, _ in ODD), key=lambda i: -1 if i is None else i)
    ends = np.cumsum([r[2] for r in got])
    assert [r[1] for r in got] == [0, *ends[:-1].tolist()]
    bare = sorted((r[0], *r[2:]) for r in rows if r[0] is not None)
    assert bare == sorted((r[0], *r[2:]) for r in wanted(tokenizer, ODD) if r[0] is not None)


def test_written_files(spark, corpus, tmp_path):
    token_files.write_pages(corpus).write.parquet(str(tmp_path / "pages"))
    back = token_files.read_ids(token_files.files(spark, str(tmp_path / "pages")))
    assert back.count() == corpus.count()


def test_empty_table(documents):
    assert token_files.op9(documents([])).count() == 0
