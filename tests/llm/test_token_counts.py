import json
import random
import unicodedata

import public_tokenizers
import regex
from tokenizers import models

from ledgerloom.llm import token_counts
from ledgerloom.llm.word_bpe import byte_alphabet

from .conftest import ODD, texts


def longest_match(word, first, later):
    at = n = 0
    while at < len(word):
        held = first if at == 0 else later
        for end in range(len(word), at, -1):
            if word[at:end] in held:
                break
        else:
            return 1
        at, n = end, n + 1
    return n


def test_random_vocabularies():
    rng = random.Random(2)

    def piece():
        return bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 6)))

    for case in range(200):
        first = {piece() for _ in range(rng.randrange(1, 12))} | ({b"a", b"b", b"c"} if case % 2 else set())
        later = None if case % 3 == 0 else {piece() for _ in range(rng.randrange(1, 12))} | {b"a"}
        automaton = token_counts.LongestMatch(sorted(first), later and sorted(later))
        for _ in range(50):
            word = bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 15)))
            assert automaton.count(word) == longest_match(word, first, first if later is None else later)


def test_prefix_marks_later_pieces():
    vocabulary = ["a", "abcdx", "##b", "##c", "##cdy", "##dz", "d"]
    counter = token_counts.TokenCounter(vocabulary, end="", prefix="##", byte_level=False)
    assert counter.count(["abcdz", "abcdy", "d abc", "abcd"]) == [(1, 4), (1, 3), (2, 4), (1, 1)]


def library_counts(rows):
    path = public_tokenizers.path(token_counts.VOCABULARY)
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    pieces = {p.removesuffix("</w>"): i for p, i in vocabulary.items() if not p.startswith("<|")}
    model = models.WordPiece(
        vocab={**pieces, "<unk>": 0}, unk_token="<unk>", continuing_subword_prefix="",
        max_input_chars_per_word=10**6,
    )
    alphabet = byte_alphabet()
    out = []
    for name, text in rows:
        words = regex.findall(token_counts.WORDS, unicodedata.normalize("NFC", text or "").lower())
        mapped = ["".join(alphabet[b] for b in w.encode()) for w in words]
        out.append((name, len(words), sum(len(model.tokenize(w)) for w in mapped)))
    return sorted(out, key=str)


def test_counts_are_those_of_the_library(odd, corpus):
    for df, rows in ((odd, ODD), (corpus, texts(corpus))):
        assert sorted(map(tuple, token_counts.op7(df).collect()), key=str) == library_counts(rows)


def test_staged_documents(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = sorted(map(tuple, token_counts.op7(df).collect()), key=str)
    assert got == library_counts(texts(df))


def test_empty_table(documents):
    assert token_counts.op7(documents([])).count() == 0
