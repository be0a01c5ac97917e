import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ledgerloom.llm import alignment
from ledgerloom.llm.word_bpe import byte_alphabet

from .conftest import ODD, texts

FIELDS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def both():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    path = public_tokenizers.path("piece_bpe_32k.model")
    return a, sentencepiece.SentencePieceProcessor(model_file=path)


def ranges(ids, forms):
    at, out = 0, []
    for i, form in zip(ids, forms, strict=True):
        out.append((i, at, at + len(form)))
        at += len(form)
    return out


def one(both, text):
    """Links and groups of a text, token range by token range."""
    text = text or ""
    letters = {c: b for b, c in byte_alphabet().items()}
    found = both[0].encode(" " + text, add_special_tokens=False)
    forms_a = [bytes(letters[c] for c in t) for t in found.tokens]
    ids = both[1].encode(text)
    forms_b = [
        bytes([int(p[3:5], 16)]) if both[1].is_byte(i) else p.replace("▁", " ").encode()
        for i, p in zip(ids, map(both[1].id_to_piece, ids), strict=True)
    ]
    whole = (" " + text).encode()
    if not text or b"".join(forms_a) != whole or b"".join(forms_b) != whole:
        return 0, 0, [], []
    a, b = ranges(found.ids, forms_a), ranges(ids, forms_b)
    links, first = [], 0
    for i, start, end in a:
        while b[first][2] <= start:
            first += 1
        k = first
        while k < len(b) and b[k][1] < end:
            links.append((i, b[k][0]))
            k += 1
    cuts = sorted({x[2] for x in a} & {x[2] for x in b})
    groups, before = [], 0
    in_a, in_b = iter(a), iter(b)
    for cut in cuts:
        sides = []
        for side in (in_a, in_b):
            held = []
            for i, _, end in side:
                held.append(str(i))
                if end == cut:
                    break
            sides.append(",".join(held))
        groups.append("|".join(sides))
        before = cut
    assert before == len(whole)
    return len(a), len(b), groups, links


def brute(both, rows):
    found = [(name, *one(both, text)) for name, text in rows]
    count = Counter(p for *_, links in found for p in set(links))
    best = Counter()
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    return sorted(
        (
            (
                name, n_a, n_b, len(groups), len(links),
                sum(count[p] == best[p[0]] for p in links),
                sum(count[p] for p in links),
                hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
            )
            for name, n_a, n_b, groups, links in found
        ),
        key=str,
    )


def result(df):
    return sorted((tuple(r[c] for c in ("doc_id", *FIELDS)) for r in df.collect()), key=str)


@pytest.mark.parametrize("name", ["odd", "corpus"])
def test_brute_force(request, both, name):
    df = request.getfixturevalue(name)
    assert result(alignment.op11(df)) == brute(both, ODD if name == "odd" else texts(df))


HARD = [
    (1, "<|endoftext|> and <s></s><unk> are plain text"),
    (2, "a literal ▁ is read as a space, so this has no tokens"),
    (3, "  two spaces,\ttab,\r\nlines\n\n\nand   odd　spaces  "),
    (4, "日本語 ünïcödé 🙂🙃 \x00 \x85 é"),
    (5, "aaaa " * 3000 + "b" * 5000),
    (6, "the the the the"),
    (7, "the the the the"),
]


def test_hard_texts(documents, both):
    assert result(alignment.op11(documents(HARD))) == brute(both, HARD)


def test_postings_of_parts(corpus, both):
    rows = texts(corpus) + HARD
    tokens = alignment.loaded(None, None)
    parts = []
    for i in range(0, len(rows), 5):
        held = [t or "" for _, t in rows[i : i + 5]]
        aligned = alignment.Aligned(*tokens.encode(held), tokens)
        key = np.stack([aligned.pair, aligned.owner + i], axis=1)
        key, links = np.unique(key, axis=0, return_counts=True)
        parts.append((key[:, 0], key[:, 1], links))
    postings = alignment.Postings.of(parts, len(rows))
    assert len(postings.planes) > 2 and len(postings.planes[0].dense) and len(postings.planes[0].numbers)
    links = [one(both, t)[3] for _, t in rows]
    n_docs, n_links = Counter(p for x in links for p in set(x)), Counter(p for x in links for p in x)
    pairs = [(int(p) >> 32, int(p) & 0xFFFFFFFF) for p in postings.pairs]
    held, every = postings.counts()
    assert dict(zip(pairs, held.tolist(), strict=True)) == n_docs
    assert dict(zip(pairs, every.tolist(), strict=True)) == n_links
    scores = postings.scores(held)
    assert scores.tolist() == [sum(n_docs[p] for p in x) for x in links]
    again = [alignment.Bitmaps.unpacked(p.packed(), p.n_docs) for p in postings.planes]
    same = alignment.Postings(postings.pairs, again, len(rows))
    assert same.scores(held).tolist() == scores.tolist()
    member = sorted(zip(*(x.tolist() for x in again[0].members()), strict=True))
    assert member == sorted((pairs.index(p), d) for d, x in enumerate(links) for p in set(x))


def test_pair_counts(corpus, both):
    links = [one(both, t)[3] for _, t in texts(corpus)]
    n_docs, n_links = Counter(p for x in links for p in set(x)), Counter(p for x in links for p in x)
    got = alignment.pair_counts(alignment.blocks(corpus)).collect()
    assert {(r["a"], r["b"]): (r["docs"], r["links"]) for r in got} == {
        p: (n, n_links[p]) for p, n in n_docs.items()
    }
    most = Counter()
    for (a, _), n in n_docs.items():
        most[a] = max(most[a], n)
    assert all(r["best"] == (r["docs"] == most[r["a"]]) for r in got)


def test_texts_without_tokens_only(documents):
    rows = [(1, None), (2, ""), (3, "▁")]
    assert result(alignment.op11(documents(rows))) == [(i, 0, 0, 0, 0, 0, 0, "") for i, _ in rows]


def test_empty_table(documents):
    assert alignment.op11(documents([])).count() == 0


def test_ids_are_the_library_s(both):
    rng = random.Random(3)
    letters = "ab'st  \t\n\r\x0b\x1c\x85  é日🙂.,!0123<|>"
    rows = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(2000)]
    rows += ["x<|endoftext|>y", "<|endoftext|>", "x" * 30_000, " \n" * 10_000]
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    rows += ["".join(f"{c}a 1{c}{c} " for c in every[i : i + 64]) for i in range(0, len(every), 64)]
    for plain in (True, False):
        coder = alignment.byte_ids.loaded(None, plain)
        tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        tokenizer.encode_special_tokens = plain
        want = [tokenizer.encode(t, add_special_tokens=False).ids for t in rows]
        assert [x.tolist() for x in coder.encode(rows)] == want
