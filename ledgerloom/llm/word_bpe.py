"""Token ids of a vocabulary with word ends, as the tokenizers library gives them.

The tokenizer of the vocabulary file puts its text into NFC and lower case, drops white space and
merges each match of its pattern on its own, so the ids of a text are those of its words one after
the other. A text of Latin letters, digits and signs, which is its own normal form in lower case, is
cut into matches by marks and merged as a whole by rank: ids are in the order of merges, and a mark
stands for the end of a word. Tests compare that with the library. In other texts (and those that
may hold a special token) each word is encoded once per worker: plain ones match by match by the
library's model, all others by the whole tokenizer.
"""

from __future__ import annotations

import functools
import json
import re

import numpy as np
import public_tokenizers
import regex
import tiktoken
from tokenizers import Tokenizer

VOCABULARY = "word_bpe_49k.json"
CACHE_WORDS = 400_000  # a worker's memory starts anew when it is full
# The pattern in the vocabulary file, fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Characters that are their own NFC and have one lower case in every version of Unicode.
_PLAIN = re.compile("[\t-\r -~¡-ɏ]*")
_ASCII_SPACE = re.compile("[\t-\r ]+")
# The matches of the pattern in such texts that are no runs of letters.
_SIGNS = re.compile(
    r"'(?:s|t|re|ve|m|ll|d)|[!-/:-@\[-`{-~¡-©«-±´¶-¸»¿×÷]+|[0-9²³¹¼-¾]"
)
# Stands for the end of a word. No plain text holds it, nor the byte's own token.
_MARK = "\0"
_GAPS = "\t\n\v\f\r "
_WORD_END = "</w>"


def byte_alphabet() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: itself if it prints,
    else the next free one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = (b for b in range(256) if b not in shown)
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_ALPHABET = byte_alphabet()


class WordBpe:
    def __init__(self, path: str):
        self.path = path
        self.pattern = regex.compile(PATTERN)
        letters = {c: bytes([b]) for b, c in _ALPHABET.items()}
        with open(path, encoding="utf-8") as f:
            held = json.load(f)
        added = {t["id"] for t in held["added_tokens"]}
        ranks = {}
        for token, i in held["model"]["vocab"].items():
            if i not in added:
                body = token.removesuffix(_WORD_END)
                end = _MARK.encode() * (body != token)
                ranks[b"".join(map(letters.__getitem__, body)) + end] = i
        pattern = f"[^{_MARK}]+{_MARK}"
        self.ranks = tiktoken.Encoding(
            "words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self.words: dict[str, bytes] = {}
        self.matches: dict[str, bytes] = {}

    @functools.cached_property
    def tokenizer(self) -> Tokenizer:
        """Only loaded where a text needs it."""
        return Tokenizer.from_file(self.path)

    def _match(self, match: str) -> bytes:
        known = self.matches.get(match)
        if known is None:
            if match.isascii():
                text = match
            else:
                text = match.encode().decode("latin-1").translate(_ALPHABET)
            known = b"".join(t.id.to_bytes(4, "little") for t in self.tokenizer.model.tokenize(text))
            self.matches[match] = known
        return known

    def _word(self, word: str) -> bytes:
        """Ids of a text without ASCII white space."""
        if "<|" not in word and _PLAIN.fullmatch(word):
            return b"".join(map(self._match, self.pattern.findall(word.lower())))
        ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        return b"".join(i.to_bytes(4, "little") for i in ids)

    def _plain(self, text: str) -> bytes:
        """Ids of a plain text, which is in lower case."""
        marked = _SIGNS.sub(f"{_MARK}\\g<0>{_MARK}", text)
        for gap in _GAPS:
            marked = marked.replace(gap, _MARK)
        ids = self.ranks.encode_to_numpy(marked + _MARK, disallowed_special=())
        return ids.astype(np.dtype("<u4")).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out: list[bytes | None] = []
        for t in texts:
            lower = t.lower() if "<|" not in t and _PLAIN.fullmatch(t) else None
            # The one letter here whose lower case is more than a letter has a dot above.
            out.append(None if lower is None or "\u0307" in lower else self._plain(lower))
        split = [
            [w for w in _ASCII_SPACE.split(t) if w] if ids is None else []
            for t, ids in zip(texts, out, strict=True)
        ]
        known = self.words
        if len(known) > CACHE_WORDS:
            known.clear()
        if len(self.matches) > CACHE_WORDS:
            self.matches.clear()
        for word in set().union(*split) - known.keys():
            known[word] = self._word(word)
        return [
            b"".join(map(known.__getitem__, words)) if ids is None else ids
            for ids, words in zip(out, split, strict=True)
        ]


_loaded: dict[str, WordBpe] = {}


def loaded(path: str | None) -> WordBpe:
    """One tokenizer per worker process."""
    path = path or public_tokenizers.path(VOCABULARY)
    if path not in _loaded:
        _loaded[path] = WordBpe(path)
    return _loaded[path]
