"""Token ids of a byte-level vocabulary, as the tokenizers library gives them.

The vocabulary file is of the kind whose ids are in the order of its merges, so that byte pairs
merged by least rank give the same ids; tiktoken does that several times as fast. Tests compare both
libraries, for every character too. A text with the string of a special token that is to count as
one goes to the tokenizers library.
"""

from __future__ import annotations

import os
import re

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

from ledgerloom.llm.bpe import SPACE
from ledgerloom.llm.word_bpe import byte_alphabet

VOCABULARY = "byte_bpe_50k.json"
# The pattern takes a run of white space without its last character, or whole at the end of the
# text, as a match of its own. Between such runs it needs no look ahead and is matched faster.
DOUBLE = re.compile(f"[{SPACE}][{SPACE}]")
RUNS = re.compile(rf"([{SPACE}]+(?=[{SPACE}][^{SPACE}])|[{SPACE}]{{2,}}\Z)")
LOOK_AHEAD = r"\s+(?!\S)|\s+"


class ByteIds:
    """`plain`: strings of special tokens inside texts are ordinary text."""

    def __init__(self, path: str, plain: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark fills the cores
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = [] if plain else [t.content for t in added.values()]
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        letters = {c: b for b, c in byte_alphabet().items()}
        self.bytes = {
            i: t.encode() if i in added else bytes(letters[c] for c in t)
            for t, i in self.tokenizer.get_vocab(with_added_tokens=True).items()
        }
        assert public_tokenizers.PATTERN.endswith(LOOK_AHEAD)
        self.ranks = tiktoken.Encoding(
            "vocabulary",
            pat_str=public_tokenizers.PATTERN.removesuffix(LOOK_AHEAD) + r"\s+",
            mergeable_ranks={t: i for i, t in self.bytes.items() if i not in added},
            special_tokens={},
        )

    def _ids(self, text: str) -> np.ndarray:
        if not DOUBLE.search(text):
            return self.ranks.encode_to_numpy(text, disallowed_special=())
        parts = filter(None, RUNS.split(text))
        held = [self.ranks.encode_to_numpy(p, disallowed_special=()) for p in parts]
        return np.concatenate(held)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        out = []
        for text in texts:
            if any(s in text for s in self.special):
                ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids)
            else:
                ids = self._ids(text)
            out.append(ids.astype(self.dtype))
        return out


_loaded: dict[tuple[str, bool], ByteIds] = {}


def loaded(path: str | None, plain: bool) -> ByteIds:
    """One tokenizer per worker process."""
    path = path or public_tokenizers.path(VOCABULARY)
    if (path, plain) not in _loaded:
        _loaded[path, plain] = ByteIds(path, plain)
    return _loaded[path, plain]
