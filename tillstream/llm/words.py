"""Token ids of white-space separated words under a tokenizer that drops white space."""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np

# A stem of plain letters before ASCII punctuation. A tokenizer that splits letters from the rest
# always cuts there, and no normalization reaches over the cut.
_STEM = re.compile(
    rb"((?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([!-/:-@\[-`{-~].*)?", re.DOTALL)


class WordIds(dict):
    """Word (UTF-8) to its ids, little-endian unsigned 32-bit; encodes a word when first met.

    Holds at most `most` words, then starts anew.
    """

    def __init__(self, path: str, as_text: bool, most: int = 500_000):
        from tokenizers import Tokenizer
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = as_text
        self.model = self.tokenizer.model
        self.most = most

    def __missing__(self, word: bytes) -> bytes:
        stem = _STEM.fullmatch(word)
        if stem is None:
            ids = self.tokenizer.encode(word.decode(), add_special_tokens=False).ids
            value = np.array(ids, "<u4").tobytes()
        elif stem[2] is None:
            # Byte-level spelling of the letters, then the merges alone.
            spelled = word.decode().lower().encode().decode("latin-1")
            value = np.array([t.id for t in self.model.tokenize(_spell(spelled))],
                             "<u4").tobytes()
        else:
            value = self[stem[1]] + self[stem[2]]
        if len(self) >= self.most:
            self.clear()
        self[word] = value
        return value


def _spell(text: str) -> str:
    return text if text.isascii() else text.translate(_byte_spelling())


@lru_cache(1)
def _byte_spelling() -> dict[int, str]:
    """Byte to the character that stands for it in byte-level vocabularies.

    Printable bytes stand for themselves, the others follow from U+0100 on.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


@lru_cache(4)
def word_ids(path: str, as_text: bool = False) -> WordIds:
    """One per Python worker, so that words stay known from task to task."""
    return WordIds(path, as_text)


def encode(known: WordIds, text: bytes) -> bytes:
    """Ids of a whole text. ASCII case is folded first, as the vocabulary has none, unless the
    text may hold a special token, whose case counts."""
    if b"<|" not in text:
        text = text.lower()
    return b"".join(map(known.__getitem__, text.split()))
