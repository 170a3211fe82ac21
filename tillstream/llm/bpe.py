"""Byte-level BPE encoding by a prefix-sharing trie, and decoding.

The last token of a prefix's encoding says all that matters for what follows: if the encoding of p
ends in token t, the rest of it is the encoding of p without t; and t may follow a token u exactly
if no merge across their border comes before the merges that swallow its two sides. So the distinct words of a slice are put into a
trie, which is walked depth first (words sorted by bytes are its preorder, the stack holds the path);
each node gets its last token from the states above it, once for all words that share the prefix.

White space and what follows it up to the next white space is encoded alike wherever it stands, so
encodings of such runs are kept from slice to slice in a bounded table of two generations: a full one
becomes the old one, and what is met again moves to the new one.

Null text counts as empty and has no ids. A very long text is a slice of its own. Rows that repeat a
doc_id each get a row. Empty table: no rows. Other columns are not carried.
"""

from __future__ import annotations

import json
import re
from array import array
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import arrow_map, as_bytes, slices

# Fixed values of the format: the pattern that cuts text into words, and white space as it sees it.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WHITE_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# Each of two generations.
KNOWN_RUNS = 200_000
KNOWN_PAIRS = 400_000
# Words of more text share more prefixes.
SLICE_BYTES = 4 << 20


def _spelled_bytes() -> dict[str, int]:
    """Characters of the vocabulary file to the bytes they stand for."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = sorted(set(range(256)) - set(shown))
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _bytes_of(file: dict) -> dict[int, bytes]:
    """Every id of a vocabulary file with its bytes."""
    spelled = _spelled_bytes()
    found = {i: bytes(spelled[c] for c in t) for t, i in file["model"]["vocab"].items()}
    return found | {t["id"]: t["content"].encode() for t in file["added_tokens"]}


@lru_cache(2)
def token_bytes(path: str) -> dict[int, bytes]:
    """What decoding needs, and no more; one per Python worker."""
    return _bytes_of(json.loads(Path(path).read_text(encoding="utf-8")))


def decode_ids(bytes_of: dict[int, bytes] | list[bytes], ids: np.ndarray) -> bytes:
    """UTF-8 of the ids; bytes that are none become the replacement character."""
    joined = b"".join(map(bytes_of.__getitem__, ids.tolist()))
    return joined.decode("utf-8", "replace").encode()


class Trie:
    """Encodes words, and whole texts, with the merges of one vocabulary file."""

    def __init__(self, path: str):
        file = json.loads(Path(path).read_text(encoding="utf-8"))
        vocabulary = file["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        special_ids = set(self.special.values())
        self.bytes_of = _bytes_of(file)
        self.id_of = {t: i for i, t in self.bytes_of.items() if i not in special_ids}
        # Two ids to (order of the merge, id of the whole).
        self.merge = {}
        for order, pair in enumerate(file["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merge.setdefault((vocabulary[left], vocabulary[right]),
                                  (order, vocabulary[left + right]))
        # Ends of tokens to their id, or to -1: a longer end of a prefix can only be a token if the
        # shorter ones are ends.
        self.tails = dict.fromkeys((t[k:] for t in self.id_of for k in range(1, len(t))), -1) | self.id_of
        # By the token before (None at a word's start): whether a token may follow.
        self.after: dict[int | None, dict[int, bool]] = defaultdict(dict)
        self.known_pairs = 0
        # Of each token made by a merge: (order, left, right). Parts always come before the whole.
        self.made = {whole: (order, *pair) for pair, (order, whole) in self.merge.items()}
        if any(self.made.get(part, (-1,))[0] >= order
               for order, *parts in self.made.values() for part in parts):
            raise ValueError("a merge comes before one that makes its parts")
        self.spines: dict[tuple[int, int], list[tuple[int, float]]] = {}
        self.runs: dict[str, bytes] = {}
        self.old_runs: dict[str, bytes] = {}
        self.width = "<u2" if max(self.bytes_of) < 1 << 16 else "<u4"
        self.words = regex.compile(WORD_PATTERN)
        self.run = re.compile(f"[{WHITE_SPACE}]*[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+")
        self.specials = re.compile("(" + "|".join(map(re.escape, self.special)) + ")"
                                   if self.special else r"(?!)")
        self.special_runs = {content: np.array([number], self.width).tobytes()
                             for content, number in self.special.items()}

    def merged(self, ids: list[int]) -> list[int]:
        """Plain BPE: the earliest merge of the file first, the leftmost of equal ones."""
        ids = list(ids)
        while len(ids) > 1:
            found = [(self.merge[p][0], k) for k, p in enumerate(zip(ids, ids[1:], strict=False))
                     if p in self.merge]
            if not found:
                break
            _, k = min(found)
            ids[k:k + 2] = [self.merge[ids[k], ids[k + 1]][1]]
        return ids

    def spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """What stands at the token's left (1) or right (2) border while it is merged together, each
        with the order of the merge that swallows it."""
        known = self.spines.get((token, side))
        if known is None:
            known, part, swallowed = [], token, float("inf")
            while True:
                known.append((part, swallowed))
                if part not in self.made:
                    break
                swallowed, part = self.made[part][0], self.made[part][side]
            self.spines[token, side] = known
        return known

    def may_follow(self, before: int | None, token: int) -> bool:
        """Whether the token stays whole after `before`; after None, whether it does alone."""
        known = self.after[before].get(token)
        if known is None:
            if before is None:
                letters = [self.id_of[bytes([b])] for b in self.bytes_of[token]]
                known = self.merged(letters) == [token]
            else:
                known = self.may_follow(None, token) and not self._merges_across(before, token)
            if self.known_pairs >= KNOWN_PAIRS:
                self.after.clear()
                self.known_pairs = 0
            self.after[before][token] = known
            self.known_pairs += 1
        return known

    def _merges_across(self, before: int, token: int) -> bool:
        get = self.merge.get
        for left, left_until in self.spine(before, 2):
            for right, right_until in self.spine(token, 1):
                found = get((left, right))
                # Of equal merges the leftmost comes first.
                if found is not None and found[0] < left_until and found[0] <= right_until:
                    return True
        return False

    def encode_words(self, words: Iterable[bytes]) -> dict[bytes, list[int]]:
        """Ids of every distinct word, by one depth-first walk of their trie."""
        out, previous = {}, b""
        # State of each prefix on the path: its last token, and the prefix length before that.
        last: list[int | None] = [None]
        cut = [0]
        tails, after, may_follow = self.tails, self.after, self.may_follow
        for word in sorted(words):
            shared, most = 0, min(len(word), len(previous))
            while shared < most and word[shared] == previous[shared]:
                shared += 1
            del last[shared + 1:], cut[shared + 1:]
            for end in range(shared + 1, len(word) + 1):
                # Just one token can come last. Often it is the one of the prefix before, and a byte more.
                start = cut[end - 1]
                token = tails.get(word[start:end], -1)
                if token >= 0:
                    follows = after[last[start]].get(token)
                    if follows is None:
                        follows = may_follow(last[start], token)
                if token < 0 or not follows:
                    start = end - 1
                    while True:
                        token = tails[word[start:end]]
                        if token >= 0:
                            follows = after[last[start]].get(token)
                            if follows is None:
                                follows = may_follow(last[start], token)
                            if follows:
                                break
                        start -= 1
                last.append(token)
                cut.append(start)
            ids, at = [], len(word)
            while at:
                ids.append(last[at])
                at = cut[at]
            out[word] = ids[::-1]
            previous = word
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts."""
        parted = []
        for text in texts:
            # A special token stands by itself: what is before and after it is cut apart.
            runs = []
            for k, part in enumerate(self.specials.split(text) if self.special else [text]):
                if k % 2:
                    runs.append(part)
                else:
                    runs += self.run.findall(part)
            parted.append(runs)
        if len(self.runs) > KNOWN_RUNS:
            self.old_runs, self.runs = self.runs, {}
        known, old = self.runs, self.old_runs
        if not known:
            known.update(self.special_runs)
        needed = set().union(*parted).difference(known)
        again = needed & old.keys()
        known.update(zip(again, map(old.__getitem__, again), strict=True))
        missing = needed - again
        # A run of letters, with a blank before it or not, is one word.
        cut = {r: [r.encode()] if r.isalpha() or (r[0] == " " and r[1:].isalpha())
               else [w.encode() for w in self.words.findall(r)] for r in missing}
        ids = self.encode_words({w for words in cut.values() for w in words})
        kind = {"<u2": "H", "<u4": "I"}[self.width]
        for run, words in cut.items():
            known[run] = array(kind, [i for w in words for i in ids[w]]).tobytes()
        return [np.frombuffer(b"".join(map(known.__getitem__, runs)), self.width)
                for runs in parted]


@lru_cache(2)
def trie(path: str) -> Trie:
    """One per Python worker."""
    return Trie(path)


def encode(documents: DataFrame, path: str) -> DataFrame:
    """One row per document: doc_id, ids."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = trie(path)
        for batch in slices(batches, most=SLICE_BYTES):
            ids = coder.encode([t.decode() for t in as_bytes(batch)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _lists(ids)],
                                             ["doc_id", "ids"])

    rows = documents.select(F.col("doc_id").cast("bigint"), "text")
    return arrow_map(rows, encoded, "doc_id bigint, ids array<int>")


def _lists(ids: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
    flat = np.concatenate(ids) if ids else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32)))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """One row per row of (doc_id, ids): doc_id, ids, decoded."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = token_bytes(path)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                ids = part.column("ids")
                flat, ends = ids.flatten().to_numpy(), np.cumsum(
                    [0, *(n or 0 for n in ids.value_lengths().to_pylist())])
                texts = [decode_ids(bytes_of, flat[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), ids, pa.array(texts, pa.binary()).cast(pa.string())],
                    ["doc_id", "ids", "decoded"])

    return arrow_map(encoded.select("doc_id", "ids"), decoded,
                     "doc_id bigint, ids array<int>, decoded string")


def encode_and_decode(documents: DataFrame, path: str) -> DataFrame:
    """One row per document: doc_id, ids, decoded, in one pass."""

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = trie(path)
        for batch in slices(batches, most=SLICE_BYTES):
            ids = coder.encode([t.decode() for t in as_bytes(batch)])
            texts = pa.array([decode_ids(coder.bytes_of, i) for i in ids], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), _lists(ids), texts.cast(pa.string())],
                ["doc_id", "ids", "decoded"])

    rows = documents.select(F.col("doc_id").cast("bigint"), "text")
    return arrow_map(rows, coded, "doc_id bigint, ids array<int>, decoded string")
