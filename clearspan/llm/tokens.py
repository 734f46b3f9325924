"""Token ids of text columns by a public tokenizer, fast on repeating words.

A tokenizer cuts a text into pre-tokens before it merges, so a text can be cut anywhere
where a pre-token ends whatever surrounds it, and each piece encoded once. Pieces end
before a plain space between two visible characters. Ids of pieces already met are kept
for the life of a Python worker, up to a bound, under a 64-bit hash and the length.
"""

from __future__ import annotations

import os
import zlib
from functools import lru_cache

import numpy as np

from clearspan.llm.spans import hash_spans

#: Pieces that one worker keeps; beyond that it starts afresh.
KEPT = 1_500_000
#: Pieces encoded in one call.
_JOINED = 100


def tokenizer_file(name: str) -> str:
    """Path of a public tokenizer file: a path is taken as it is, a bare name is looked up."""
    if os.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".,;:!?)"]] = True


class Pieces:
    """Encoder of one tokenizer file with the ids of the pieces it has met."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.mark = "<|endoftext|>"
        self.mark_id = self.tokenizer.token_to_id(self.mark)
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.where = np.zeros(0, np.int64)  # place of a key's ids
        self.count = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)
        self.fresh: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in a row, and how many each has.

        The tokenizer splits at its special tokens before all else, so pieces joined by one are
        encoded apart at the price of one call. Pieces that may hold one themselves go alone.
        """
        counts = np.zeros(len(texts), np.int64)
        parts: list[np.ndarray] = []
        plain = np.fromiter(("<|" not in x for x in texts), bool, len(texts))
        for a in range(0, len(texts), _JOINED):
            chunk = texts[a : a + _JOINED]
            if plain[a : a + _JOINED].all():
                ids = np.array(self.tokenizer.encode_batch_fast([self.mark.join(chunk)], add_special_tokens=False)[0].ids, np.uint32)
                ends = np.concatenate([np.flatnonzero(ids == self.mark_id), [len(ids)]])
                counts[a : a + len(chunk)] = np.diff(ends, prepend=-1) - 1
                parts.append(ids[ids != self.mark_id])
            else:
                lists = [e.ids for e in self.tokenizer.encode_batch_fast(chunk, add_special_tokens=False)]
                counts[a : a + len(chunk)] = [len(x) for x in lists]
                parts.append(np.array([i for x in lists for i in x], np.uint32))
        return (np.concatenate(parts) if parts else np.zeros(0, np.uint32)), counts

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and for each text the number of ids before it."""
        starts, ends = cut(data, offsets)
        keys = hash_spans(data, starts, ends)
        found, back = np.unique(keys, return_inverse=True)
        at = np.searchsorted(self.keys, found)
        known = np.zeros(len(found), bool)
        if len(self.keys):
            known = self.keys[np.minimum(at, len(self.keys) - 1)] == found
        if not known.all():
            if len(self.keys) > KEPT:
                self.forget()
                known[:] = False
            example = np.empty(len(found), np.int64)
            example[back[::-1]] = np.arange(len(keys))[::-1]
            new = np.flatnonzero(~known)
            raw = data.tobytes()
            texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(starts[example[new]].tolist(), ends[example[new]].tolist(), strict=True)]
            flat, counts = self._encode(texts)
            where = len(self.ids) + np.cumsum(counts) - counts
            self.ids = np.concatenate([self.ids, flat])
            keys_all = np.concatenate([self.keys, found[new]])
            order = np.argsort(keys_all, kind="stable")
            self.keys = keys_all[order]
            self.where = np.concatenate([self.where, where])[order]
            self.count = np.concatenate([self.count, counts])[order]
            at = np.searchsorted(self.keys, found)
        counts = self.count[at][back]
        where = self.where[at][back]
        first = np.cumsum(counts) - counts
        total = int(counts.sum())
        out = self.ids[np.arange(total) - np.repeat(first - where, counts)]
        pieces_before = np.searchsorted(starts, offsets)
        return out, np.concatenate([first, [total]])[pieces_before]


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the pieces: cuts lie before texts, before single spaces between visible
    characters, and between a letter and a stop.

    A byte is surely visible if it is printable ASCII, or belongs to a two-byte letter of the block
    from U+00C0 to U+00FF; anything else might be white space of another kind and is not cut at.
    """
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    visible = (data > 32) & (data < 127)
    latin = data == 0xC3
    starts_visible = visible | latin
    ends_visible = visible.copy()
    ends_visible[1:] |= latin[:-1]
    at = np.zeros(n, bool)
    if n > 2:
        at[1:-1] = (data[1:-1] == 32) & ends_visible[:-2] & starts_visible[2:]
        at[1:] |= _STOP[data[1:]] & _LETTER[data[:-1]]
    edges = offsets[:-1][np.diff(offsets) > 0]
    at[edges] = True
    starts = np.flatnonzero(at)
    return starts, np.concatenate([starts[1:], [n]])


@lru_cache(maxsize=4)
def pieces(path: str) -> Pieces:
    """The worker's encoder for a tokenizer file."""
    return Pieces(path)


def crc_of(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())
