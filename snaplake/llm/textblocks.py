"""Vectorised word splitting and hashing of Arrow string columns.

Tasks receive Arrow batches from Spark; these helpers view a batch as one flat
byte buffer and find, hash and slice its words with numpy, so no Python loop
runs per word.  Nothing here talks to Spark.

Nulls count as empty texts.  A block never cuts a text: a text longer than the
block size is a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
SEGMENT = 1 << 19
#: The white space bytes that separate words (space and 9-13).
WHITE = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[list(WHITE)] = False
#: Letters only: A-Z, a-z and every byte of a multi-byte character.
_IS_LETTER = np.zeros(256, dtype=bool)
_IS_LETTER[65:91] = _IS_LETTER[97:123] = _IS_LETTER[128:] = True
#: Bytes that may end a sentence.
_IS_STOP = np.zeros(256, dtype=bool)
_IS_STOP[[ord(c) for c in ".!?\n"]] = True

#: A byte table and a base for each of two independent hashes.
_BYTE = np.random.default_rng(20240607).integers(1, 2**63, (2, 256), dtype=np.uint64) * U64(2) + U64(1)
_BASE = (0x9E3779B97F4A7C15 | 1, 0xBB67AE8584CAA73B | 1)
_WORD_BASE = 0xD6E8FEB86659FD93 | 1
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_table(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n; the longest table so far is kept."""
    if base not in _powers or len(_powers[base][0]) < n:
        size = max(n, 1 << 16)
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            t = np.full(size, b & (2**64 - 1), dtype=np.uint64)
            t[0] = 1
            both.append(np.multiply.accumulate(t))
        _powers[base] = both[0], both[1]
    return _powers[base]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@dataclass
class Words:
    """Words of some texts, in order. offsets[i]:offsets[i + 1] are those of text i."""

    buf: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray
    text_offsets: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def text_ids(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)

    def hashes(self, lane: int = 0) -> np.ndarray:
        """One well mixed 64-bit value a word; equal words, equal values. Lanes 0 and 1 share
        no table, so words that collide in one are as likely as others to in the other."""
        out = np.zeros(len(self.starts), dtype=np.uint64)
        i = 0
        while i < len(out):
            # Half a megabyte at a time stays in the processor's cache and keeps tables short.
            zero = int(self.starts[i])
            j = max(i + 1, int(np.searchsorted(self.ends, zero + SEGMENT, side="right")))
            part = self.buf[zero : int(self.ends[j - 1])]
            up, down = _power_table(_BASE[lane], len(part) + 1)
            total = np.zeros(len(part) + 1, dtype=np.uint64)
            np.cumsum(_BYTE[lane][part] * up[: len(part)], out=total[1:])
            first, last = self.starts[i:j] - zero, self.ends[i:j] - zero
            out[i:j] = mix((total[last] - total[first]) * down[first] + (last - first).astype(np.uint64))
            i = j
        return out

    def packed(self, first: np.ndarray, last: np.ndarray) -> tuple[bytes, list[bytes]]:
        """Words first[i]..last[i] (inclusive), joined by one space, for every i."""
        flat, at, end = self.joined()
        a, b = at[first], end[last]
        return flat, [flat[x:y] for x, y in zip(a.tolist(), b.tolist(), strict=True)]

    def joined(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        """All words with one space between neighbours, and where each starts and ends."""
        lens = self.ends - self.starts
        at = np.zeros(len(lens), dtype=np.int64)
        if len(lens):
            np.cumsum(lens[:-1] + 1, out=at[1:])
        keep = np.zeros(len(self.buf) + 1, dtype=bool)
        keep[:-1] = _IS_WORD[self.buf]
        keep[self.ends] = True
        # A word that ends where the next text starts has no separator byte of its own.
        tight = np.flatnonzero(self.ends[:-1] == self.starts[1:]) if len(lens) else lens
        src = self.buf if not len(tight) else np.insert(self.buf, self.starts[tight + 1], 0x20)
        if len(tight):
            shift = np.zeros(len(lens), dtype=np.int64)
            shift[tight + 1] = 1
            shift = np.cumsum(shift)
            keep = np.zeros(len(src) + 1, dtype=bool)
            keep[:-1] = _IS_WORD[src]
            keep[self.ends + shift] = True
        keep = keep[: len(src)]
        flat = src[keep]
        flat = np.where(_IS_WORD[flat], flat, np.uint8(0x20))
        return flat.tobytes(), at, at + lens


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the n + 1 places where they start."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("") if texts.null_count else texts
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offs, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    at = np.frombuffer(offs, dtype=np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    buf = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, dtype=np.uint8)
    return buf, at - at[0]


def split(texts: pa.Array, *, lower: bool = False, letters: bool = False) -> Words:
    """Words of every text: runs without white space, or (letters) runs of letters."""
    buf, at = flat(texts)
    if lower:
        buf = _LOWER[buf]
    inside = (_IS_LETTER if letters else _IS_WORD)[buf]
    before = np.zeros(len(buf) + 1, dtype=bool)
    before[1:] = inside
    before[at] = False  # a text starts anew
    starts = np.flatnonzero(inside & ~before[:-1])
    after = np.zeros(len(buf) + 1, dtype=bool)
    after[: len(buf)] = inside
    after[at] = False
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return Words(buf, starts, ends, np.searchsorted(starts, at), at)


def sentence_ids(words: Words) -> np.ndarray:
    """A number for each word that grows wherever a stop or a new text stands before it."""
    stops = np.cumsum(_IS_STOP[words.buf], dtype=np.int64)
    return stops[words.starts] + words.text_ids() if len(words.starts) else np.zeros(0, dtype=np.int64)


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit value for each k neighbours of h: len(h) - k + 1 values."""
    if len(h) < k:
        return np.zeros(0, dtype=np.uint64)
    up, down = _power_table(_WORD_BASE, len(h) + 1)
    total = np.zeros(len(h) + 1, dtype=np.uint64)
    np.cumsum(h * up[: len(h)], out=total[1:])
    return mix((total[k:] - total[:-k]) * down[: len(h) - k + 1])


def blocks(texts: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts of about size bytes; a longer text stands alone."""
    at = flat(texts)[1]
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + size, side="right")) - 1)
        yield i, min(j, n)
        i = j


def ranges(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """starts[0] .. starts[0] + lens[0] - 1, then those of 1, and so on."""
    total = int(lens.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    at = np.cumsum(lens) - lens
    return np.repeat(starts - at, lens) + np.arange(total)


def split_where(buf: np.ndarray, at: np.ndarray, inside: np.ndarray, breaks: np.ndarray | None = None) -> Words:
    """Words of texts at[i]:at[i + 1] of buf: runs where inside is True; at breaks a new
    word begins."""
    at = at if breaks is None else np.concatenate([at, breaks])
    before = np.zeros(len(buf) + 1, dtype=bool)
    before[1:] = inside
    before[at] = False
    after = np.zeros(len(buf) + 1, dtype=bool)
    after[: len(buf)] = inside
    after[at] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    at = at if breaks is None else at[: len(at) - len(breaks)]
    return Words(buf, starts, np.flatnonzero(inside & ~after[1:]) + 1, np.searchsorted(starts, at), at)


def not_white(buf: np.ndarray) -> np.ndarray:
    return _IS_WORD[buf]


def lowered(buf: np.ndarray) -> np.ndarray:
    return _LOWER[buf]
