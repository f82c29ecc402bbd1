"""64-bit hashes of words and word shingles, vectorised with NumPy.

Words are the runs of bytes other than ``[\\x20\\x09-\\x0D]`` of the UTF-8
text; a word's hash is a position-weighted sum of random byte weights, mixed.
Used inside Spark tasks over slices of an Arrow batch (``slices``), so memory
is about 40 bytes per byte of a slice or of its one text if that is longer.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

_SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
SLICE_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and odd multipliers)."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x9FB21C651E98DF25)
    x ^= x >> np.uint64(32)
    return x


def stream(n: int, seed: int) -> np.ndarray:
    """n pseudo-random 64-bit numbers, the same on every machine."""
    steps = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(mix(steps + np.uint64(seed)) + np.uint64(0x632BE59BD9B4E019))


_BYTE = stream(256, 11)
_IS_WORD = np.ones(256, dtype=bool)
for _b in _SPACES:
    _BYTE[_b] = 0
    _IS_WORD[_b] = False
_place = stream(64, 12) | np.uint64(1)


def _places(n: int) -> np.ndarray:
    global _place
    if len(_place) < n:
        _place = stream(2 * n, 12) | np.uint64(1)
    return _place


def slices(texts: Sequence[bytes], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes together, one text at least."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        if i > begin and size + len(t) > limit:
            yield begin, i
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield begin, len(texts)


def word_hashes(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words of the texts, in order, and ``len(texts) + 1``
    offsets: text i owns ``hashes[offsets[i]:offsets[i + 1]]``."""
    ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
    raw = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    word = _IS_WORD[raw]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    starts = np.flatnonzero(begins)
    offsets = np.concatenate(([0], np.searchsorted(starts, ends)))
    if not len(starts):
        return np.empty(0, np.uint64), offsets
    raw = raw[starts[0]:]
    rel = starts - starts[0]
    lengths = np.diff(np.append(rel, len(raw)))  # each with the blanks behind it, whose weight is 0
    at = np.arange(len(raw)) - np.repeat(rel, lengths)
    # blanks may be many: their place is not needed
    weighted = _BYTE[raw] * _places(int(min(lengths.max(), 1 << 16)))[at & 0xFFFF]
    if lengths.max() > 1 << 16:  # words longer than the table: the block number weighs in as well
        weighted *= (mix((at >> 16).astype(np.uint64)) << np.uint64(1)) | np.uint64(1)
    return mix(np.add.reduceat(weighted, rel)), offsets


def shingle_sets(texts: Sequence[bytes], width: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``width`` words;
    a text with fewer words gives its whole word sequence as one, a text
    without words the empty set."""
    words, offsets = word_hashes(texts)
    out: list[np.ndarray] = []
    runs = np.full(len(words), np.uint64(width))
    for i in range(width):
        runs[:len(words) - i] = mix(runs[:len(words) - i] * np.uint64(0xC2B2AE3D27D4EB4F) + words[i:])
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        n = b - a
        if n >= width:
            own = np.sort(runs[a:b - width + 1])
            out.append(own[np.concatenate(([True], own[1:] != own[:-1]))])
        elif n:
            short = np.full(1, np.uint64(n))
            for i in range(n):
                short = mix(short * np.uint64(0xC2B2AE3D27D4EB4F) + words[a + i:a + i + 1])
            out.append(short)
        else:
            out.append(words[:0])
    return out
