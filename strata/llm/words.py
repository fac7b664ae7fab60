"""Words and shingles of many texts at once, as 64-bit hashes, in numpy.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and
carriage return. Its hash takes eight bytes at a time, with a mixing step after each, for all
words of a batch at once; words of up to eight bytes have different hashes if they differ
and are equally long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

SLICE = 1 << 18  # bytes handled at once: temporaries take some 50 times that
LONG_WORD = 64  # bytes; longer words are hashed on their own

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_ODD = np.uint64(0x9E3779B97F4A7C15)
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)  # masks of the first n bytes


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _hash_slice(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the words of ``raw``, which ends with a space."""
    buf = np.frombuffer(raw, np.uint8)
    space = _SPACE[buf]
    before = np.concatenate([[True], space[:-1]])
    starts, ends = np.flatnonzero(~space & before), np.flatnonzero(space & ~before)
    size = ends - starts
    ahead = np.ndarray(len(raw), "<u8", raw + bytes(8), strides=(1,))  # the next eight bytes of every place
    with np.errstate(over="ignore"):
        h = mix(size.astype(np.uint64) * _ODD)
        for step in range(0, LONG_WORD, 8):
            some = np.flatnonzero(size > step) if step else slice(None)
            if step and not len(some):
                break
            block = ahead[starts[some] + step] & _FIRST[np.minimum(size[some] - step, 8)]
            h[some] = mix((h[some] ^ block) * _ODD)
    for i in np.flatnonzero(size > LONG_WORD):
        h[i] = xxhash.xxh64_intdigest(raw[starts[i]:ends[i]])
    return h, starts, ends


def _slices(raw: bytes) -> Iterator[tuple[int, bytes]]:
    """Parts of about ``SLICE`` bytes that end behind a space, with their offsets."""
    at = 0
    while at < len(raw):
        end = min(at + SLICE, len(raw))
        while end < len(raw) and not _SPACE[raw[end - 1]]:
            end += 1
        yield at, raw[at:end]
        at = end


def word_hashes(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts together: hashes, byte starts and ends (in the text), and bounds: the
    words of text ``i`` are ``bounds[i]:bounds[i + 1]``."""
    raw = b" ".join(texts) + b" "
    if lower:
        raw = raw.translate(_LOWER)
    parts = [(h, s + at, e + at) for at, part in _slices(raw) for h, s, e in [_hash_slice(part)]]
    h, s, e = (np.concatenate(x) for x in zip(*parts))
    offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
    bounds = np.searchsorted(s, offsets)
    lengths = np.diff(bounds)
    shift = np.repeat(offsets[:-1], lengths)
    return h, s - shift, e - shift, bounds


def groups(texts: list[str], size: int = SLICE) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts of about ``size`` bytes together, with the place of the first."""
    held, at, total = [], 0, 0
    for i, t in enumerate(texts):
        raw = t.encode()
        if held and total + len(raw) > size:
            yield at, held
            held, at, total = [], i, 0
        held.append(raw)
        total += len(raw)
    if held:
        yield at, held


def _factors(k: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def ngrams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each place on; ``len(h) - k + 1`` of them. Places are
    not told apart by text: those that cross into the next text are for the caller to
    leave out."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    f = _factors(k, 77)
    n = len(h) - k + 1
    with np.errstate(over="ignore"):
        total = h[:n] * f[0]
        for j in range(1, k):
            total += h[j:j + n] * f[j]
    return mix(total)


def whole(h: np.ndarray) -> np.ndarray:
    """One hash for a sequence shorter than a shingle."""
    with np.errstate(over="ignore"):
        return mix(np.array([np.sum(h * _factors(len(h), 77), dtype=np.uint64) + np.uint64(len(h))], np.uint64))


def shingle_sets(texts: list[bytes], k: int, lower: bool = True) -> list[np.ndarray]:
    """Sorted distinct ``k``-word shingles of each text; fewer words count as one; a text
    without words has none."""
    h, _, _, bounds = word_hashes(texts, lower)
    grams = ngrams(h, k)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(grams[a:b - k + 1]))
        else:
            out.append(whole(h[a:b]) if b > a else np.zeros(0, np.uint64))
    return out
