"""Words and word shingles of whole texts as 64-bit hashes, on numpy arrays."""
from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every bit (multiply and shift, three times)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def word_hashes(b: np.ndarray) -> np.ndarray:
    """A hash per word (maximal run without ASCII white space) of the bytes, A-Z lower-cased."""
    space = _SPACE[b]
    at = np.flatnonzero(~space)
    if not len(at):
        return np.zeros(0, np.uint64)
    first = np.r_[True, np.diff(at) > 1]
    starts = np.flatnonzero(first)
    place = np.arange(len(at)) - np.repeat(starts, np.diff(np.r_[starts, len(at)]))
    # a word's bytes, each times a pseudo-random odd number that belongs to its place
    weight = mix(place.astype(np.uint64) + np.uint64(11)) | np.uint64(1)
    return mix(np.add.reduceat((_LOWER[b[at]].astype(np.uint64) + np.uint64(1)) * weight, starts))


def text_words(text: str | None, chunk: int = 1 << 21) -> np.ndarray:
    """Word hashes of a whole text; long texts are taken in pieces cut at white space."""
    if not text:
        return np.zeros(0, np.uint64)
    b = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    if len(b) <= chunk:
        return word_hashes(b)
    out, at = [], 0
    while at < len(b):
        end = min(len(b), at + chunk)
        if end < len(b):
            gaps = np.flatnonzero(_SPACE[b[at:end]])
            while not len(gaps) and end < len(b):  # a word longer than a piece
                end = min(len(b), end + chunk)
                gaps = np.flatnonzero(_SPACE[b[at:end]])
            if len(gaps) and end < len(b):
                end = at + int(gaps[-1]) + 1
        out.append(word_hashes(b[at:end]))
        at = end
    return np.concatenate(out)


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of `size` words; fewer words: the whole sequence as one; none: empty."""
    if not len(words):
        return np.zeros(0, np.uint64)
    n = min(size, len(words))
    total = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        total += words[k:len(words) - n + 1 + k] * (mix(np.array([k + 101], np.uint64))[0] | np.uint64(1))
    return np.unique(mix(total + np.uint64(n)))
