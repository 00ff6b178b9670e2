"""Vectorised words and fingerprints of a batch of texts (numpy, inside tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

# Fixed odd multipliers of the fingerprints.
WORD_BASE = np.uint64(0x9E3779B97F4A7C15)
SHINGLE_BASE = np.uint64(0xC2B2AE3D27D4EB4F)
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Lower-case letters and digits stay, upper case is folded, other ASCII becomes a space.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32 for c in range(256)
)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * MIX_1
    h = h ^ (h >> np.uint64(27))
    h = h * MIX_2
    return h ^ (h >> np.uint64(31))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit fingerprints of all words, and the offsets at which each text's words begin.

    Words are maximal runs of bytes other than ASCII white space. The result has
    ``len(texts) + 1`` offsets.
    """
    pieces, offsets = word_pieces(texts, ())
    return pieces[:, 0], offsets


def word_pieces(texts: list[bytes], prefixes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """As :func:`word_hashes`, with a column for the first so many bytes of each word.

    A word that is not longer than a prefix has 0 in its column.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    buffer = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    space = _SPACE[buffer]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(buffer) and not space[0]:
        edge = np.concatenate(([0], edge))
    start, end = edge[0::2], edge[1::2]
    if len(start) > len(end):
        end = np.append(end, len(buffer))
    ends_of_text = np.cumsum(sizes + 1)
    offsets = np.concatenate(([0], np.searchsorted(start, ends_of_text)))
    length = end - start
    order = np.argsort(-length, kind="stable")
    first, ordered = start[order], length[order]
    h = np.full(len(start), 0x51ED270B, np.uint64)
    # Horner's rule one character at a time over the words that are still that long
    still = np.searchsorted(-ordered, -np.arange(1, (ordered[0] if len(ordered) else 0) + 1), side="right")
    out = np.zeros((len(start), 1 + len(prefixes)), np.uint64)
    for j, k in enumerate(still):
        if j in prefixes:
            out[order[:k], 1 + prefixes.index(j)] = mix(h[:k] ^ np.uint64(j))
        part = h[:k]
        part *= WORD_BASE
        part += buffer[first[:k] + j]
        part ^= part >> np.uint64(29)
    out[order, 0] = mix(h)
    return out, offsets


def shingle_sets(texts: list[bytes], width: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct fingerprints of its ``width``-word shingles.

    A text of fewer words has one shingle, its whole sequence; one without words none.
    """
    words, offsets = word_hashes(texts)
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        w = words[a:b]
        if not len(w):
            yield w
            continue
        if len(w) < width:
            h = np.array([len(w)], np.uint64)
            for x in w:
                h = h * SHINGLE_BASE + x
        else:
            n = len(w) - width + 1
            h = np.full(n, width, np.uint64)
            for j in range(width):
                h = h * SHINGLE_BASE + w[j : j + n]
        yield np.unique(mix(h))


def batches(texts: list[bytes], most_bytes: int) -> Iterator[slice]:
    """Slices of consecutive texts of about ``most_bytes``; a longer text stands alone."""
    begin = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most_bytes:
            yield slice(begin, i)
            begin, size = i, 0
        size += len(t) + 1
    if begin < len(texts):
        yield slice(begin, len(texts))
