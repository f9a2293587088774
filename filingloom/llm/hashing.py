"""Words and n-grams of many texts at once, as 64-bit hashes, by array arithmetic over their bytes.

A word is a run of bytes that are no ASCII white space; A-Z count as a-z. Its hash is a polynomial over its bytes (each
replaced by a random number), taken from one running sum over the text, so no word becomes a Python object.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
#: Bytes of text that are hashed together; they bound the arrays that a task holds, but for one text or word longer still.
CHUNK = 1 << 18


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


FACTOR = U(0x9E3779B97F4A7C15)
BACK = U(pow(int(FACTOR), -1, 1 << 64))
BYTE = mix64(np.arange(1, 257, dtype=U))
BYTE[65:91] = BYTE[97:123]
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


def powers(base: np.uint64, n: int, known: dict) -> np.ndarray:
    """1, base, base ** 2, ... up to n numbers at least; known keeps them."""
    if len(known.get(base, ())) < n:
        steps = np.full(1 << max(n, CHUNK).bit_length(), base, U)
        steps[0] = 1
        known[base] = np.cumprod(steps)
    return known[base]


def changes(*columns: np.ndarray) -> np.ndarray:
    """Whether a row differs from the one before in any column; the first does."""
    out = np.ones(len(columns[0]), bool)
    if len(out):
        out[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return out


def distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[changes(x)]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of strings (null as empty) and where each begins; one more offset than texts."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def portions(offsets: np.ndarray, most: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most so many bytes together, one text at least."""
    at = 0
    while at < len(offsets) - 1:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, end
        at = end


def word_hashes(data: np.ndarray, offsets: np.ndarray, known: dict, most: int = CHUNK) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word, and the number of words of each text. A long text is cut at white space."""
    found, begins, at, length = [], [], 0, len(data)
    starts = offsets[:-1][offsets[:-1] < length]
    ends = offsets[1:][offsets[1:] > 0] - 1
    while at < length:
        stop = min(length, at + most)
        if stop < length:  # move to a blank or to a text's end, so that no word is cut
            back = np.flatnonzero(BLANK[data[at:stop]])
            edge = starts[(starts > at) & (starts <= stop)]
            last = max(at + back[-1] + 1 if len(back) else 0, edge[-1] if len(edge) else 0)
            while last <= at:  # a word longer than a portion
                more = data[stop : stop + most]
                ahead = np.flatnonzero(BLANK[more])
                edge = starts[(starts > stop) & (starts <= stop + len(more))]
                nexts = [stop + x for x in ahead[:1]] + list(edge[:1])
                stop += len(more)
                last = min(nexts) if nexts else stop if stop >= length else 0
            stop = int(last)
        part = data[at:stop]
        word = np.zeros(len(part) + 2, bool)
        word[1:-1] = ~BLANK[part]
        here = word[1:-1]
        first, final = here & ~word[:-2], here & ~word[2:]
        s = starts[np.searchsorted(starts, at) : np.searchsorted(starts, stop)] - at
        first[s] = here[s]
        e = ends[np.searchsorted(ends, at) : np.searchsorted(ends, stop)] - at
        final[e] = here[e]
        a, b = np.flatnonzero(first), np.flatnonzero(final) + 1
        total = np.zeros(len(part) + 1, U)
        np.cumsum(BYTE[part] * powers(FACTOR, len(part) + 1, known)[: len(part)], out=total[1:])
        found.append(mix64((total[b] - total[a]) * powers(BACK, len(part) + 1, known)[a] + (b - a).astype(U)))
        begins.append(a + at)
        at = stop
    every = np.concatenate(begins) if begins else np.zeros(0, np.int64)
    return (np.concatenate(found) if found else np.zeros(0, U)), np.diff(np.searchsorted(every, offsets))


def gram_sets(data: np.ndarray, offsets: np.ndarray, n: int, known: dict) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-gram hashes of each text, sorted within it, and how many it has; fewer words than n are one gram."""
    w, many = word_hashes(data, offsets, known)
    windows = np.where(many >= n, many - n + 1, many > 0)
    first = np.r_[0, np.cumsum(windows)]
    text = np.repeat(np.arange(len(many)), windows)
    at = np.arange(first[-1]) + np.repeat(np.cumsum(many) - many - first[:-1], windows)
    width = np.minimum(many, n)
    size, short = np.repeat(width, windows), bool((width < n).any())
    h, w = size.astype(U), np.r_[w, np.zeros(n, U)]
    for i in range(n):
        longer = h * FACTOR + w[at + i]
        h = np.where(i < size, longer, h) if short else longer
    h = mix64(h)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        h[a:b].sort()
    keep = changes(h, text)
    return h[keep], np.bincount(text[keep], minlength=len(many))
