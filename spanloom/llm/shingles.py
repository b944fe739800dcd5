"""Word shingles of many texts at once, as hashes."""

from __future__ import annotations

import numpy as np

from spanloom.llm.shared import U64, ByteHashes, mix

WORDS = 5
_GOLDEN = U64(0x9E3779B97F4A7C15)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (digits, letters a-z with A-Z lower-cased, characters beyond ASCII) and the words of each text."""
    encoded = [(t or "").encode() + b"\n" for t in texts]
    data = _FOLD[np.frombuffer(b"".join(encoded), dtype=np.uint8)]
    inside = np.concatenate([[False], _IN_WORD[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    text_ends = np.cumsum([len(e) for e in encoded])
    counts = np.diff(np.searchsorted(starts, text_ends), prepend=0)
    return ByteHashes(data).of(starts, ends), counts


def shingles(texts: list[str | None], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles, and the number of each text's text, ascending.

    A text of fewer words than a shingle has, but not none, is one shingle.
    """
    code, counts = word_hashes(texts)
    text = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(code)) - np.repeat(np.cumsum(counts) - counts, counts)
    left = np.repeat(counts, counts) - place
    first = (left >= words) | (place == 0)
    total = np.zeros(len(code), dtype=U64)
    with np.errstate(over="ignore"):
        for j in range(words):
            k = max(0, len(code) - j)
            inside = left[:k] > j
            total[:k] += np.where(inside, mix(code[j:] + _GOLDEN * U64(j + 1)), U64(0))
    return mix(total[first]), text[first]


def weighted(texts: list[str | None], words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles: (text, hash, times it occurs there), by text."""
    code, text = shingles(texts, words)
    order = np.lexsort((code, text))
    code, text = code[order], text[order]
    new = np.ones(len(code), dtype=bool)
    new[1:] = (code[1:] != code[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    return text[at], code[at], np.diff(np.append(at, len(code)))


def numbered(code: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(source row, hash) of every occurrence: the first, second, ... of a shingle become elements of their own."""
    row = np.repeat(np.arange(len(code)), times)
    number = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
    with np.errstate(over="ignore"):
        return row, mix(code[row] + number.astype(U64) * _GOLDEN)
