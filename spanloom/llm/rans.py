"""Static range asymmetric numeral system over whole numbers, many interleaved lanes at a time.

Frequencies are whole numbers that sum to 2**16. Each lane's state is kept in [2**16, 2**32); a symbol moves at most one
16-bit word in or out, so that a step over all lanes is a few array operations. Lane k codes symbols k, k + lanes, ...
"""

from __future__ import annotations

import numpy as np

BITS = 16
TOTAL = 1 << BITS
LOW = np.uint64(1 << 16)
MOST_SYMBOLS = TOTAL
DENSE = 1 << 20  # symbols below this are looked up in a table of their own size


class Table:
    """Frequencies of the symbols in use (``symbols`` ascending)."""

    def __init__(self, symbols: np.ndarray, frequencies: np.ndarray) -> None:
        self.symbols, self.frequencies = symbols.astype(np.uint32), frequencies.astype(np.uint32)
        self._starts = np.concatenate([[0], np.cumsum(self.frequencies, dtype=np.uint64)[:-1]]).astype(np.uint64)
        self._place = np.repeat(np.arange(len(symbols)), self.frequencies)
        self._wide = self.frequencies.astype(np.uint64)

    @classmethod
    def of(cls, values: np.ndarray) -> Table:
        """Frequencies in proportion to the counts, at least 1 each; what is left over goes to the commonest symbols."""
        if len(values) and int(values.max()) < DENSE:
            counts = np.bincount(values)
            symbols = np.flatnonzero(counts)
            counts = counts[symbols]
        else:
            symbols, counts = np.unique(values, return_counts=True)
        if len(symbols) > MOST_SYMBOLS:
            raise ValueError(f"{len(symbols)} symbols; at most {MOST_SYMBOLS} fit one table")
        shares = np.maximum(1, counts * TOTAL // max(1, counts.sum()))
        order = np.argsort(-shares, kind="stable")
        excess = int(shares.sum()) - TOTAL
        if excess < 0:
            shares[order[0]] -= excess
        for i in order:
            if excess <= 0:
                break
            taken = min(excess, max(int(shares[i]) // 2, 0) if shares[i] > 1 else 0)
            shares[i] -= taken
            excess -= taken
        while excess > 0:  # many symbols near the smallest share
            many = np.flatnonzero(shares > 1)[:excess]
            shares[many] -= 1
            excess -= len(many)
        return cls(symbols, shares)


def encode(values: np.ndarray, table: Table, lanes: int) -> tuple[np.ndarray, np.ndarray]:
    """(final states of the lanes, words in the order a decoder reads them)."""
    if len(table.symbols) and int(table.symbols[-1]) < DENSE:
        dense = np.zeros(int(table.symbols[-1]) + 1, dtype=np.int64)
        dense[table.symbols] = np.arange(len(table.symbols))
        place = dense[values]
    else:
        place = np.searchsorted(table.symbols, values)
    frequency, start = table._wide[place], table._starts[place]
    states = np.full(lanes, LOW, dtype=np.uint64)
    words = []
    for at in range((len(values) - 1) // lanes * lanes, -1, -lanes):
        f, s = frequency[at : at + lanes], start[at : at + lanes]
        x = states[: len(f)]
        full = x >= f << np.uint64(16)
        words.append((x[full] & np.uint64(0xFFFF)).astype("<u2"))
        x = np.where(full, x >> np.uint64(16), x)
        quotient = x // f
        states[: len(f)] = (quotient << np.uint64(BITS)) + (x - quotient * f) + s
    return states.astype("<u4"), np.concatenate(words[::-1]) if words else np.zeros(0, "<u2")


def decode(count: int, states: np.ndarray, words: np.ndarray, table: Table) -> np.ndarray:
    """The ``count`` values that ``encode`` was given."""
    lanes = len(states)
    states = states.astype(np.uint64)
    out = np.empty(count, dtype=np.uint32)
    wide = words.astype(np.uint64)
    read = 0
    for at in range(0, count, lanes):
        x = states[: min(lanes, count - at)]
        slot = x & np.uint64(TOTAL - 1)
        place = table._place[slot]
        out[at : at + len(x)] = table.symbols[place]
        x = table._wide[place] * (x >> np.uint64(BITS)) + slot - table._starts[place]
        low = np.flatnonzero(x < LOW)
        x[low] = (x[low] << np.uint64(16)) | wide[read : read + len(low)]
        read += len(low)
        states[: len(x)] = x
    if read != len(words) or (states != LOW).any():
        raise ValueError("damaged block: the lanes do not end where they began")
    return out
