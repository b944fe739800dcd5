"""Blockwise suffix sorting with a difference cover.

Positions whose remainder modulo ``PERIOD`` lies in the cover are the sample; their suffixes are ranked first. For any two positions
there is a shift below ``PERIOD`` that takes both into the sample, so two suffixes compare by at most ``PERIOD`` bytes and,
on a tie, by the ranks at that shift. A bucket is sorted with no more than these keys, whatever its suffixes share.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

PERIOD = 32
WORD = 8


def difference_cover(period: int) -> np.ndarray:
    """Remainders such that every difference modulo ``period`` is one between two of them: a run of r and the multiples of r, r about the root."""
    r = int(np.ceil(np.sqrt(period)))
    return np.unique(np.concatenate([np.arange(r), np.arange(r, period + r, r) % period]))


def shifts(period: int) -> np.ndarray:
    """For every two remainders, the least shift that takes both into the cover."""
    inside = np.zeros(period, dtype=bool)
    inside[difference_cover(period)] = True
    rows = np.array([[np.roll(inside, -a) & np.roll(inside, -b) for b in range(period)] for a in range(period)])
    assert rows.any(axis=2).all()
    return rows.argmax(axis=2)


_INSIDE = np.zeros(PERIOD, dtype=bool)
_INSIDE[difference_cover(PERIOD)] = True
_SHIFTS = shifts(PERIOD)


def split(group: np.ndarray, word_of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Groups told apart by a next word, which is asked for those of several members only.

    Split groups take the places their members hold: a group's number is the count of smaller ones.
    """
    count = np.bincount(group)
    tied = np.flatnonzero(count[group] > 1)
    if not len(tied):
        return group
    word, own = word_of(tied), group[tied]
    order = np.lexsort((word, own))
    word, own = word[order], own[order]
    begins = np.concatenate([[True], own[1:] != own[:-1]])
    new = np.concatenate([[True], word[1:] != word[:-1]]) | begins
    place = np.arange(len(own))
    before = np.cumsum(count) - count
    found = before[group]
    found[tied[order]] = before[own] + np.maximum.accumulate(np.where(new, place, 0)) - np.maximum.accumulate(np.where(begins, place, 0))
    return found


class Block:
    """Suffixes of one block of text, compared to ``depth`` bytes; bytes beyond the end count as zero."""

    def __init__(self, text: np.ndarray, depth: int) -> None:
        self.depth = depth
        reach = PERIOD + depth + 2 * WORD
        padded = np.concatenate([text, np.zeros(reach + WORD, dtype=np.uint8)]).astype(np.uint64)
        n = len(text) + reach
        self._words = np.zeros(n, dtype=np.uint64)
        for k in range(WORD):
            self._words |= padded[k : k + n] << np.uint64(56 - 8 * k)
        sample = np.flatnonzero(_INSIDE[np.arange(len(text) + PERIOD) % PERIOD])
        self._rank = np.zeros(len(text) + PERIOD, dtype=np.int64)
        self._rank[sample] = self._sample_ranks(sample)

    def _sample_ranks(self, sample: np.ndarray) -> np.ndarray:
        """Ranks of the sample by ``depth`` bytes; equal suffixes share one. Longer keys only break the ties of shorter ones."""
        first = self._words[sample]
        order = np.argsort(first, kind="stable")
        group = np.zeros(len(sample), dtype=np.int64)
        group[order] = np.cumsum(np.concatenate([[0], first[order][1:] != first[order][:-1]]))
        for k in range(WORD, self.depth, WORD):
            cut = np.uint64(8 * max(0, WORD - (self.depth - k)))
            group = split(group, lambda tied: self._words[sample[tied] + k] >> cut)
        return group

    def equal_runs(self, at: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(order of the suffixes, where a new suffix begins in it): sorted within each bucket, equal to ``depth`` bytes in one run.

        Suffixes of one bucket number must have one remainder modulo the period.
        """
        order = np.argsort(bucket, kind="stable")
        group = np.zeros(len(at), dtype=np.int64)
        group[order] = np.cumsum(np.concatenate([[0], bucket[order][1:] != bucket[order][:-1]]))[: len(at)]
        for k in range(0, PERIOD, WORD):
            group = split(group, lambda tied: self._words[at[tied] + k])
        # Only suffixes that still tie need ranks; all others have their places by now.
        alone = np.bincount(group)[group] == 1
        tied = np.flatnonzero(~alone)
        rest = at[tied] % PERIOD
        ranks = self._rank[at[tied] + _SHIFTS[rest, rest]]
        tied = tied[np.lexsort((ranks, group[tied]))]
        here, there = tied[1:], tied[:-1]
        same = group[here] == group[there]
        for k in range(PERIOD, self.depth, WORD):
            cut = np.uint64(8 * max(0, WORD - (self.depth - k)))
            same &= self._words[at[here] + k] >> cut == self._words[at[there] + k] >> cut
        taken = np.ones(len(at), dtype=bool)
        order = np.empty(len(at), dtype=np.int64)
        order[group[alone]] = np.flatnonzero(alone)
        taken[group[alone]] = False
        places = np.flatnonzero(taken)
        order[places] = tied
        new = np.ones(len(at), dtype=bool)
        new[places[1:]] = ~same
        return order, new
