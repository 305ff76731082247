"""A run-length index of a text: where long strings occur more than once.

The Burrows-Wheeler transform of a repetitive text has few runs. Only at the
first and the last suffix of a run can the match with the neighbouring suffix
be longer than the one of the text position before, less one; everywhere else
it follows from that. So the index keeps the runs, the text positions of their
ends and the match lengths there, and the matching statistics of the text
against itself are streamed from those samples.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Bytes that are compared at a time when a match length is measured.
_STEP = 64
#: Pairs that are compared at a time.
_PAIRS = 1 << 15
#: Symbols that fit into one integer for the first sorting.
_PACKED = 7


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes in order, by sorting prefixes of doubling length.

    ``text`` has symbols 0 to 511. Only suffixes that still share their prefix
    with others are sorted again.
    """
    n = len(text)
    padded = np.zeros(n + _PACKED, np.int64)
    padded[:n] = text + 1
    packed = np.zeros(n, np.int64)
    for k in range(_PACKED):
        packed = packed * 512 + padded[k : k + n]
    order = np.argsort(packed, kind="stable")
    ranks = _ranks(packed[order][None, :], np.arange(n))
    rank = np.zeros(n + 1, np.int64)
    rank[order] = ranks + 1
    slots = _shared(ranks)
    length = _PACKED
    while len(slots):
        at = order[slots]
        old = rank[at]
        then = rank[np.minimum(at + length, n)]
        again = np.argsort(old * (n + 1) + then, kind="stable")
        at, keys = at[again], np.stack([old[again], then[again]])
        order[slots] = at
        ranks = _ranks(keys, slots)
        rank[at] = ranks + 1
        slots = slots[_shared(ranks)]
        length *= 2
    return order


def _ranks(keys: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """For sorted keys, the slot where each key's group begins."""
    new = np.ones(keys.shape[1], bool)
    new[1:] = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
    return slots[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]


def _shared(ranks: np.ndarray) -> np.ndarray:
    """Places whose group has more than one member."""
    same = np.zeros(len(ranks) + 1, bool)
    same[1:-1] = ranks[1:] == ranks[:-1]
    return np.flatnonzero(same[1:] | same[:-1])


def match_lengths(text: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of symbols that are equal from each pair of positions on."""
    padded = np.concatenate([text, np.full(_STEP, -1)]).astype(np.int16)
    windows = np.lib.stride_tricks.sliding_window_view(padded, _STEP)
    parts = [
        _matched(windows, len(text), a[k : k + _PAIRS], b[k : k + _PAIRS])
        for k in range(0, len(a), _PAIRS)
    ]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _matched(windows: np.ndarray, n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    found = np.zeros(len(a), np.int64)
    going = np.arange(len(a))
    while len(going):
        x, y = a[going] + found[going], b[going] + found[going]
        inside = (x < n) & (y < n)
        going, x, y = going[inside], x[inside], y[inside]
        differ = windows[x] != windows[y]
        # The end of the text equals nothing, not even itself.
        differ |= windows[x] < 0
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), _STEP)
        found[going] += first
        going = going[first == _STEP]
    return found


@dataclass(frozen=True)
class RunIndex:
    """Runs of the transform, and the samples at their first and last suffixes."""

    n: int
    symbols: np.ndarray
    lengths: np.ndarray
    heads: np.ndarray
    head_matches: np.ndarray
    tails: np.ndarray
    tail_matches: np.ndarray

    def matching_lengths(self) -> np.ndarray:
        """For every position, the longest match that starts anywhere else."""
        reach = np.maximum(
            self._streamed(self.heads, self.head_matches),
            self._streamed(self.tails, self.tail_matches),
        )
        return np.maximum(reach - np.arange(self.n), 0)

    def _streamed(self, samples: np.ndarray, matches: np.ndarray) -> np.ndarray:
        """Ends of the matches, carried from each sample on to the next."""
        ends = np.zeros(self.n, np.int64)
        ends[samples] = samples + matches
        return np.maximum.accumulate(ends)


def build(text: np.ndarray) -> RunIndex:
    """The index of a text of symbols from 0 to 510."""
    n = len(text)
    order = suffix_array(text)
    before = np.where(order > 0, text[order - 1], -1)
    change = np.flatnonzero(before[1:] != before[:-1])
    starts = np.concatenate([[0], change + 1])
    ends = np.concatenate([change, [n - 1]])
    heads, tails = order[starts], order[ends]
    head_matches = np.zeros(len(starts), np.int64)
    head_matches[1:] = match_lengths(text, order[starts[1:] - 1], heads[1:])
    tail_matches = np.zeros(len(ends), np.int64)
    tail_matches[:-1] = match_lengths(text, tails[:-1], order[ends[:-1] + 1])
    return RunIndex(
        n, before[starts], ends - starts + 1, heads, head_matches, tails, tail_matches
    )
