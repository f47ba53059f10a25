"""Merging pairs in many sequences at once, on ragged numpy arrays."""

from __future__ import annotations

import numpy as np

NONE = np.iinfo(np.int64).max


class PairTable:
    """Which pairs of symbols merge into which symbol, and in which order.

    ``pairs`` has (left, right): (rank, new symbol); symbols are below ``n``,
    negative ones merge with nothing.
    """

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]], n: int):
        self.n = n
        order = sorted(pairs)
        self.keys = np.array([*(a * n + b for a, b in order), NONE], np.int64)
        self.rank = np.array([*(pairs[p][0] for p in order), NONE], np.int64)
        self.new = np.array([*(pairs[p][1] for p in order), -1], np.int64)
        self.none = len(order)
        # calm: no pair with the new symbol comes before the pair that makes it, so
        # merging the same pair elsewhere in the sequence at once changes nothing.
        best = np.full(n, NONE)
        np.minimum.at(best, self.keys[:-1] // n, self.rank[:-1])
        np.minimum.at(best, self.keys[:-1] % n, self.rank[:-1])
        self.calm = np.append(best[self.new[:-1]] > self.rank[:-1], False)

    def look_up(self, symbol: np.ndarray, seq: np.ndarray) -> np.ndarray:
        """For each symbol the number of the pair it begins within its sequence, or ``none``."""
        out = np.full(len(symbol), self.none)
        left, right = symbol[:-1], symbol[1:]
        inside = np.flatnonzero((seq[1:] == seq[:-1]) & (left >= 0) & (right >= 0))
        key = left[inside] * self.n + right[inside]
        at = np.searchsorted(self.keys, key)
        out[inside] = np.where(self.keys[at] == key, at, self.none)
        return out

    def merge(self, symbol: np.ndarray, seq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols left when nothing merges any more, and the places where they began.

        In each round every sequence merges its pair of lowest rank, the
        leftmost of equals; a calm pair merges wherever it stands. Sequences
        without a known pair leave the arrays, so a round costs as much as the
        sequences still merging.
        """
        place = np.arange(len(symbol))
        ended: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbol):
            pair = self.look_up(symbol, seq)
            rank = self.rank[pair]
            first = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            sizes = np.diff(np.r_[first, len(seq)])
            lowest = np.minimum.reduceat(rank, first)
            done = lowest == NONE
            if done.any():
                gone = np.repeat(done, sizes)
                ended.append((symbol[gone], place[gone]))
                symbol, seq, place, pair, rank = (x[~gone] for x in (symbol, seq, place, pair, rank))
                lowest, sizes = lowest[~done], sizes[~done]
                if not len(symbol):
                    break
            hit = np.flatnonzero(rank == np.repeat(lowest, sizes))
            begins = np.r_[True, seq[hit[1:]] != seq[hit[:-1]]]
            # One rank may belong to several pairs of one symbol; only the first one's pair merges.
            head = np.maximum.accumulate(np.where(begins, np.arange(len(hit)), 0))
            hit = hit[begins | ((pair[hit] == pair[hit[head]]) & self.calm[pair[hit]])]
            hit = hit[apart(hit)]
            symbol[hit] = self.new[pair[hit]]
            keep = np.ones(len(symbol), bool)
            keep[hit + 1] = False
            symbol, seq, place = symbol[keep], seq[keep], place[keep]
        if not ended:
            return symbol, place
        symbol, place = (np.concatenate(x) for x in zip(*ended))
        order = np.argsort(place, kind="stable")
        return symbol[order], place[order]


def apart(hit: np.ndarray) -> np.ndarray:
    """Of neighbouring places, as in a run of one letter, every other one from the left."""
    new_run = np.r_[True, hit[1:] != hit[:-1] + 1]
    start = np.maximum.accumulate(np.where(new_run, np.arange(len(hit)), 0))
    return (np.arange(len(hit)) - start) % 2 == 0
