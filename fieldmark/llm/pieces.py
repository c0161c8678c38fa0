"""Token ids of words, remembered per worker: a word is encoded when it is first seen."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

_U = np.uint64
#: Words remembered at most; beyond, the memory starts anew.
REMEMBERED = 1_500_000


class Remembered:
    """Ids by 64-bit hash of what they encode, in sorted arrays."""

    def __init__(self) -> None:
        self.keys, self.at, self.pool = np.zeros(0, _U), np.zeros(0, np.int32), [np.zeros(0, np.int32)]
        self.count, self.used = np.zeros(0, np.int32), 0

    def ids(self, hashes: np.ndarray, encode: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and how many each hash has.  ``encode`` gets places of new hashes and gives their ids in a row, and how many each has."""
        distinct, place, back = np.unique(hashes, return_index=True, return_inverse=True)
        known = np.searchsorted(self.keys, distinct)
        fresh = np.ones(len(distinct), bool)
        inside = known < len(self.keys)
        fresh[inside] = self.keys[known[inside]] != distinct[inside]
        if fresh.any():
            if len(self.keys) > REMEMBERED:
                self.__init__()
                fresh[:] = True
            made, count = encode(place[fresh])
            at = self.used + np.cumsum(count) - count
            self.pool = [np.concatenate([*self.pool, made.astype(np.int32)])]
            self.used += int(count.sum())
            new = distinct[fresh]
            where = np.searchsorted(self.keys, new)
            self.keys = np.insert(self.keys, where, new)
            self.at, self.count = np.insert(self.at, where, at), np.insert(self.count, where, count)
            known = np.searchsorted(self.keys, distinct)
        slot = known[back]
        count = self.count[slot].astype(np.int64)
        return gather(self.pool[0], self.at[slot], count), count


def gather(pool: np.ndarray, at: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Stretches of ``pool``, one after the other."""
    ends = np.cumsum(count)
    total = int(ends[-1]) if len(ends) else 0
    return pool[np.repeat(at - (ends - count), count) + np.arange(total)]
