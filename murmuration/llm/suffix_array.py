"""Suffix arrays by prefix doubling (Manber and Myers), in numpy.

Places are ranked by the first few values from there. Two ranks, of a place and of the one as many
values behind it, rank it by twice as many, until all ranks differ or the wanted length is reached.
"""

from __future__ import annotations

import numpy as np

#: Bytes that the first ranks compare: numbers to the base 257 of so many digits fit into 63 bits.
_FIRST = 7


def _dense(keys: np.ndarray, most: int) -> np.ndarray:
    """Ranks 1, 2, .. of the keys 0 .. ``most``; equal keys share one."""
    n = len(keys)
    bits = n.bit_length()
    if most.bit_length() + bits <= 63:  # key and place in one number: sorted without an index
        both = np.sort((keys << bits) | np.arange(n))
        order, ordered = both & ((1 << bits) - 1), both >> bits
    else:
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
    ranks = np.empty(n, np.int64)
    ranks[order] = np.concatenate([[1], 1 + np.cumsum(ordered[1:] != ordered[:-1])])
    return ranks


def prefix_ranks(values: np.ndarray, length: int) -> np.ndarray:
    """For each place the rank of the ``length`` values from there; equal ones share a rank. An end is less than any value."""
    n = len(values)
    if not n:
        return np.empty(0, np.int64)
    if values.dtype == np.uint8:
        done, padded = min(_FIRST, length), np.concatenate([values.astype(np.int64) + 1, np.zeros(_FIRST, np.int64)])
        keys = padded[:n]
        for i in range(1, done):
            keys = keys * 257 + padded[i:i + n]
        ranks = _dense(keys, 257 ** done)
    else:
        done, ranks = 1, np.unique(values, return_inverse=True)[1] + 1
    while done < length:
        most = int(ranks.max())
        if most == n:
            break
        step = min(done, length - done)
        ahead = np.concatenate([ranks[step:], np.zeros(min(step, n), np.int64)])
        ranks, done = _dense(ranks * (most + 1) + ahead, (most + 1) ** 2), done + step
    return ranks


def suffix_array(values: list[int]) -> list[int]:
    """Starts of the suffixes of ``values`` in ascending order."""
    return np.argsort(prefix_ranks(np.array(values, np.int64), len(values))).tolist()
