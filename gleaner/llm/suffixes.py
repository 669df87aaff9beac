"""Deep-shallow sorting of fixed-length suffixes, vectorised.

All suffixes advance together: a multikey quicksort on 8-byte words splits every group of ties by a
pivot of its own into less, equal and greater, and only the equal part goes deeper; groups still tied
at the shallow depth have long common prefixes and are ordered by blind tries. A trie is built along
the path of one of its suffixes: where another one leaves that path (the depth of its branch and the
byte there) says where it belongs; suffixes that leave it together form the subtrie below, and so on.
"""

from __future__ import annotations

import numpy as np


def words_at(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position of ``data`` as one number, zeros beyond the end."""
    wide = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    out = np.zeros(len(data), np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | wide[k : k + len(data)]
    return out


def _groups(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of its run, size of its run) for each place of a sorted key."""
    begins = np.concatenate([[True], key[1:] != key[:-1]])
    run = np.cumsum(begins) - 1
    return run, np.bincount(run)[run]


def deep_shallow(data: np.ndarray, pos: np.ndarray, primary: np.ndarray, length: int, shallow: int = 32) -> tuple[np.ndarray, np.ndarray]:
    """Order the suffixes data[p : p + length] for p in ``pos`` by (primary, bytes).

    Returns the order and, for each of its places, whether primary and suffix equal the ones before.
    """
    order = np.argsort(primary, kind="stable")
    equal = np.zeros(len(pos), bool)
    if not len(pos):
        return order, equal
    words = words_at(data)
    run, size = _groups(primary[order])
    slots = np.flatnonzero(size > 1)
    run, depth = run[slots], np.zeros(len(slots), np.int64)
    deep_slots, deep_run = [], []
    while len(slots):
        item = order[slots]
        word = words[pos[item] + depth]
        run, size = _groups(run)
        first = np.concatenate([[0], np.flatnonzero(np.diff(run)) + 1])
        pivot = word[first + np.bincount(run) // 2][run]
        side = (word >= pivot).astype(np.int64) + (word > pivot)
        key = run * 3 + side
        by = np.argsort(key, kind="stable")
        order[slots] = item[by]
        key = key[by]
        depth = depth[by] + 8 * (key % 3 == 1)
        run, size = _groups(key)
        deep = (size > 1) & (depth >= shallow)
        deep_slots.append(slots[deep])
        deep_run.append(slots[deep] - (np.arange(len(run)) - np.searchsorted(run, run))[deep])  # first slot names the group
        more = (size > 1) & ~deep
        slots, run, depth = slots[more], run[more], depth[more]
    if deep_slots:
        slots, run = np.concatenate(deep_slots), np.concatenate(deep_run)
        by = np.argsort(slots)
        _blind_tries(data, pos, order, equal, slots[by], run[by], length, shallow)
    return order, equal


def _blind_tries(data, pos, order, equal, slots, run, length: int, shallow: int) -> None:
    """Order the suffixes in ``slots``, tied within runs up to the shallow depth; updates order and equal."""
    span = np.arange(shallow, length)
    while len(slots):
        run, _ = _groups(run)
        item = order[slots]
        first = np.concatenate([[0], np.flatnonzero(np.diff(run)) + 1])
        path = pos[item[first]][run]  # each run's trie is built along its first suffix
        branch, byte, turn = (np.zeros(len(slots), np.int64) for _ in range(3))
        for k in range(0, len(slots), 16384):
            a, b = data[pos[item[k : k + 16384], None] + span], data[path[k : k + 16384, None] + span]
            differs = a != b
            at = np.where(differs.any(axis=1), differs.argmax(axis=1), len(span))
            here = np.arange(len(at)), np.minimum(at, len(span) - 1)
            branch[k : k + 16384], byte[k : k + 16384] = at, a[here]
            turn[k : k + 16384] = np.where(at == len(span), 1, np.where(a[here] < b[here], 0, 2))
        # Smaller ones that leave the path early come first, larger ones that leave it early come last.
        place = np.where(turn == 0, branch, np.where(turn == 2, length - branch, 0))
        key = ((run * 3 + turn) * (length + 1) + place) * 256 + np.where(turn == 1, 0, byte)
        by = np.argsort(key, kind="stable")
        order[slots] = item[by]
        key, turn = key[by], turn[by]
        run, size = _groups(key)
        again = np.concatenate([[False], run[1:] == run[:-1]])
        equal[slots[(turn == 1) & again]] = True
        more = (turn != 1) & (size > 1)
        slots, run = slots[more], run[more]
