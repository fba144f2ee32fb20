"""Sorting of suffixes to a fixed depth: multikey first, blind tries for what still agrees.

The shallow part orders all suffixes by a few eight-byte symbols, one symbol at a time,
going on with those only that agree so far. Groups that agree to the shallow depth have
long common prefixes. For each of them a blind trie is built: its nodes know the depth at
which their children differ and the byte that does, not the text between. Members are
placed along the path of the group's first member: one comparison tells the depth at which
each leaves it, and members that leave at the same node by the same byte are a group of
their own, one level further down. All groups take a level at a time.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 16  # bytes; a multiple of eight
PAD = 16  # bytes to append to the data, so that symbols can be read at its end


def symbols(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number, first byte first; no copy."""
    return np.ndarray((len(data) - 7,), ">u8", data, strides=(1,))


def parted(*keys: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before it; the first row does."""
    fresh = np.ones(len(keys[0]), bool)
    fresh[1:] = False
    for key in keys:
        fresh[1:] |= key[1:] != key[:-1]
    return fresh


def grouped(fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First row and size of the group of each row."""
    first = np.flatnonzero(fresh)
    sizes = np.diff(np.r_[first, len(fresh)])
    return np.repeat(first, sizes), np.repeat(sizes, sizes)


def common(data: np.ndarray, a: np.ndarray, b: np.ndarray, known: np.ndarray, depth: int) -> np.ndarray:
    """Bytes that the suffixes at ``a`` and ``b`` have in common, ``depth`` at most; ``known`` of them are given."""
    words = symbols(data)
    found = known.copy()
    live = np.flatnonzero(found < depth)
    while len(live):
        differ = words[a[live] + found[live]].astype(np.uint64) ^ words[b[live] + found[live]].astype(np.uint64)
        same = differ == 0
        stop = live[~same]
        if len(stop):
            # Leading zero bytes: the highest bit's place by the exponent of the upper or lower half.
            d = differ[~same]
            high = (d >> np.uint64(32)).astype(np.float64)
            low = (d & np.uint64(0xFFFFFFFF)).astype(np.float64)
            top = np.where(high > 0, 32 + np.frexp(high)[1], np.frexp(low)[1])
            found[stop] += (64 - top) // 8
        found[live[same]] += 8
        live = live[same]
        live = live[found[live] < depth]
    return np.minimum(found, depth)


def sort_suffixes(
    data: np.ndarray, starts: np.ndarray, depth: int, shallow: int = SHALLOW
) -> tuple[np.ndarray, np.ndarray]:
    """The order of the suffixes by their first ``depth`` bytes, and which agree with the one before to that depth.

    ``data`` holds ``depth`` bytes from each start on and PAD more at its end. Suffixes
    that agree are in no order among themselves.
    """
    order = np.arange(len(starts))
    equal = np.zeros(len(starts), bool)
    words = symbols(data)
    # Rows of ``order`` that share all bytes seen so far with a neighbour, and their groups' first rows.
    rows, group = np.arange(len(starts)), np.zeros(len(starts), np.int64)
    for k in range(0, min(shallow, depth) // 8):
        key = words[starts[order[rows]] + 8 * k].astype(np.uint64)
        turn = np.lexsort((key, group))
        key, group = key[turn], group[turn]
        order[rows] = order[rows[turn]]
        first, sizes = grouped(parted(group, key))
        group = rows[first]
        rows, group = rows[sizes > 1], group[sizes > 1]
    known = np.full(len(rows), min(shallow, depth) // 8 * 8, np.int64)
    while len(rows):
        at = starts[order[rows]]
        fresh = parted(group)
        lead = at[grouped(fresh)[0]]
        leave = common(data, at, lead, np.where(fresh, depth, known), depth)
        inner = np.minimum(leave, depth - 1)
        byte, lead_byte = data[at + inner], data[lead + inner]
        # Before the path, deeper nodes last; the path itself; after it, deeper nodes first.
        side = np.where(leave == depth, 0, np.where(byte < lead_byte, -1, 1)).astype(np.int64)
        node = np.where(leave == depth, 0, -side * leave)
        turn = np.lexsort((byte, node, side, group))
        order[rows] = order[rows[turn]]
        side, node, byte, leave, group = side[turn], node[turn], byte[turn], leave[turn], group[turn]
        done = side == 0
        byte = np.where(done, 0, byte)
        first, sizes = grouped(parted(group, side, node, byte))
        equal[rows[done & (first != np.arange(len(rows)))]] = True
        on = ~done & (sizes > 1)
        group, known, rows = rows[first][on], leave[on] + 1, rows[on]
    return order, equal
