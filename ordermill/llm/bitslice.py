"""Bit-sliced comparison of 64-bit fingerprints inside sorted groups (numpy)."""

from __future__ import annotations

import numpy as np

FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def bit_planes(values: np.ndarray) -> np.ndarray:
    """Plane p holds bit p of all values, 64 values to a word; a spare word of zeros ends every plane."""
    words = -(-len(values) // 64)
    padded = np.zeros(words * 64, dtype="<u8")
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    packed = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")
    return np.concatenate([packed, np.zeros((64, 1), dtype="<u8")], axis=1)


def _lanes(flags: np.ndarray) -> np.ndarray:
    padded = np.zeros(-(-len(flags) // 64) * 64, dtype=bool)
    padded[: len(flags)] = flags
    return np.packbits(padded, bitorder="little").view("<u8")


def pairs_within(groups: np.ndarray, values: np.ndarray, radius: int, most: int = 1 << 14):
    """Yields (i, j, distance) arrays of all pairs of one group that differ in at most `radius` (under 32) bits.

    Rows of a group must stand together. Lane i compares row i with row i + d, so one XOR of a plane with itself, moved by d
    lanes, takes a bit of 64 pairs at a time; all d that move the bits alike go together. Differing bits are counted in
    carry-save counters, one word per binary digit; blocks of 64 lanes in which every pair has passed the radius are dropped
    every eight planes. At most about `most` blocks are compared at a time, as each may give 64 pairs.
    """
    n = len(values)
    if n < 2:
        return
    starts = np.flatnonzero(np.append(True, groups[1:] != groups[:-1]))
    sizes = np.diff(np.append(starts, n))
    last = np.repeat(starts + sizes, sizes)
    planes = bit_planes(values)
    position = np.arange(n)
    largest = int(sizes.max())
    for shift in range(min(64, largest)):
        moved = planes
        if shift:
            after = np.concatenate([planes[:, 1:], np.zeros((64, 1), dtype="<u8")], axis=1)
            moved = (planes >> np.uint64(shift)) | (after << np.uint64(64 - shift))
        blocks, lanes, steps, held = [], [], [], 0
        for step in range((largest - 1 - shift) // 64 + 1):
            if step == shift == 0:
                continue
            valid = _lanes(position + (64 * step + shift) < last)
            found = np.flatnonzero(valid)
            blocks.append(found)
            lanes.append(valid[found])
            steps.append(np.full(len(found), step))
            held += len(found)
            if held > most:
                yield from _counted(planes, moved, shift, blocks, lanes, steps, radius)
                blocks, lanes, steps, held = [], [], [], 0
        if held:
            yield from _counted(planes, moved, shift, blocks, lanes, steps, radius)


def _counted(planes, moved, shift, blocks, lanes, steps, radius):
    """The pairs of these blocks, `steps` words and `shift` lanes apart, that stay within the radius."""
    digits = max(1, radius.bit_length())
    spare = (1 << digits) - 1 - radius  # counters start here, so passing the radius overflows them
    block, alive, step = np.concatenate(blocks), np.concatenate(lanes), np.concatenate(steps)
    target = np.minimum(block + step, planes.shape[1] - 1)
    counters = [np.full(len(block), FULL if spare >> k & 1 else 0, dtype="<u8") for k in range(digits)]
    for p in range(64):
        carry = planes[p][block] ^ moved[p][target]
        for k in range(digits):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        alive = alive & ~carry
        if p % 8 == 7:
            keep = alive != 0
            if not keep.all():
                block, target, step, alive = block[keep], target[keep], step[keep], alive[keep]
                counters = [c[keep] for c in counters]
                if not len(block):
                    return
    row, lane = np.nonzero(np.unpackbits(alive.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
    distance = np.full(len(row), -spare, dtype=np.int64)
    for k in range(digits):
        distance += ((counters[k][row] >> lane.astype("<u8")) & np.uint64(1)).astype(np.int64) << k
    i = block[row] * 64 + lane
    yield i, i + 64 * step[row] + shift, distance


def nearest_forest(n: int, i: np.ndarray, j: np.ndarray, distance: np.ndarray) -> np.ndarray:
    """Places of links that connect all that the links connect, nearest pairs first (Boruvka rounds)."""
    label = np.arange(n)
    order = np.lexsort((j, i, distance))
    rank = np.empty(len(i), dtype=np.int64)
    rank[order] = np.arange(len(i))
    chosen: list[np.ndarray] = []
    while True:
        a, b = label[i], label[j]
        open_links = np.flatnonzero(a != b)
        if not len(open_links):
            return np.unique(np.concatenate(chosen)) if chosen else np.array([], dtype=np.int64)
        best = np.full(n, len(i), dtype=np.int64)
        np.minimum.at(best, a[open_links], rank[open_links])
        np.minimum.at(best, b[open_links], rank[open_links])
        taken = order[np.unique(best[best < len(i)])]
        chosen.append(taken)
        a, b = label[i[taken]], label[j[taken]]
        parent = np.arange(n)
        while True:  # the smallest label of each tree of taken links
            before = parent.copy()
            np.minimum.at(parent, a, parent[b])
            np.minimum.at(parent, b, parent[a])
            parent = parent[parent]
            if (parent == before).all():
                break
        label = parent[label]


def forest_within(groups: np.ndarray, values: np.ndarray, radius: int, most: int = 2_000_000):
    """(i, j, distance) of links that connect, group by group, all that `pairs_within` connects; memory is bounded by `most`."""
    parts: list[tuple[np.ndarray, ...]] = []
    held = 0

    def reduced() -> list[tuple[np.ndarray, ...]]:
        i, j, distance = (np.concatenate(column) for column in zip(*parts, strict=True))
        kept = nearest_forest(len(values), i, j, distance)
        return [(i[kept], j[kept], distance[kept])]

    for found in pairs_within(groups, values, radius):
        parts.append(found)
        held += len(found[0])
        if held > most:
            parts = reduced()
            held = len(parts[0][0])
    if not parts:
        return tuple(np.array([], dtype=np.int64) for _ in range(3))
    return reduced()[0]
