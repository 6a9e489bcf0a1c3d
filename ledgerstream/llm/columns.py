"""Column-wise construction of a collection's transform and common prefixes, for strings aligned at an anchor.

Each round takes one column, from the right: every string that has a byte there puts it before its suffix. The list of
suffixes is kept in order by a stable sort on the new byte alone, as the suffixes that follow were in order already, and a
suffix's common prefix with the one before it is one more than the least common prefix between the two in the old list.
Strings enter the list in the column of their last byte and leave it after that of their first. Equal windows of a
collection start in one column, as they hold the anchor at one place, so a round only needs the suffixes that start in its
column: a round costs what strings there are, not what bytes there are.
"""

from __future__ import annotations

import numpy as np


def _least(common: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Least of ``common[lo:hi]`` for each pair, lo < hi <= len(common)."""
    # By falling lo, reduceat spends nothing between one pair and the next.
    order = np.argsort(-lo, kind="stable")
    at = np.stack((lo[order], hi[order]), axis=1).ravel()
    out = np.empty(len(lo), common.dtype)
    out[order] = np.minimum.reduceat(np.append(common, common.dtype.type(0)), at)[::2]
    return out


def columns(data: np.ndarray, start: np.ndarray, lead: np.ndarray, size: np.ndarray, group: np.ndarray, limit: int):
    """For each column, from the right: ``column, order, common`` of the suffixes that start there.

    String i is ``data[start[i]:start[i] + size[i]]``, its anchor at ``lead[i]`` is column 0. ``order`` lists strings by
    group (a small number), then by suffix, a prefix first and equal suffixes as they came; ``common`` is the common prefix
    with the one before in the list, up to ``limit``, and 0 for a group's first.
    """
    base, end = (start + lead).astype(np.int64), (size - lead).astype(np.int64)
    by_end = np.argsort(-end, kind="stable")
    falling = -end[by_end]
    order, common, entered = np.empty(0, np.int64), np.empty(0, np.uint8), 0
    for c in range(int(end.max(initial=0)) - 1, -int(lead.max(initial=0)) - 1, -1):
        n = int(np.searchsorted(falling, -c, "left"))
        fresh = n - entered
        if fresh:  # their suffix is empty so far, so they come before all others
            order = np.concatenate((by_end[entered:n], order))
            common = np.concatenate((np.zeros(fresh, np.uint8), common))
            entered = n
        here = np.flatnonzero(lead[order] >= -c)
        symbol = data[base[order[here]] + c]
        sort = np.argsort(symbol, kind="stable")
        sort = sort[np.argsort(group[order[here[sort]]], kind="stable")]
        at, symbol = here[sort], symbol[sort]
        order = order[at]
        same = np.flatnonzero((symbol[1:] == symbol[:-1]) & (group[order[1:]] == group[order[:-1]]))
        p, q = at[same], at[same + 1]
        least = np.where(p < fresh, np.uint8(0), common[q])
        far = np.flatnonzero((p >= fresh) & (q > p + 1))
        if len(far):
            least[far] = _least(common, p[far] + 1, q[far] + 1)
        common = np.zeros(len(order), np.uint8)
        common[same + 1] = np.minimum(least, limit - 1) + np.uint8(1)
        yield c, order, common


def repeated_windows(data: np.ndarray, start: np.ndarray, lead: np.ndarray, size: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Whether a string's window that starts ``lead.max() - j`` bytes before its anchor is also that of an earlier string of
    its group: a matrix of strings by j. Windows hold the anchor's first byte; ``length`` is below 256."""
    far = int(lead.max(initial=0))
    again = np.zeros((len(size), far + 1), bool)
    for c, order, common in columns(data, start, lead, size, group, length):
        like = common >= length
        if c > 0 or not like.any():
            continue
        head = np.flatnonzero(~like)
        first = np.minimum.reduceat(order, head)[np.cumsum(~like) - 1]
        again[order[order != first], c + far] = True
    return again
