"""Edit distance of two long ordered trees at unit costs, in rows: no table over both trees is held.

Zhang and Shasha compare each subtree of one tree with each of the other. Here the nodes of the first tree come once, in
postorder; every open subtree of it has one row of its comparisons with all subtrees of the other, and a row of
distances of whole subtrees is used where it arises. Memory goes with the nodes of the second tree and the depths.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

FAR = 1 << 28
#: More than the values of two neighbouring segments may differ by; keeps running minima apart.
APART = 1 << 30
#: Rows that share one window of columns.
ROWS = 256
#: Diagonals beside the ends' that the first, approximate pass looks at.
REACH = 256


def keyroots(left: list[int]) -> dict[int, int]:
    """The last node of each leftmost path, by the path's leaf."""
    return {low: i for i, low in enumerate(left)}


def cells(left: list[int]) -> tuple[int, int]:
    """Nodes of all subtrees that are compared as a whole, and how many of these are nested at most."""
    total = deepest = 0
    open_: list[int] = []
    for low, i in sorted(keyroots(left).items(), key=lambda x: (x[0], -x[1])):
        while open_ and open_[-1] < low:
            open_.pop()
        if i > low or not open_:
            open_.append(i)
            total += i - low + 2
            deepest = max(deepest, len(open_))
    return total, deepest


class _Columns:
    """The second tree: its subtrees as segments of cells, deepest first; a cell before the first node and one after each."""

    def __init__(self, codes: np.ndarray, left: list[int]):
        self.codes, self.left, self.n = codes, np.array(left), len(left)
        self.size = np.arange(self.n) - self.left + 1
        self.where: dict[int, np.ndarray] = {}
        order = np.argsort(codes, kind="stable")
        at = np.flatnonzero(np.diff(codes[order], prepend=-1))
        for x, y in zip(at, [*at[1:], self.n], strict=True):
            self.where[int(codes[order[x]])] = order[x:y]
        segments, open_ = [], []
        for low, i in sorted(keyroots(left).items(), key=lambda x: (x[0], -x[1])):
            while open_ and open_[-1] < low:
                open_.pop()
            if i > low or not open_:
                segments.append((-len(open_), low, i))
                open_.append(i)
        self.level, self.at, self.end = np.array(sorted(segments)).T
        self.base = np.concatenate(([0], np.cumsum(self.end - self.at + 2)))
        self.kept = np.full(self.base[-1] + 1, FAR)  # a place for moving cells from window to window; the last stays FAR

    def moved(self, places: np.ndarray, values: np.ndarray, to: np.ndarray) -> np.ndarray:
        self.kept[places] = values
        out = self.kept[to]
        self.kept[places] = FAR
        return out


class _Window:
    """Cells of the columns lo to hi - 1, each segment with the cell before its first one; a last cell is FAR."""

    def __init__(self, c: _Columns, lo: int, hi: int):
        self.lo, self.hi = lo, hi
        first, last = np.maximum(c.at, lo), np.minimum(c.end, hi - 1)
        own = np.flatnonzero(first <= last)
        first, at, base = first[own], c.at[own], c.base[:-1][own]
        count = last[own] - first + 2
        starts = np.concatenate(([0], np.cumsum(count)))
        n = int(starts[-1])
        seg = np.repeat(np.arange(len(own)), count)
        y = np.arange(n) - starts[seg] + (first - at)[seg]
        q = at[seg] + y - 1
        inner = np.ones(n, bool)
        inner[starts[:-1]] = False
        low = c.left[np.maximum(q, 0)]
        back = low - at[seg]
        self.n, self.y = n, np.append(y, FAR)
        self.place = base[seg] + y
        self.back_place = np.append(np.where(inner, base[seg] + back, len(c.kept) - 1), len(c.kept) - 1)
        self.back = np.append(np.where(inner & (back >= (first - at)[seg]), starts[seg] + back - (first - at)[seg], n), n)
        self.column = np.append(np.where(inner, q - lo, hi - lo), hi - lo)
        self.off = np.arange(n + 1) + np.append(seg, len(own)) * APART
        self.root = int(starts[-2])
        level = c.level[own][seg]
        whole = inner & (low == at[seg])
        self.levels = []
        for x, z in zip(b := [0, *np.flatnonzero(np.diff(level)) + 1], [*b[1:], n], strict=True):
            w, o = np.flatnonzero(whole[x:z]), np.flatnonzero((inner & ~whole)[x:z])
            self.levels.append((x, z, w, w + x - 1, c.codes[q[w + x]], self.column[w + x], o, back[o + x], self.column[o + x]))
        self.left, self.size, self.codes = c.left[lo:hi], c.size[lo:hi], c.codes[lo:hi]
        self.leaves = np.flatnonzero(self.size == 1)
        self.leaf_codes = self.codes[self.leaves]


@dataclass
class _Open:
    """A subtree of the first tree while its nodes come: its row, and the rows of those around it as they were before."""

    low: int
    last: int
    row: np.ndarray
    before: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    back: list[np.ndarray] = field(default_factory=list)


def _advance(row: np.ndarray, best: np.ndarray, off: np.ndarray) -> None:
    row += 1
    np.minimum(row, best, out=row)
    row -= off
    np.minimum.accumulate(row, out=row)
    row += off


def _pass(codes: np.ndarray, left: list[int], c: _Columns, low: int, high: int, bound: int | None = None) -> int:
    """The distance by ways on the diagonals low to high (column less row). With bound, which the distance does not
    exceed, diagonals are given up where the way so far and the least way on are beyond it: values never fall along a
    diagonal, so no way as short as bound comes back to it."""
    n = len(left)
    last_of = keyroots(left)
    seen = np.zeros(int(max(codes.max(), c.codes.max())) + 1, np.int64)
    open_: list[_Open] = []
    w: _Window | None = None
    for p in range(n):
        if p % ROWS == 0:
            if w is not None and bound is not None:
                at = np.arange(w.root, w.n)
                d = w.y[at] - p  # of the row before: column y - 1, row p - 1
                may = d[open_[0].row[at] + np.abs(d - (c.n - n)) <= bound]
                low, high = low if may.min() == -p else max(low, int(may.min())), min(high, int(may.max()))  # -p: further ones begin below
            new = _Window(c, max(0, p + low), min(c.n, min(p + ROWS, n) + high))
            for s in open_:
                s.row = np.append(c.moved(w.place, s.row[:-1], new.place), FAR)
                s.back = [c.moved(places, values, new.back_place) for places, values in s.before]
            w, td = new, np.full(new.hi - new.lo + 1, FAR)
        first, code = left[p], codes[p]
        if first == p:
            td[:-1] = w.size
            if (at := c.where.get(int(code))) is not None:
                k = np.searchsorted(at, w.left)
                td[:-1] -= np.append(at, c.n)[k] < np.arange(w.lo, w.hi) + 1
            if last_of[p] > p or not open_:
                s = _Open(p, last_of[p], w.y - np.int64(0))
                s.before = [(w.place, o.row[:-1].copy()) for o in open_]
                s.back = [c.moved(places, values, w.back_place) for places, values in s.before]
                open_.append(s)
        else:
            seen[codes[first : p + 1]] = p
            td[w.leaves] = p - first + (seen[w.leaf_codes] != p)
        own = open_[-1] if open_[-1].low == first else None
        if own:
            for x, z, whole, before, labels, columns, others, back, other_columns in w.levels:
                new_row = own.row[x:z] + 1
                new_row[whole] = np.minimum(new_row[whole], own.row[before] + (labels != code))
                new_row[others] = np.minimum(new_row[others], back + td[other_columns])
                new_row -= w.off[x:z]
                np.minimum.accumulate(new_row, out=new_row)
                new_row += w.off[x:z]
                own.row[x:z] = new_row
                td[columns] = new_row[whole]
        around = open_[:-1] if own else open_
        if around:
            by_cell = td.take(w.column)
            for k, o in enumerate(around):
                _advance(o.row, by_cell + (own.back[k] if own else o.row.take(w.back)), w.off)
        if own and own.last == p:
            open_.pop()
    return int(td[c.n - 1 - w.lo])


def distance(la: list, lma: list[int], lb: list, lmb: list[int]) -> int:
    """Edit distance of two trees given by labels and first leaves in postorder, the roots last and equal.

    A pass near the diagonal gives a bound; a second one looks at all ways that keep to it.
    """
    numbers: dict = {}
    a, b = (np.array([numbers.setdefault(x, len(numbers)) for x in labels]) for labels in (la, lb))
    c, more = _Columns(b, lmb), len(lb) - len(la)
    low, high = min(0, more) - REACH, max(0, more) + REACH
    bound = _pass(a, lma, c, low, high)
    rest = (bound - abs(more)) // 2
    widest_low, widest_high = min(0, more) - rest, max(0, more) + rest
    if widest_low >= low and widest_high <= high:
        return bound
    return _pass(a, lma, c, widest_low, widest_high, bound)
