"""Similarity of texts and of trees."""

from __future__ import annotations

from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leafwright.functions import long_trees


def compact(text: Column) -> Column:
    """Digits, Latin letters and Han characters only, in lower case."""
    return F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^0-9A-Za-z\x{4e00}-\x{9fff}]+", ""))


def similarity(a: str, b: str) -> float:
    """Ratio of matching blocks of two compact texts; 0.9 at least if one is part of the other."""
    if not a or not b:
        return 1.0 if a == b else 0.0
    score = SequenceMatcher(None, a, b).ratio()
    return max(score, 0.9) if a in b or b in a else score


@F.pandas_udf(T.DoubleType())
def text_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([similarity(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


#: Subtrees with more nodes than this are compared a row at a time.
WIDE = 48
#: Pairs of nodes up to which a table of all pairs is held.
TABLE = 1 << 18


def level_tree(nodes: list[tuple[str, int]]) -> tuple[list[str], list[int]]:
    """Labels and parents (-1: the root) of nodes given with levels in reading order."""
    parents: list[int] = []
    open_: list[tuple[int, int]] = []
    for i, (_, level) in enumerate(nodes):
        while open_ and open_[-1][0] >= level:
            open_.pop()
        parents.append(open_[-1][1] if open_ else -1)
        open_.append((level, i))
    return [label for label, _ in nodes], parents


def postorder(t: tuple[list[str], list[int]], mirrored: bool = False) -> tuple[list[str | None], list[int]]:
    """Labels and first leaves of a tree's nodes in postorder, with a root of label None at the end; mirrored: the children of each node from last to first."""
    labels, parents = t
    kids: list[list[int]] = [[] for _ in range(len(labels) + 1)]
    for i, p in enumerate(parents):
        kids[p + 1].append(i + 1)
    if mirrored:
        for k in kids:
            k.reverse()
    order: list[int] = []
    stack = [(0, False)]
    while stack:
        n, done = stack.pop()
        if done:
            order.append(n)
        else:
            stack.append((n, True))
            stack.extend((k, False) for k in reversed(kids[n]))
    at = {n: i for i, n in enumerate(order)}
    left: list[int] = []
    for n in order:
        left.append(left[at[kids[n][0]]] if kids[n] else at[n])
    return [None if n == 0 else labels[n - 1] for n in order], left


def tree_distance(a: tuple[list[str], list[int]], b: tuple[list[str], list[int]]) -> int:
    """Edit distance of two ordered trees at unit costs, after Zhang and Shasha; both get a common root.

    A table of all pairs of nodes is held up to TABLE pairs only; beyond, rows are, in the one of four equal views of
    the trees (each one first, both mirrored) that needs least, unless nodes nest so that the table is smaller still.
    """
    pairs = (len(a[0]) + 1) * (len(b[0]) + 1)
    if pairs > TABLE:
        views = []
        for mirrored in (False, True):
            x, y = postorder(a, mirrored), postorder(b, mirrored)
            (n, deep), (m, other_deep) = long_trees.cells(x[1]), long_trees.cells(y[1])
            views += [(m * deep * deep, x, y), (n * other_deep * other_deep, y, x)]
        need, x, y = min(views, key=lambda v: v[0])
        if need < pairs:
            return long_trees.distance(*x, *y)
    return _by_table(a, b)


def _by_table(a: tuple[list[str], list[int]], b: tuple[list[str], list[int]]) -> int:
    (la, lma), (lb, lmb) = postorder(a), postorder(b)
    ka, kb = (sorted(long_trees.keyroots(left).values()) for left in (lma, lmb))
    dist = _leaf_distances(la, lma, lb, lmb)
    left = np.array(lmb)
    codes: dict = {}
    lb_codes = np.array([codes.setdefault(x, len(codes)) for x in lb])
    for i in (k for k in ka if lma[k] != k):
        low = lma[i]
        for j in (k for k in kb if lmb[k] != k):
            at, n = lmb[j], j - lmb[j] + 2
            if n > WIDE:
                _by_rows(dist, la, lma, i, j, left, lb_codes, codes)
                continue
            f = [list(range(n))]
            for x in range(1, i - low + 2):
                p = x + low - 1
                before, row, own = f[-1], [x], dist[p]
                far = f[lma[p] - low]
                for y in range(1, n):
                    q = y + at - 1
                    if lma[p] == low and lmb[q] == at:
                        v = min(before[y] + 1, row[-1] + 1, before[y - 1] + (la[p] != lb[q]))
                        own[q] = v
                    else:
                        v = min(before[y] + 1, row[-1] + 1, far[lmb[q] - at] + own[q])
                    row.append(v)
                f.append(row)
    return dist[-1][-1]


def _leaf_distances(la: list, lma: list[int], lb: list, lmb: list[int]) -> list[list[int]]:
    """Distances of all pairs of subtrees of which one is a single node: the other's size less one, and one more if
    the node's label is not in it. Other pairs are 0 as yet."""
    dist = np.zeros((len(la), len(lb)), np.int64)

    def fill_in(labels: list, lows: list[int], others: list, other_lows: list[int], out: np.ndarray) -> None:
        size = np.arange(len(others)) - np.array(other_lows) + 1
        at: dict = {}
        for i, (label, low) in enumerate(zip(labels, lows, strict=True)):
            if low == i:
                if label not in at:
                    n = np.concatenate(([0], np.cumsum([x == label for x in others])))
                    at[label] = size - (n[1:] - n[np.array(other_lows)] > 0)
                out[i] = at[label]

    fill_in(la, lma, lb, lmb, dist)
    fill_in(lb, lmb, la, lma, dist.T)
    return dist.tolist()


def _by_rows(dist: list[list[int]], la: list, lma: list[int], i: int, j: int, left: np.ndarray, lb_codes: np.ndarray, codes: dict) -> None:
    """One pair of large subtrees, a row of the table at a time: f[x][y - 1] + 1 is a running minimum of f[x][y] - y."""
    low, at = lma[i], int(left[j])
    n = j - at + 2
    steps = np.arange(n)
    f = np.zeros((i - low + 2, n), np.int64)
    f[0] = steps
    whole = left[at : j + 1] == at
    back = left[at : j + 1] - at
    for x in range(1, i - low + 2):
        p = x + low - 1
        best = f[lma[p] - low][back] + dist[p][at : j + 1]
        if lma[p] == low:
            best = np.where(whole, f[x - 1, :-1] + (lb_codes[at : j + 1] != codes.get(la[p], -1)), best)
        f[x, 0] = x
        f[x, 1:] = np.minimum(f[x - 1, 1:] + 1, best)
        f[x] = np.minimum.accumulate(f[x] - steps) + steps
        if lma[p] == low:
            own = dist[p]
            for q in np.flatnonzero(whole):
                own[at + q] = int(f[x, q + 1])


def tree_score(a: list[tuple[str, int]], b: list[tuple[str, int]]) -> float:
    """1 for equal title trees, less by the edit distance over the greater number of titles; 0 at least."""
    return max(0.0, 1.0 - tree_distance(level_tree(a), level_tree(b)) / (max(len(a), len(b)) or 1))
