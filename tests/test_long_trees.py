import random
import tracemalloc

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from leafwright.functions import long_trees as L
from leafwright.functions import similarity as S

titles = st.lists(st.tuples(st.sampled_from("abcdef"), st.integers(0, 9)), max_size=40)


def large(n, seed=1):
    """Titles with levels, and the same with some lost, others renamed, moved or without level."""
    r = random.Random(seed)
    level, a, b = 1, [], []
    for i in range(n):
        level = r.randint(1, min(level + 1, 6))
        a.append((f"t{i}", level + (i % 5 == 0)))
        if r.random() < 0.97:
            b.append((f"t{i}" if r.random() < 0.95 else "other", 1 if r.random() < 0.23 else level))
    return a, b


@settings(max_examples=150, deadline=None)
@given(titles, titles, st.booleans(), st.sampled_from([1, 3, 256]), st.sampled_from([0, 2, 256]))
def test_rows_give_what_the_table_gives(a, b, near, rows, reach):
    if near:
        b = [(x, n if i % 4 else 1) for i, (x, n) in enumerate(a) if i % 7] + b[:3]
    x, y = S.level_tree(a), S.level_tree(b)
    with pytest.MonkeyPatch.context() as m:
        m.setattr(L, "ROWS", rows)
        m.setattr(L, "REACH", reach)
        want = S._by_table(x, y)
        for mirrored in (False, True):
            assert L.distance(*S.postorder(x, mirrored), *S.postorder(y, mirrored)) == want


@pytest.mark.parametrize("seed", [1, 2])
def test_large_trees_in_narrow_windows(seed, monkeypatch):
    a, b = large(700, seed)
    b = b[40:] + b[:40]  # far from the diagonal
    x, y = S.level_tree(a), S.level_tree(b)
    want = S._by_table(x, y)
    monkeypatch.setattr(L, "REACH", 4)
    monkeypatch.setattr(L, "ROWS", 32)
    assert S.tree_distance(x, y) == S.tree_distance(y, x) == want


def test_large_trees_take_little_memory():
    a, b = large(2000)
    x, y = S.level_tree(a), S.level_tree(b)
    tracemalloc.start()
    try:
        d = S.tree_distance(x, y)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert 0 < d < 2000 and peak < 20_000_000


@pytest.mark.parametrize("before", [False, True])
def test_combs_of_either_side(before, monkeypatch):
    """Nodes nested deep, each with a leaf before or behind the next one."""
    monkeypatch.setattr(S, "TABLE", 0)
    comb = lambda n: ([f"n{i}" for i in range(n)] + [f"leaf{i}" for i in range(n)], [*range(-1, n - 1), *range(n)])
    turned = lambda t: (t[0][::-1], [len(t[0]) - 1 - p if p >= 0 else -1 for p in t[1][::-1]])
    x, y = comb(30), comb(26)
    if before:
        x, y = turned(x), turned(y)
    assert S.tree_distance(x, y) == S.tree_distance(y, x) == S._by_table(x, y) == 8
