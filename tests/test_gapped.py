"""Gapped extension against a plain quadratic model, and planted insertions and deletions in overlaps."""

import random

import numpy as np
import pytest

from readweave.operators import gapped
from readweave.operators.gapped import BOTH, FIRST, SECOND, Scores


def model(x, y, s):
    """Best score of an extension from the first bases on, cell by cell, rows in order, with the same drop and band."""
    dead = float("-inf")
    h = {(0, 0): 0}
    down, across = {}, {}
    best = 0
    for i in range(len(x) + 1):
        row = {}
        for j in range(max(0, i - s.band), min(len(y), i + s.band) + 1):
            down[i, j] = max(h.get((i - 1, j), dead) - s.gap_open, down.get((i - 1, j), dead)) - s.gap_extend
            across[i, j] = max(row.get(j - 1, dead) - s.gap_open, across.get((i, j - 1), dead)) - s.gap_extend
            at = h.get((i - 1, j - 1), dead) + (s.match if i and j and x[i - 1] == y[j - 1] != "N" else -s.mismatch)
            row[j] = max(0 if i == j == 0 else dead, at, down[i, j], across[i, j])
        best = max([best, *row.values()])
        for j, v in row.items():
            if v >= best - s.drop:
                h[i, j] = v
            else:
                down[i, j] = dead
    return best


def scored(made, a, b, s):
    one, two = made.texts(a, b)
    total, gap = 0, None
    for p, q, c in zip(one, two, made.columns.tolist(), strict=True):
        if c == BOTH:
            total += s.match if p == q != "N" else -s.mismatch
        else:
            total -= s.gap_extend + (s.gap_open if c != gap else 0)
        gap = c if c != BOTH else None
    return total


def mutated(rng, text, subs, gaps):
    out = list(text)
    for _ in range(subs):
        out[rng.randrange(len(out))] = rng.choice("ACGTN")
    for _ in range(gaps):
        at = rng.randrange(len(out))
        if rng.random() < 0.5:
            del out[at : at + rng.randrange(1, 4)]
        else:
            out[at:at] = [rng.choice("ACGT") for _ in range(rng.randrange(1, 4))]
    return "".join(out)


@pytest.mark.parametrize("s", [Scores(1, 3, 1, 3, 10), Scores(1, 10, 10, 10, 20), Scores(1, 3, 1, 3, 10, 3), Scores(2, 3, 0, 2, 30, 6), Scores(1, 1, 0, 1, 15, 40)])
def test_extension_matches_quadratic_model(s):
    rng = random.Random(s.band)
    pairs = []
    for _ in range(150):
        a = "".join(rng.choices("ACGT", k=rng.randrange(0, 70)))
        b = mutated(rng, a, rng.randrange(4), rng.randrange(4)) if len(a) > 9 else "".join(rng.choices("ACGT", k=rng.randrange(9)))
        pairs.append((a, b))
    made = gapped.extended(pairs, [(0, 0)] * len(pairs), s)
    for (a, b), m in zip(pairs, made, strict=True):
        assert m.score == model(a, b, s) == scored(m, a, b, s)
        assert m.start1 == m.start2 == 0 and m.end1 <= len(a) and m.end2 <= len(b)
        assert not len(m.columns) or m.columns[-1] == BOTH


def test_both_ways_from_an_anchor():
    rng, s = random.Random(2), Scores(1, 3, 1, 3, 10)
    for _ in range(100):
        core = "".join(rng.choices("ACGT", k=30))
        left, right = ("".join(rng.choices("ACGT", k=60)) for _ in "lr")
        a, b = left + core + right, mutated(rng, left, 2, 2) + core + mutated(rng, right, 2, 2)
        i, j = len(left) + 15, b.index(core) + 15
        (m,) = gapped.extended([(a, b)], [(i, j)], s)
        assert m.score == model(a[i:], b[j:], s) + model(a[:i][::-1], b[:j][::-1], s) == scored(m, a, b, s)
        assert m.passes(np.array([i, i, i - 1]), np.array([j, j + 1, j - 1])).tolist() == [True, False, True]


def test_runs_on_one_alignment_give_it_once():
    rng, s = random.Random(4), Scores(1, 3, 1, 3, 10)
    a = "".join(rng.choices("ACGT", k=300))
    b = a[:100] + "T" * 2 + a[100:200] + a[202:]
    runs = [(100, 0, 0), (100, 100, -2), (98, 202, 0)]
    (found,) = gapped.blocks_of([(a, b)], [runs], s)
    assert len(found) == 1 and (found[0].start1, found[0].end1, found[0].start2, found[0].end2) == (0, 300, 0, 300)
    kinds = found[0].columns
    assert (kinds == SECOND).sum() == 2 == (kinds == FIRST).sum()
    # a second copy elsewhere is an alignment of its own
    (found,) = gapped.blocks_of([(a, b[:150] + "".join(rng.choices("ACGT", k=100)) + a[:150])], [[(100, 0, 0), (150, 0, -250)]], s)
    assert len(found) == 2 and {f.start2 for f in found} == {0, 250}
