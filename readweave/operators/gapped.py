"""Gapped extension of exact runs: banded dynamic programming with affine gaps and a drop limit, whole batches at once.

From the middle of a run the alignment is extended both ways. A cell is the pair of bases used so far of both reads; cells that fall by more
than the drop below the best score so far, or drift off the run's diagonal by more than the band, are dead. The
recurrences run over all pairs of a batch in numpy, one row of the band after another; directions are kept and followed back
from the best cell, so that every block comes with its columns.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Columns of an alignment: both reads, the first only, the second only.
BOTH, FIRST, SECOND = 0, 1, 2
DEAD = -(1 << 28)
#: Direction bytes that are kept at once (or those of one pair).
HELD = 32 << 20


@dataclass(frozen=True)
class Scores:
    match: int
    mismatch: int
    gap_open: int  # charged once a gap, beside gap_extend for each of its bases
    gap_extend: int
    drop: int
    band: int = 12


def _padded(reads: list[np.ndarray], fill: int) -> np.ndarray:
    out = np.full((len(reads), max(map(len, reads), default=0)), fill, np.uint8)
    for k, r in enumerate(reads):
        out[k, : len(r)] = r
    return out


def _forward(x: list[np.ndarray], y: list[np.ndarray], s: Scores) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Best score, bases used of x and of y, and the columns' kinds, of extensions from the first bases on."""
    n, w = len(x), s.band
    width = 2 * w + 1
    lx, ly = np.array([len(r) for r in x]), np.array([len(r) for r in y])
    rows = int(np.minimum(lx, ly + w).max(initial=0))
    # y is shifted so that row i of the band is a slice of it; what lies outside matches nothing
    a, b = _padded(x, 0), _padded(y, 1)
    b = np.pad(b, ((0, 0), (w, max(0, rows + w + 1 - b.shape[1]))), constant_values=1)
    off = np.arange(width) - w
    step = s.gap_extend * np.arange(width)
    h = np.where(off > 0, -s.gap_open - s.gap_extend * off, np.where(off == 0, 0, DEAD)).astype(np.int64)
    h = np.where(off[None] <= ly[:, None], h[None], DEAD)
    h[h < -s.drop] = DEAD
    e = np.full((n, width), DEAD, np.int64)
    best, best_i, best_d = np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, w)
    ways = np.zeros((rows + 1, n, width), np.uint8)
    ways[0] = np.where(off > 0, SECOND | np.where(off == 1, 8, 0), 0)
    live = np.arange(n)
    for i in range(1, rows + 1):
        live = live[(h[live].max(axis=1) > DEAD // 2) & (lx[live] >= i)]
        if not len(live):
            break
        before, gap = h[live], e[live]
        opened = np.full_like(before, DEAD)
        opened[:, :-1] = before[:, 1:] - s.gap_open - s.gap_extend
        longer = np.full_like(before, DEAD)
        longer[:, :-1] = gap[:, 1:] - s.gap_extend
        down = np.maximum(opened, longer)
        same = a[live, i - 1][:, None] == b[live, i - 1 : i - 1 + width]
        diagonal = before + np.where(same, s.match, -s.mismatch)
        now = np.maximum(diagonal, down)
        # a gap in x begins where opening it pays most
        lead = np.maximum.accumulate(now + step, axis=1)
        across = np.full_like(now, DEAD)
        across[:, 1:] = lead[:, :-1] - step[1:] - s.gap_open
        total = np.maximum(now, across)
        j = i + off
        total[(j[None] < 0) | (j[None] > ly[live][:, None])] = DEAD
        top = total.max(axis=1)
        up = top > best[live]
        moved = live[up]
        best[moved], best_i[moved], best_d[moved] = top[up], i, total[up].argmax(axis=1)
        dead = total < best[live][:, None] - s.drop
        kind = np.where(total == diagonal, BOTH, np.where(total == down, FIRST, SECOND))
        first = np.zeros_like(kind)
        first[:, 1:] = now[:, :-1] - s.gap_open - s.gap_extend == across[:, 1:]
        ways[i, live] = kind | 4 * (opened >= longer) | 8 * first
        total[dead] = DEAD
        down[dead] = DEAD
        h[live], e[live] = total, down
    # back from the best cells, all at once
    at, d, state, columns = best_i.copy(), best_d.copy(), np.full(n, BOTH), np.full((int((best_i + np.maximum(0, best_i + best_d - w)).max(initial=0)), n), 3, np.uint8)
    inside = np.zeros(n, dtype=bool)
    for k in range(len(columns)):
        todo = np.flatnonzero((at > 0) | (d > w))
        if not len(todo):
            break
        way = ways[at[todo], todo, d[todo]]
        own = np.where(inside[todo], state[todo], way & 3)
        columns[k, todo] = own
        ends = np.where(own == FIRST, way & 4, np.where(own == SECOND, way & 8, 1)) > 0
        state[todo], inside[todo] = own, ~ends
        at[todo] -= own != SECOND
        d[todo] += np.where(own == FIRST, 1, np.where(own == SECOND, -1, 0))
    return best, best_i, best_i + best_d - w, [c[c < 3][::-1] for c in columns.T]


def _batched(x: list[np.ndarray], y: list[np.ndarray], s: Scores) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """_forward over pairs of similar length together, within HELD bytes."""
    n = len(x)
    size = np.array([min(len(a), len(b) + s.band) + 1 for a, b in zip(x, y, strict=True)], np.int64)
    order = np.argsort(-size, kind="stable")
    score, used_x, used_y, columns = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64), [np.zeros(0, np.uint8)] * n
    first = 0
    while first < n:
        many = max(1, HELD // (int(size[order[first]]) * (2 * s.band + 1)))
        own = order[first : first + many]
        score[own], used_x[own], used_y[own], found = _forward([x[k] for k in own], [y[k] for k in own], s)
        for k, c in zip(own.tolist(), found, strict=True):
            columns[k] = c
        first += many
    return score, used_x, used_y, columns


@dataclass(frozen=True)
class Alignment:
    start1: int
    start2: int
    score: int
    columns: np.ndarray  # BOTH, FIRST, SECOND

    @property
    def end1(self) -> int:
        return self.start1 + int((self.columns != SECOND).sum())

    @property
    def end2(self) -> int:
        return self.start2 + int((self.columns != FIRST).sum())

    def texts(self, a: str, b: str) -> tuple[str, str]:
        """Both reads' stretches, - where the other has a base that this one has not."""
        out = []
        for text, start, end, gap in ((a, self.start1, self.end1, SECOND), (b, self.start2, self.end2, FIRST)):
            signs = np.full(len(self.columns), ord("-"), np.uint8)
            signs[self.columns != gap] = np.frombuffer(text[start:end].encode("latin-1"), np.uint8)
            out.append(signs.tobytes().decode("latin-1"))
        return out[0], out[1]

    def passes(self, at1: np.ndarray, at2: np.ndarray) -> np.ndarray:
        """Which of the base pairs lie on it."""
        one = self.start1 + np.cumsum(self.columns != SECOND) - 1
        two = self.start2 + np.cumsum(self.columns != FIRST) - 1
        both = self.columns == BOTH
        place = np.full(self.end1 - self.start1 + 1, -1)
        place[one[both] - self.start1] = two[both]
        inside = (at1 >= self.start1) & (at1 < self.end1)
        return inside & (place[np.where(inside, at1 - self.start1, -1)] == at2)


def coded(text: str) -> np.ndarray:
    """Bases for comparison: upper case, and an N of one read is not that of another."""
    return np.frombuffer(text.upper().encode("latin-1"), np.uint8)


def extended(pairs: list[tuple[str, str]], anchors: list[tuple[int, int]], s: Scores) -> list[Alignment]:
    """The alignment through each pair's anchor (a place in both reads), extended both ways."""
    left_x, left_y, right_x, right_y = [], [], [], []
    for (a, b), (i, j) in zip(pairs, anchors, strict=True):
        x, y = coded(a), coded(b).copy()
        y[y == ord("N")] = ord("n")  # an N never matches
        left_x.append(x[:i][::-1])
        left_y.append(y[:j][::-1])
        right_x.append(x[i:])
        right_y.append(y[j:])
    left, right = _batched(left_x, left_y, s), _batched(right_x, right_y, s)
    return [
        Alignment(i - int(left[1][k]), j - int(left[2][k]), int(left[0][k] + right[0][k]), np.concatenate([left[3][k][::-1], right[3][k]]))
        for k, (i, j) in enumerate(anchors)
    ]


def blocks_of(pairs: list[tuple[str, str]], runs: list[list[tuple[int, int, int]]], s: Scores) -> list[list[Alignment]]:
    """Of each pair all alignments through its runs (length, start1, diagonal), longest runs first; a run that lies on an
    alignment found before gives none of its own."""
    found: list[list[Alignment]] = [[] for _ in pairs]
    left = [sorted(own, key=lambda r: (-r[0], r[1], r[2])) for own in runs]
    while todo := [k for k, own in enumerate(left) if own]:
        anchors = [(r[1] + r[0] // 2, r[1] + r[0] // 2 - r[2]) for r in (left[k][0] for k in todo)]
        for k, made in zip(todo, extended([pairs[k] for k in todo], anchors, s), strict=True):
            found[k].append(made)
            rest = left[k][1:]
            if rest:
                length, start, diagonal = np.array(rest).T
                middle = start + length // 2
                on = made.passes(middle, middle - diagonal)
                rest = [r for r, gone in zip(rest, on.tolist(), strict=True) if not gone]
            left[k] = rest
    return found
