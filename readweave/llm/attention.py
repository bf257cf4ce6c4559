"""A causal self-attention language model over subwords, in numpy, with its gradient.

The most frequent subwords have a slot each; the others share one of two slots, one for subwords that open
a word and one for those inside. Slots lie in GROUPS groups of GROUP, and a group holds one of the two kinds
only, so that the chance that a word ends is a sum over groups. One layer of masked attention reads a window.
Its output gives the distribution over groups and over the slots inside each group, as a tilt
of biases that start, and stay, at smoothed bigram counts. The same embeddings are keys and values: the layer is
linear beyond its weights, so a value matrix would only multiply with the output's; what the present
subword itself says is in the biases already, and the one before it has an embedding of its own beside the layer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

GROUPS = 16
GROUP = 64
SLOTS = GROUPS * GROUP
#: Subwords with a slot of their own: with both kinds' shared slot and part-filled groups they fit in GROUPS.
KEPT = SLOTS - 2 * GROUP
WIDTH = 16
#: A window holds so many subwords; the first of them are context only, so each is scored in one window.
WINDOW = 40
CONTEXT = 8
STEP = WINDOW - CONTEXT
#: Windows of a training step, and of a step of scoring.
BATCH = 256
SCORED = 512
RATE = 0.02
NONE = -30.0

PARAMETERS = ("embed", "near", "far", "look", "kind", "out")


def initial(seed: int = 11) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    shapes = {"embed": (SLOTS, WIDTH), "near": (SLOTS, WIDTH), "far": (WINDOW,), "look": (WIDTH, WIDTH), "kind": (GROUPS, WIDTH), "out": (SLOTS, WIDTH)}
    scale = {"embed": 0.5, "near": 0.1, "far": 0.0, "look": 0.1, "kind": 0.02, "out": 0.02}
    return {k: (rng.normal(size=s) * scale.get(k, WIDTH**-0.5)).astype(np.float32) for k, s in shapes.items()}


def slots_of(counts: np.ndarray, opening: np.ndarray, end: int) -> tuple[np.ndarray, int]:
    """Slot of every subword id, and how many groups are of ids that open a word (the end id among them)."""
    opening = opening.copy()
    opening[end] = True
    order = np.lexsort((np.arange(len(counts)), -counts))
    order = np.concatenate([[end], order[order != end]])
    kept = order[:KEPT]
    slot = np.zeros(len(counts), np.int64)
    first = kept[opening[kept]]
    openers = -(-(len(first) + 1) // GROUP)
    for own, begin, kind in ((first, 0, opening), (kept[~opening[kept]], openers * GROUP, ~opening)):
        slot[kind] = begin + len(own)  # the shared one
        slot[own] = begin + np.arange(len(own))
    return slot, openers


@dataclass
class Tables:
    """Biases of the model from counts of the training texts: the slots' bigrams, smoothed by single counts."""

    bigrams: np.ndarray  # SLOTS x SLOTS counts of (before, next)
    used: np.ndarray  # which slots stand for any id
    openers: int

    def __post_init__(self) -> None:
        pair = self.bigrams.astype(np.float64)
        single = (pair.sum(axis=0) + 1) * self.used
        single /= single.sum()
        new = np.maximum((pair > 0).sum(axis=1, keepdims=True), 1)
        chance = (pair + new * single) / (pair.sum(axis=1, keepdims=True) + new)
        by_group = chance.reshape(SLOTS, GROUPS, GROUP).sum(axis=2)
        with np.errstate(divide="ignore", invalid="ignore"):
            self.group = np.maximum(np.log(by_group), NONE).astype(np.float32)
            inside = np.log(chance.reshape(SLOTS, GROUPS, GROUP) / by_group[:, :, None])
        #: by group, the slot before and the slot in the group
        self.inside = np.ascontiguousarray(np.nan_to_num(np.maximum(inside, NONE), nan=NONE).astype(np.float32).transpose(1, 0, 2))


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and first position (in that text, may be before it) of each window over texts first[i]:first[i+1]."""
    n = -(-np.diff(first) // STEP)
    doc = np.repeat(np.arange(len(n)), n)
    return doc, (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)) * STEP - CONTEXT


_SPAN = np.arange(WINDOW)
_ONES = np.ones(max(WINDOW, GROUP, GROUPS), np.float32)  # sums by matrix product are the fastest
#: How far each position lies before the query's, for queries from CONTEXT on; none look ahead.
_BACK = np.maximum(_SPAN[CONTEXT:, None] - _SPAN, 0)
_AHEAD = np.where(_SPAN[CONTEXT:, None] < _SPAN, -1e9, 0).astype(np.float32)


def _raised(values: np.ndarray, most: float = 100.0) -> tuple[np.ndarray, np.ndarray]:
    """Exponentials in place and their sums over the last axis; most: what the values are at most.

    Values beyond what a float can hold are cut.
    """
    if most > 60:
        np.minimum(values, 60, out=values)
    np.exp(values, out=values)
    return values, values.reshape(-1, values.shape[-1]) @ _ONES[: values.shape[-1]].astype(values.dtype, copy=False)


def forward(p: dict[str, np.ndarray], tables: Tables, before: np.ndarray, target: np.ndarray, opening: np.ndarray, learn: bool = True) -> tuple[np.ndarray, np.ndarray, dict]:
    """Log-probability (natural) of each target of a batch of windows, that of any word's opening, and what the gradient needs if learn.

    before (n x WINDOW): the inputs; opening (n): how many of the window's first positions lie before the text.
    target (n x STEP): what comes next from position CONTEXT on. The layer is the only one, so the positions
    before CONTEXT are keys and values but ask nothing.
    """
    longest = {k: float(np.sqrt((p[k] ** 2).sum(axis=1).max())) for k in ("embed", "near", "kind", "out")}
    asking = p["embed"] @ p["look"]
    x, q = np.take(p["embed"], before, axis=0), np.take(asking, before[:, CONTEXT:], axis=0)
    n = len(x)
    a = q @ np.ascontiguousarray(x.transpose(0, 2, 1))
    a += np.take(p["far"], _BACK) + _AHEAD
    some = np.flatnonzero(opening)
    if len(some):
        a[some] += np.where(_SPAN < opening[some, None], -1e9, 0).astype(np.float32)[:, None, :]
    a, total = _raised(a, longest["embed"] * float(np.sqrt((asking**2).sum(axis=1).max())) + float(p["far"].max()))
    if learn:
        a /= total.reshape(n, STEP, 1)
    seen = (a @ x).reshape(-1, WIDTH)  # a mean of embeddings, so no longer than the longest
    if not learn:
        seen /= total[:, None]
    h = seen + np.take(p["near"], before[:, CONTEXT - 1 : -1], axis=0).reshape(-1, WIDTH)
    longest["h"] = longest["embed"] + longest["near"]
    b, t = before[:, CONTEXT:].reshape(-1), target.reshape(-1)
    kind = (t // GROUP).astype(np.uint8)
    g = np.take(tables.group, b, axis=0)
    g += h @ p["kind"].T
    g, norm = _raised(g, longest["h"] * longest["kind"])
    every = np.arange(len(t))
    chance = g[every, kind] / norm
    opens = np.log((g[:, : tables.openers] @ _ONES[: tables.openers].astype(g.dtype, copy=False)) / norm)
    order = np.argsort(kind, kind="stable")
    edge = np.concatenate([[0], np.cumsum(np.bincount(kind, minlength=GROUPS))])
    sorted_h, sorted_b, rest = np.take(h, order, axis=0), b[order], (t % GROUP)[order]
    inner, found = [], np.empty(len(t), h.dtype)
    for k in range(GROUPS):
        lo, hi = edge[k], edge[k + 1]
        if lo == hi:
            inner.append(None)
            continue
        w = np.take(tables.inside[k], sorted_b[lo:hi], axis=0)
        w += sorted_h[lo:hi] @ p["out"][k * GROUP : (k + 1) * GROUP].T
        w, sums = _raised(w, longest["h"] * longest["out"])
        found[lo:hi] = w[every[: hi - lo], rest[lo:hi]] / sums
        inner.append((w, sums) if learn else None)
    chance[order] *= found
    logs = np.log(chance)
    held = {"x": x, "q": q, "a": a, "seen": seen, "h": h, "g": g, "norm": norm, "kind": kind, "order": order, "edge": edge, "sorted_h": sorted_h, "rest": rest, "inner": inner, "before": before}
    return logs, opens, held


def _by_slot(slots: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sums of rows by slot."""
    slot = slots.reshape(-1).astype(np.uint16)
    order = np.argsort(slot, kind="stable")
    slot = slot[order]
    heads = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
    out = np.zeros((SLOTS, WIDTH), rows.dtype)
    out[slot[heads]] = np.add.reduceat(np.take(rows.reshape(-1, WIDTH), order, axis=0), heads, axis=0)
    return out


def gradient(p: dict[str, np.ndarray], s: dict, weight: np.ndarray) -> dict[str, np.ndarray]:
    """Gradient of the negative log-probability, each target weighed. Uses up what forward held."""
    n, every = len(s["x"]), np.arange(len(weight))
    d_g = s["g"]
    d_g *= (weight / s["norm"])[:, None]
    d_g[every, s["kind"]] -= weight
    g = {"kind": d_g.T @ s["h"], "out": np.zeros_like(p["out"])}
    d_h = d_g @ p["kind"]
    d_sorted, w = np.empty_like(s["sorted_h"]), weight[s["order"]]
    for k, inner in enumerate(s["inner"]):
        if inner is None:
            continue
        lo, hi = s["edge"][k], s["edge"][k + 1]
        inner, sums = inner
        inner *= (w[lo:hi] / sums)[:, None]
        inner[every[: hi - lo], s["rest"][lo:hi]] -= w[lo:hi]
        own = slice(k * GROUP, (k + 1) * GROUP)
        g["out"][own] = inner.T @ s["sorted_h"][lo:hi]
        d_sorted[lo:hi] = inner @ p["out"][own]
    back = np.empty_like(s["order"])
    back[s["order"]] = every
    d_h += np.take(d_sorted, back, axis=0)
    x, a = s["x"], s["a"]
    d_seen = d_h.reshape(n, STEP, WIDTH)
    d_s = d_seen @ np.ascontiguousarray(x.transpose(0, 2, 1))
    d_s -= np.einsum("ij,ij->i", d_h, s["seen"]).reshape(n, STEP, 1)
    d_s *= a
    g["far"] = np.bincount(_BACK.reshape(-1), d_s.sum(axis=0).reshape(-1), WINDOW).astype(d_s.dtype)
    d_q = (d_s @ x).reshape(-1, WIDTH)
    d_x = a.transpose(0, 2, 1) @ d_seen
    d_x += d_s.transpose(0, 2, 1) @ s["q"]
    g["look"] = x[:, CONTEXT:].reshape(-1, WIDTH).T @ d_q
    d_x[:, CONTEXT:] += (d_q @ p["look"].T).reshape(n, STEP, WIDTH)
    g["embed"], g["near"] = _by_slot(s["before"], d_x), _by_slot(s["before"][:, CONTEXT - 1 : -1], d_h)
    return g


def batches(slots: np.ndarray, first: np.ndarray, doc: np.ndarray, at: np.ndarray, end_slot: int, size: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(position of each target, whether it is inside its text, opening, before, target) of so many windows at once."""
    # slots with room before and behind, so that a window is a plain stretch
    wide = np.full(len(slots) + 2 * WINDOW, end_slot, np.int32)
    wide[WINDOW:-WINDOW] = slots
    for k in range(0, len(doc), size):
        d, s = doc[k : k + size], at[k : k + size]
        index = (first[d] + s)[:, None] + _SPAN
        before = wide[index + (WINDOW - 1)]
        before[s < 0, : CONTEXT + 1] = end_slot  # a text's first window; nothing of the text before it shows
        place = index[:, CONTEXT:]
        yield place, place < first[d + 1][:, None], np.maximum(-s, 0), before, wide[place + WINDOW]


def train(p: dict[str, np.ndarray], tables: Tables, slots: np.ndarray, first: np.ndarray, turn: int, end_slot: int, state: dict) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Adam steps over all windows of the given texts, in an order that depends on turn.

    state holds the moments and goes on from call to call. Returns the new parameters, and for each position
    the log-probabilities of its slot and of an opening just before the step that learnt from it.
    """
    doc, at = windows(first)
    own = np.random.default_rng(turn).permutation(len(doc))
    if not state:
        p = {k: v.copy() for k, v in p.items()}
        state |= {"m": {k: np.zeros_like(x) for k, x in p.items()}, "v": {k: np.zeros_like(x) for k, x in p.items()}, "step": 0}
    logs, opens = np.zeros(len(slots), np.float32), np.zeros(len(slots), np.float32)
    for place, real, opening, before, target in batches(slots, first, doc[own], at[own], end_slot, BATCH):
        log, log_open, held = forward(p, tables, before, target, opening)
        inside = real.reshape(-1)
        logs[place[real]], opens[place[real]] = log[inside], log_open[inside]
        g = gradient(p, held, inside.astype(np.float32) / np.float32(max(1, inside.sum())))
        state["step"] += 1
        rate = RATE * np.sqrt(1 - 0.99 ** state["step"]) / (1 - 0.9 ** state["step"])
        for k in PARAMETERS:
            m, v = state["m"][k], state["v"][k]
            m += np.float32(0.1) * (g[k] - m)
            v += np.float32(0.01) * (g[k] * g[k] - v)
            p[k] -= np.float32(rate) * m / (np.sqrt(v) + np.float32(1e-8))
    return p, logs, opens


def score(p: dict[str, np.ndarray], tables: Tables, slots: np.ndarray, first: np.ndarray, end_slot: int) -> tuple[np.ndarray, np.ndarray]:
    """Natural log-probabilities of every position's slot and of a word's opening there; each position in one window."""
    logs, opens = np.zeros(len(slots), np.float32), np.zeros(len(slots), np.float32)
    for place, real, opening, before, target in batches(slots, first, *windows(first), end_slot, SCORED):
        log, log_open, _ = forward(p, tables, before, target, opening, False)
        logs[place[real]], opens[place[real]] = log[real.reshape(-1)], log_open[real.reshape(-1)]
    return logs, opens


def words(logs: np.ndarray, opens: np.ndarray, starts: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The model's log-probability of each word as a whole, from those of its positions.

    starts: the positions at which words (and ends) begin. A word is its opening, given that one comes, its
    further subwords, and that another opening follows; an end is its opening alone.
    """
    total = np.add.reduceat(logs.astype(np.float64), starts) - opens[starts]
    after = np.append(starts[1:], len(logs))
    ends = np.zeros(len(starts), dtype=bool)
    ends[np.searchsorted(starts, first[1:] - 1)] = True
    total[~ends] += opens[after[~ends]]
    return total
