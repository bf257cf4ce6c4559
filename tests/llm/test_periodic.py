"""Periodic runs against a quadratic model, and the query's digests."""

import hashlib
import random
import re
import zlib

import numpy as np

from readweave.llm import periodic

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOC = "doc_id long, text string, runs string, n_words string, collapsed string, h long, w string, a string, g string, p string"


def smallest_period(w):
    return next(q for q in range(1, len(w) + 1) if w[q:] == w[: len(w) - q])


def model_runs(w):
    """Every stretch that no neighbouring word extends, by trying all periods."""
    out = set()
    for q in range(1, len(w) // 4 + 1):
        s = 0
        while s + q < len(w):
            e = s + q
            while e < len(w) and w[e] == w[e - q]:
                e += 1
            if e - s >= max(6, 4 * q) and (s == 0 or w[s - 1] != w[s - 1 + q]) and smallest_period(w[s:e]) == q:
                out.add((s, e - s, q))
            s += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def model_row(doc_id, text, plant=True):
    w = WORD.findall(text or "")
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g, n = h // 10, len(w)
    if plant and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = model_runs(w)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None,) * 3
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    sums = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{s},{n},{q}\n" for s, n, q in runs), " ".join(x for i, x in enumerate(w) if i not in dropped))]
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, *sums)


def test_runs_match_model():
    rng = random.Random(3)
    texts = []
    for _ in range(400):
        w = []
        for _ in range(rng.randrange(1, 6)):
            unit = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randrange(1, 7))]
            w += (unit * rng.randrange(1, 8))[: rng.randrange(1, 45)]
        texts.append(w)
    texts += [[], [1], [1] * 5, [1] * 6, [1, 2] * 4, [1, 2, 3] * 3, [1, 2, 3] * 4]
    first = np.concatenate([[0], np.cumsum([len(w) for w in texts])])
    text, start, length, period = periodic.find_runs(np.array([x for w in texts for x in w]), first)
    got = [[] for _ in texts]
    for t, *r in zip(text.tolist(), start.tolist(), length.tolist(), period.tolist(), strict=True):
        got[t].append(tuple(r))
    assert got == [model_runs(w) for w in texts]


def test_query_matches_model(spark):
    rng = random.Random(5)
    texts = ["", None, " \n\t", "a", "A a A a A a A a", "x " * 30000 + "end", "日 é ß  日 é ß " * 5, "same " * 6, "same " * 5]
    texts += [" ".join(rng.choices("abcdefghij", k=rng.randrange(1, 80))) for _ in range(120)]
    texts += [" ".join((rng.choices("abc", k=rng.randrange(1, 4)) * 9)[: rng.randrange(1, 30)] + ["z"] * rng.randrange(9)) for _ in range(60)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, "b " * 7), (7, texts[7]), (7, texts[7])]
    docs = spark.createDataFrame([(*r, *"xyz", 1, *"wagp") for r in rows], DOC).repartition(3)
    got = periodic.digest(periodic.periodic_runs(periodic.planted(docs))).collect()
    fast = {5: None}  # too long for the model
    want = [model_row(*r) for r in rows if r[0] not in fast]
    assert sorted(map(tuple, (r for r in got if r.doc_id not in fast)), key=str) == sorted(want, key=str)
    plain = {r.doc_id: r for r in periodic.periodic_runs(docs).collect()}
    assert [tuple(r) for r in plain[5].runs] == [(0, 30000, 1)] and plain[5].collapsed == "x end" and plain[5].n_words == 30001


def test_no_rows(spark):
    none = spark.createDataFrame([], DOC)
    assert periodic.digest(periodic.periodic_runs(periodic.planted(none))).count() == 0
