"""Secret scans: fixed patterns, and character Markov models of random strings against ordinary identifiers.

A run of token characters is scored by the log-likelihood ratio of two first-order character models, one
trained on labelled random strings, one on labelled identifiers and words. Runs that are long
enough, hold a digit and score over the threshold per character are reported as kind "random".
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readweave.llm import text as T

#: The patterns of the base kinds, in the order in which they are listed, and least lengths.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "random")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24

#: The Markov kind: least characters of a run, and least log-likelihood ratio (nats) a character.
RUN_LEAST = 20
RATIO_LEAST = 0.6

_ASSIGN = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
#: Which texts the exact patterns have to look at.
_MAYBE = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]|AKIA[A-Z0-9]{16}|[0-9a-f]{24}"""

TOKEN = np.zeros(256, dtype=bool)
TOKEN[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"]] = True

#: Labelled samples of ordinary identifiers are put together from these.
PARTS = (
    "get set read write open close file path name value index count total list array table row column key user group "
    "order item price date time start end first last next prev update delete insert select from where join left right "
    "inner outer config option default error message handler request response server client session token address "
    "license version source target module package class function method object string number buffer stream block "
    "thread process memory cache store load save parse format print test check valid state status result data node "
    "edge graph tree queue stack hash sort search filter map reduce http https www com org net html index page image "
    "the and that with this from have which their would there could other than then them these some into only "
    "und der die das nicht mit sich auf für ist werden durch einen unter zwischen gegenüber "
    "les des une dans pour avec plus cette entre aussi comme leurs même autres depuis "
    "los las una para con como pero más desde entre sobre también porque cuando"
).split()


@lru_cache(1)
def samples(n: int = 4000, seed: int = 7) -> tuple[list[bytes], list[bytes]]:
    """Labelled samples, made by rule: n random strings, n identifiers."""
    rng = np.random.default_rng(seed)
    alphabets = [b"0123456789abcdef", b"0123456789ABCDEF", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"]
    noise = [bytes(rng.choice(np.frombuffer(alphabets[k % len(alphabets)], np.uint8), int(rng.integers(20, 64)))) for k in range(n)]
    names = []
    for k in range(n):
        words = [PARTS[i] for i in rng.integers(0, len(PARTS), int(rng.integers(2, 6)))]
        style = k % 6
        if style == 0:
            name = "_".join(words)
        elif style == 1:
            name = "-".join(words)
        elif style == 2:
            name = words[0] + "".join(w.capitalize() for w in words[1:])
        elif style == 3:
            name = "_".join(words).upper()
        elif style == 4:
            name = "/".join(words) + str(rng.integers(0, 100))
        else:
            name = "".join(words)
        names.append(name.encode())
    return noise, names


@lru_cache(1)
def ratios() -> np.ndarray:
    """256 x 256 log-likelihood ratios log P_random(b | a) - log P_name(b | a), smoothed over token characters."""
    tables = []
    for sample in samples():
        n = np.zeros((256, 256))
        for s in sample:
            codes = np.frombuffer(s, np.uint8)
            np.add.at(n, (codes[:-1], codes[1:]), 1)
        n[:, TOKEN] += 0.5
        tables.append(np.log(n / n.sum(axis=1, keepdims=True), where=n > 0, out=np.zeros_like(n)))
    return tables[0] - tables[1]


def random_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, end) in bytes within all texts of runs that look random."""
    starts, ends, first = T.word_spans(data, offsets, TOKEN)
    at = np.flatnonzero(ends - starts >= RUN_LEAST)
    if not len(at):
        return at, at, at
    doc = np.searchsorted(first, at, "right") - 1
    starts, ends = starts[at], ends[at]
    width = ends - starts - 1
    table = ratios()
    heads = np.concatenate([[0], np.cumsum(width)[:-1]])
    pos = np.arange(width.sum()) + np.repeat(starts - heads, width)
    score = np.add.reduceat(table[data[pos], data[pos + 1]], heads) / width
    digits = np.add.reduceat(((data[pos] >= 0x30) & (data[pos] <= 0x39)).astype(np.int64), heads) + ((data[ends - 1] >= 0x30) & (data[ends - 1] <= 0x39))
    ok = (score >= RATIO_LEAST) & (digits > 0)
    return doc[ok], starts[ok], ends[ok]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in code points of the base kinds, in the order in which they are reported."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def spans_of(column: pa.Array) -> list[list[tuple[int, int, int]]]:
    """(start, kind, end) in code points of all spans of every text; a random run that a base span meets is left out."""
    column = T.plain(column)
    out: list[list] = [[] for _ in range(len(column))]
    for k in np.flatnonzero(pc.match_substring_regex(column, _MAYBE).to_numpy(zero_copy_only=False)):
        out[k] = base_spans(column[int(k)].as_py())
    data, offsets = T.buffers(column)
    doc, starts, ends = random_runs(data, offsets)
    if len(doc):
        points = T.code_points(data)
        for d, a, b in zip(doc.tolist(), (points[starts] - points[offsets[doc]]).tolist(), (points[ends] - points[offsets[doc]]).tolist(), strict=True):
            if not any(x[0] < b and a < x[2] for x in out[d] if x[1] < 3):
                out[d].append((a, 3, b))
        for d in set(doc.tolist()):
            out[d].sort()
    return out


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) for every row of docs.

    Kinds assign, access and hex are leftmost non-overlapping matches of the fixed patterns, each kind on its
    own; kind random is the Markov models'. Spans are kind:start:end in code points (end exclusive), by
    start and then kind. A null or empty text has none. Only doc_id and text are read.
    """
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in T.blocks(batches):
            found = spans_of(part.column("text"))
            counts = [pa.array([sum(x[1] == k for x in s) for s in found], pa.int64()) for k in range(3)]
            digests = [hashlib.sha256(_joined([x for x in s if x[1] < 3]).encode()).hexdigest() for s in found]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *counts, pa.array(digests, pa.string()), pa.array([_joined(s) for s in found], pa.string())], names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def masked(text: str, spans: list[tuple[int, int, int]], put: str) -> str:
    """The text with each stretch that spans cover replaced; of an assignment only the value goes."""
    cut = []
    for a, kind, b in spans:
        if kind == 0:
            m = _ASSIGN.match(text, a)
            a = m.start(2)
        if cut and a <= cut[-1][1]:
            cut[-1][1] = max(b, cut[-1][1])
        else:
            cut.append([a, b])
    out, at = [], 0
    for a, b in cut:
        out += [text[at:a], put]
        at = b
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, put: str = "[secret]") -> DataFrame:
    """docs with secrets in text replaced; n_chars, where there is one, follows the new text. Rows stay.

    Null and empty texts, and texts without a secret, stay as they are, their n_chars too; spans that touch or overlap are
    replaced once; repeated rows and ids stay. Other columns are passed on, whatever they are called; no rows give no rows.
    """
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in T.blocks(batches):
            found = spans_of(part.column("text"))
            hit = [k for k, s in enumerate(found) if s]
            if hit:
                texts = part.column("text").to_pylist()
                for k in hit:
                    texts[k] = masked(texts[k], sorted(found[k]), put)
                columns = {c: part.column(c) for c in part.schema.names}
                columns["text"] = pa.array(texts, part.schema.field("text").type)
                if "n_chars" in columns:
                    n = part.column("n_chars").to_pylist()
                    for k in hit:
                        n[k] = len(texts[k])
                    columns["n_chars"] = pa.array(n, part.schema.field("n_chars").type)
                part = pa.RecordBatch.from_arrays(list(columns.values()), list(columns))
            yield part

    return docs.mapInArrow(run, schema)
