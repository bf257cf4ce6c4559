"""Text primitives against plain Python."""

import re

import numpy as np
import pyarrow as pa
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from readweave.llm import text as T

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAzZ09 \t\n.é日\x0b'", max_size=60)), max_size=8)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words(texts):
    data, offsets = T.buffers(pa.array(texts, pa.string()))
    for member, pattern in ((T.SPACED, r"[^\x20\x09-\x0D]+"), (T.ALNUM, r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")):
        starts, ends, first = T.word_spans(data, offsets, member)
        got = [[data[a:b].tobytes().decode() for a, b in zip(starts[i:j], ends[i:j], strict=True)] for i, j in zip(first, first[1:], strict=False)]
        assert got == [re.findall(pattern, t or "") for t in texts]
        flat, a, b = T.joined(data, starts, ends)
        assert flat.tobytes().decode() == "".join(w + " " for t in got for w in t)
        assert (np.diff(np.concatenate([a, [len(flat)]])) == b - a + 1).all()


def test_xxh64_of_all_lengths():
    parts = [bytes((k * 7 + j) % 251 for j in range(k)) for k in range(150)] + [b"x" * 70000]
    data = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.cumsum([len(p) for p in parts])
    starts = np.concatenate([[0], ends[:-1]])
    assert T.xxh64(data, starts, ends).tolist() == [xxhash.xxh64_intdigest(p, 42) for p in parts]


def test_blocks_cover_every_row_once():
    batch = pa.RecordBatch.from_arrays([pa.array(range(50)), pa.array([None if k % 7 == 0 else "x" * (k * 13 % 40) for k in range(50)])], ["doc_id", "text"])
    for cut in (T.blocks, T.gathered):
        parts = list(cut([batch, batch.slice(0, 0), batch], limit=60))
        assert [x for p in parts for x in p.column("doc_id").to_pylist()] == [*range(50)] * 2


def test_slices_keep_their_texts():
    column = pa.array(["ab", None, "cde", ""]).slice(1, 3)
    data, offsets = T.buffers(column)
    assert data.tobytes() == b"cde" and offsets.tolist() == [0, 0, 3, 3]
