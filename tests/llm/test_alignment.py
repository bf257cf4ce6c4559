"""The alignment against whole texts encoded by the two libraries themselves."""

import collections
import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from readweave.llm import alignment

FIRST, SECOND = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
DOC = "doc_id long, text string, k string, sid string, segment string, frequent string, n string, links string"


def byte_of():
    """The characters of byte-level vocabularies: printable bytes stand for themselves, the others follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


@pytest.fixture(scope="module")
def encode():
    one, two, of = Tokenizer.from_file(FIRST), sentencepiece.SentencePieceProcessor(model_file=SECOND), byte_of()
    one.encode_special_tokens = True

    def run(text):
        whole = (" " + text).encode() if text else b""
        a, b = one.encode(" " + text, add_special_tokens=False).ids if text else [], two.encode(text) if text else []
        ta = [bytes(of[c] for c in one.id_to_token(k)) for k in a]
        tb = [bytes([int(p[3:5], 16)]) if two.is_byte(k) else p.replace("▁", " ").encode() for k, p in ((k, two.id_to_piece(k)) for k in b)]
        return (a, ta, b, tb) if b"".join(ta) == whole == b"".join(tb) else ([], [], [], [])

    return run


def ends(tokens):
    at, out = 0, []
    for t in tokens:
        at += len(t)
        out.append(at)
    return out


def expected(rows, encode):
    grouped = []
    for _, text in rows:
        a, ta, b, tb = encode(text)
        ea, eb = ends(ta), ends(tb)
        groups, i, j = [], 0, 0
        for cut in sorted(set(ea) & set(eb)):
            i1, j1 = ea.index(cut, i) + 1, eb.index(cut, j) + 1
            groups.append((a[i:i1], b[j:j1]))
            i, j = i1, j1
        grouped.append(groups)
    links = [[(x, y) for xs, ys in groups for x in xs for y in ys] for groups in grouped]
    count = collections.Counter(p for own in links for p in set(own))
    best = {}
    for (x, _), n in count.items():
        best[x] = max(n, best.get(x, 0))
    for (doc_id, _), groups, own in zip(rows, grouped, links, strict=True):
        text = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in groups)
        yield (doc_id, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(own), sum(count[p] == best[p[0]] for p in own), sum(count[p] for p in own), hashlib.sha256(text.encode()).hexdigest() if groups else "")


ODD = ["", None, " ", "  ", "a", " a", "a ", "a  b", "a\n b", "a \n b", "\n", "\t\tx  ", "don't  stop 's 'll", "x<|endoftext|>y <s> </s> <unk>", "▁", "a ▁ b", "é ß 日本語 テスト　全角 １２", "     x", "a​ b‍ c", "\x00 \x01", "🙂 🙂🙂 é́", "<0x41> A", "....   ...,, -- ", "a  b\x85 c\x1c d", " " * 50 + "x", "ᚠ ᚡ  ᚢ"]


def test_matches_the_libraries(spark, encode):
    rng = random.Random(3)
    words = ["the", "Thing", "of", "don't", "x1y2", "nation-wide", "2024", "été", "über", "日本", "🙂", "...", "(a)", "\n", "\t", " ", "a b", "supercalifragilistic", "▂", "=="]
    texts = [*ODD, *ODD[:9], *("".join(rng.choice(words) + rng.choice([" ", " ", " ", "", "\n", "  "]) for _ in range(rng.randrange(1, 60))) for _ in range(150)), "word another third. " * 3000]
    rows = [(None if k == 30 else k // 2 if k % 9 == 4 else k, t) for k, t in enumerate(texts)]
    made = spark.createDataFrame([(*r, *"abcdef") for r in rows], DOC).repartition(3)
    for frequent in (alignment.FREQUENT_BYTES, 600):
        old = alignment.FREQUENT_BYTES, alignment.FREQUENT_PAIRS
        alignment.FREQUENT_BYTES = frequent
        alignment.FREQUENT_PAIRS = old[1] if frequent == old[0] else 50
        try:
            got = alignment.aligned(made, FIRST, SECOND).collect()
        finally:
            alignment.FREQUENT_BYTES, alignment.FREQUENT_PAIRS = old
        assert sorted(map(tuple, got), key=str) == sorted(expected(rows, encode), key=str)


def test_segments_are_encoded_as_in_their_text(encode):
    """Any text of odd signs falls into segments whose tokens in a row are the text's."""
    import regex

    rng = random.Random(11)
    signs = "aZé0,.'!\n\t   　▂日🙂́‍_-Ⅷ½$ "
    cut = regex.compile(r"(?<=[\p{L}\p{N}\p{P}\p{S}])(?= )")
    for _ in range(3000):
        text = "".join(rng.choice(signs) if rng.random() < 0.7 else " " for _ in range(rng.randrange(1, 40)))
        a, _, b, _ = encode(text)
        parts = cut.split(" " + text)
        xs, ys, _, _, ok = alignment.tokenized(parts, FIRST, SECOND)
        assert all(ok) and [k for x in xs for k in x] == a and [k for y in ys for k in y] == b


def test_no_rows(spark):
    assert alignment.aligned(spark.createDataFrame([], DOC), FIRST, SECOND).count() == 0


def test_query_on_whole_table(spark, encode):
    from readweave.llm import queries

    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = queries.op11_alignment(spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(tuple, got)) == sorted(expected(rows, encode))
