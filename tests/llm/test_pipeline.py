"""The pipeline's stages in a row, against what each operator decides on its own input, and planted documents."""

import random
import re

import corpus_pipeline
import pytest

WORDS = "stone river house walks under light green table music paper winter garden bridge silver window"


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rng = random.Random(12)
    vocabulary = [a + b for a in WORDS.split() for b in ("", "s", "ing", "er", "ly")]
    clean = [" ".join(rng.choices(vocabulary, k=rng.randrange(60, 200))) + "." for _ in range(120)]
    junk = [" ".join(w.upper() + "!!" for w in rng.choices(vocabulary, k=80)) for _ in range(40)]
    item = " ".join(rng.choices(vocabulary, k=25))
    texts = [*clean, *junk]
    leaks = len(texts)
    texts += [clean[k] + " " + item + " " + clean[k + 1] for k in range(50, 53)]
    copies = len(texts)
    texts += [clean[0], clean[0], clean[1]]
    secret = len(texts)
    texts += [" ".join(rng.choices(vocabulary, k=80)) + ' token = "0123456789abcdef0123456789abcdef01234567" ' + " ".join(rng.choices(vocabulary, k=80))]
    path = str(tmp_path_factory.mktemp("sf"))
    docs = [(k, t, "en", f"src{k % 3}", len(t)) for k, t in enumerate(texts)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(k, int(k < 120), 0) for k in range(0, 160, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(0, item), (1, "nothing like it " * 5)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, texts, {"leaks": leaks, "copies": copies, "secret": secret}


def test_stages(spark, sf_dir):
    path, texts, at = sf_dir
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, held = docs.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, path)
        if k < 4:
            assert docs.columns == columns
            docs = corpus_pipeline.materialize(docs, "test")
            held.append({r.doc_id: r.text for r in docs.collect()})
    quality, dedup, leaks, secrets = held
    assert set(quality) == set(range(len(texts))) - set(range(120, 160))
    assert set(dedup) == set(quality) - {at["copies"], at["copies"] + 1, at["copies"] + 2}
    assert set(leaks) == set(dedup) - set(range(at["leaks"], at["leaks"] + 3))
    assert set(secrets) == set(leaks)
    assert {k for k in secrets if secrets[k] != leaks[k]} == {at["secret"]}
    assert not re.search("[0-9a-f]{24}", secrets[at["secret"]])
    pieces = docs.collect()
    assert {r.doc_id for r in pieces} == set(secrets)
    assert sorted(map(tuple, pieces), key=lambda r: (r[0], r[1]))[0][:2] == (0, 0)
    run = corpus_pipeline.run(spark, path)
    what = lambda rows: sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert what(run.collect()) == what(pieces)


def test_one_of_each_similar_group_stays(spark):
    """Against brute force over five-word shingles: texts far more than 3 bits apart, chains, copies, repeated and missing ids."""
    rng = random.Random(4)
    base = [[rng.choice(WORDS.split()) + str(rng.randrange(99)) for _ in range(rng.randrange(40, 300))] for _ in range(15)]
    texts = [" ".join(w) for w in base]
    for w in base:
        for _ in range(6):
            v, cut = list(w), rng.randrange(1, len(w) // 12)
            at = rng.randrange(len(v) - cut)
            v[at : at + cut] = [f"new{rng.randrange(10**6)}" for _ in range(cut)]
            texts.append(" ".join(v if rng.random() < 0.7 else v[cut:]))
    texts += [texts[0], texts[20].upper(), "a b", "a b", "", None, "a b c d e"]
    rows = [(None if k % 17 == 5 else k - k % 2 if k % 23 == 9 else k, t) for k, t in enumerate(rng.sample(texts, len(texts)))]
    sets = []
    for _, t in rows:
        w = (t or "").lower().split()
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    label = list(range(len(rows)))
    similar = [[i == j or sets[i] == sets[j] or len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9 for j in range(len(rows))] for i in range(len(rows))]
    while (new := [min(label[j] for j in range(len(rows)) if similar[i][j]) for i in range(len(rows))]) != label:
        label = new
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    kept = corpus_pipeline.dedup_stage(spark, docs, "").collect()
    at = [next(i for i, r in enumerate(rows) if r == (k.doc_id, k.text)) for k in kept]
    assert sorted(label[i] for i in at) == sorted(set(label)) and len(set(label)) < len(rows) // 2
    for i in at:
        ids = [rows[j][0] for j in range(len(rows)) if label[j] == label[i] and rows[j][0] is not None]
        assert rows[i][0] == min(ids, default=None)


def test_queries_of_the_subpackage(spark):
    """Every registered query runs on the smallest tables and gives a row for each document it should."""
    from readweave.llm import queries

    sf = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    each = {"op2_token_counts", "op4_quality", "op5_fingerprints", "op6_simhash", "op8_secrets", "op9_decontamination"}
    for name, query in queries.QUERIES.items():
        if name != "op1_lm_scoring":
            got = query(spark, sf)
            assert got.count() == n if name in each else got.count() > 0, name
    assert queries.op4_quality(spark, sf).columns == ["doc_id", "held_out", "score", "predicted"]
    assert queries.op6_simhash(spark, sf).columns == ["doc_id", "fingerprint", "component_id"]
