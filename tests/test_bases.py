"""Reads are made of texts in one pass over their bytes."""

from pyspark.sql import functions as F

from readweave.plans import views as V


def test_letters_become_bases_as_in_column_functions(spark, tmp_path):
    texts = ["Hello, World! z", "", None, "é ü 中 ABCxyz", "İstanbul Kelvin Å ſ", "12 34", "a\nb\tc", "ÀZ" * 50_000]
    docs = spark.createDataFrame([(k, t, "en", f"src{k % 3}" if k else None) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    plain = F.translate(F.regexp_replace(F.lower("text"), "[^a-z]", ""), V.LETTERS, V.BASES)
    want = {r.doc_id: r.seq for r in docs.select("doc_id", plain.alias("seq")).collect()}
    got = V.reads(spark, str(tmp_path))
    assert {r.ord: r.seq for r in got.collect()} == want and want[7] == V.BASES[25] * 50_000
    assert got.columns == ["read_id", "run_id", "run_seq", "individual", "seq", "ord"]
    # a letter at a time in column functions took most of the time of queries over reads (F10, F12)
    assert "translate" not in got._jdf.queryExecution().optimizedPlan().toString()
