"""The queries that apply each operator of this subpackage to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readweave.llm import alignment, chat, decontaminate, fingerprints, jaccard, licenses, lm_scoring, packing, periodic, quality, secrets, simhash, token_counts


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(n: int):
    """crc32 of doc_id as text (null: empty) modulo n."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % n


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"), remainder(7) == 2)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op3_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rendering, its mask as text start-end,start-end so that rows compare by value."""
    spans = F.array_join(F.transform("mask", lambda m: F.concat_ws("-", m["start"].cast("string"), m["end"].cast("string"))), ",")
    return chat.rotate(table(spark, sf_dir, "conversations")).withColumn("mask", spans)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.where(remainder(3) != 1))
    return quality.score(docs, model).select(
        "doc_id", (remainder(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_passages(docs, table(spark, sf_dir, "benchmark"), passed=["doc_id"])
    return decontaminate.digest(found)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return alignment.aligned(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of the documents' words, a tenth of the documents made periodic first."""
    return periodic.digest(periodic.periodic_runs(periodic.planted(table(spark, sf_dir, "documents"))))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_token_counts": op2_token_counts,
    "op3_chat_rotation": op3_chat_rotation,
    "op4_quality": op4_quality,
    "op5_fingerprints": op5_fingerprints,
    "op6_simhash": op6_simhash,
    "op7_licenses": op7_licenses,
    "op8_secrets": op8_secrets,
    "op9_decontamination": op9_decontamination,
    "op10_packing": op10_packing,
    "op11_alignment": op11_alignment,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_jaccard_join": op13_jaccard_join,
}

_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES: dict[str, str] = {
    "op3_chat_rotation": f"""WITH turns AS (SELECT conv_id, CAST(coalesce(floor(turn / {chat.PART_TURNS}.0), -1) AS BIGINT) AS part, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
  cuts AS (SELECT *, CAST((row_number() OVER (PARTITION BY conv_id, part ORDER BY turn, role, text) - 1) // {chat.PART_TURNS} AS BIGINT) AS cut FROM turns),
  speakers AS (SELECT DISTINCT conv_id, role AS perspective FROM turns WHERE role <> 'system'),
  seg AS (SELECT t.conv_id, s.perspective, t.part, t.cut, t.turn, t.role, t.text, role = perspective AS own, text || '<|im_end|>' || chr(10) AS body,
    '<|im_start|>' || CASE WHEN role = 'system' THEN 'system' WHEN role = perspective THEN 'assistant' ELSE 'user name=' || role END || chr(10) AS head FROM cuts t JOIN speakers s ON t.conv_id IS NOT DISTINCT FROM s.conv_id),
  placed AS (SELECT *, row_number() OVER w AS rn, sum(length(head) + length(body)) OVER w AS ending FROM seg WINDOW w AS (PARTITION BY conv_id, perspective, part, cut ORDER BY turn, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
  SELECT conv_id, perspective, part, cut, count(*) AS n_turns, CAST(sum(length(head) + length(body)) AS BIGINT) AS n_chars, string_agg(head || body, '' ORDER BY rn) AS text,
    coalesce(string_agg(CASE WHEN own THEN CAST(CAST(ending - length(body) AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(ending AS BIGINT) AS VARCHAR) END, ',' ORDER BY rn), '') AS mask FROM placed GROUP BY conv_id, perspective, part, cut""",
    "op9_decontamination": f"""WITH b AS (SELECT CAST(item_id AS VARCHAR) AS id, {_WORDS} AS w FROM benchmark),
  bw AS (SELECT id, len(w) AS n, w, unnest(range(0, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0),
  win AS (SELECT DISTINCT id, least(n, 10) AS l, array_to_string(w[i + 1 : i + least(n, 10)], ' ') AS s FROM bw), lens AS (SELECT DISTINCT l FROM win),
  d AS (SELECT doc_id, {_WORDS} AS w FROM documents), dp AS (SELECT doc_id, l, w, unnest(range(0, len(w) - l + 1)) AS i FROM d, lens WHERE len(w) >= l),
  ds AS (SELECT doc_id, i, l, array_to_string(w[i + 1 : i + l], ' ') AS s FROM dp), occ AS (SELECT doc_id, i, l, id FROM ds JOIN win USING (l, s)),
  hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + l)) AS p FROM occ) GROUP BY doc_id),
  it AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, id FROM occ) GROUP BY doc_id)
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
  FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)""",
}
