"""Reads, alleles, clusters and graphs derived from the general tables, so that operators can run on them.

Each view is a DataFrame here and the same rows in SQL below. All rows and whole texts are used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readweave.operators.kmers import bytes_of, sharing_reads, steps

LETTERS = "abcdefghijklmnopqrstuvwxyz"
BASES = ("ACGT" * 7)[:26]


_BASE = np.zeros(256, np.uint8)
for _x, _y in zip(LETTERS, BASES, strict=True):
    _BASE[ord(_x)] = _BASE[ord(_x.upper())] = ord(_y)


def bases(column: pa.Array) -> pa.Array:
    """The letters a to z of each text, in either case, as bases. Two other characters have such a letter in lower case."""
    for wide, plain in (("\u0130", "i"), ("\u212a", "k")):
        column = pc.replace_substring(column, wide, plain)
    data, at = bytes_of(column)
    made = _BASE[data]
    kept = made > 0
    to = np.append(0, np.cumsum(kept))[at]
    seq = pa.Array.from_buffers(pa.large_string(), len(column), [None, pa.py_buffer(to.astype(np.int64)), pa.py_buffer(made[kept])])
    return pc.if_else(pc.is_valid(column), seq, None).cast(pa.string())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A read for each document: its letters a to z as bases; run by source, individual by language."""
    docs = table(spark, sf_dir, "documents")
    number = F.regexp_extract("source", "[0-9]+", 0).cast("long")
    texts = docs.select(F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("read_id"), F.col("source").alias("run_id"), number.alias("run_seq"), F.col("lang").alias("individual"), F.col("text").cast("string").alias("seq"), F.col("doc_id").alias("ord"))
    names = texts.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches):
            yield pa.RecordBatch.from_arrays([bases(part.column(c)) if c == "seq" else part.column(c) for c in names], names)

    return texts.mapInArrow(run, texts.schema)


READS = f"""reads AS (SELECT 'doc_' || doc_id AS read_id, source AS run_id, CAST(regexp_extract(source, '[0-9]+') AS BIGINT) AS run_seq, lang AS individual,
  translate(regexp_replace(lower(text), '[^a-z]', '', 'g'), '{LETTERS}', '{BASES}') AS seq, doc_id AS ord FROM documents)"""


def qualities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(read_id, qual_ascii, ord): a made-up quality character for each base of a read."""
    return reads(spark, sf_dir).select("read_id", F.translate("seq", "ACGT", "BJR^").alias("qual_ascii"), "ord")


def alleles(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    base = F.substring(F.lit("ACGT"), (F.col("l_suppkey") % 4 + 1).cast("int"), F.lit(1))
    return items.select(F.col("l_partkey").alias("contig_id"), F.col("l_linenumber").alias("pos"), F.col("l_returnflag").alias("individual"), base.alias("base"), F.floor("l_quantity").cast("int").alias("quality"), F.concat_ws("_", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("read_id"))


ALLELES = """alleles AS (SELECT l_partkey AS contig_id, l_linenumber AS pos, l_returnflag AS individual, substr('ACGT', CAST(l_suppkey % 4 AS INTEGER) + 1, 1) AS base,
  CAST(floor(l_quantity) AS INTEGER) AS quality FROM lineitem)"""


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("cluster"), F.col("l_suppkey").alias("read_id"), F.col("l_returnflag").alias("individual")).distinct()


MEMBERS = "members AS (SELECT DISTINCT l_orderkey AS cluster, l_suppkey AS read_id, l_returnflag AS individual FROM lineitem)"


def diffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    letter = lambda c: F.substring(F.lit("ACGT"), (F.col(c) % 4 + 1).cast("int"), F.lit(1))
    each = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("cluster"), (F.floor("l_extendedprice") % 400).cast("int").alias("position"), letter("l_partkey").alias("reference"), letter("l_suppkey").alias("target"), F.floor("l_quantity").cast("long").alias("reads"))
    return each.where("reference <> target").groupBy("cluster", "position", "reference", "target").agg(F.sum("reads").alias("reads"))


DIFFS = """diffs AS (SELECT cluster, position, reference, target, CAST(sum(reads) AS BIGINT) AS reads FROM (SELECT l_orderkey AS cluster, CAST(CAST(floor(l_extendedprice) AS BIGINT) % 400 AS INTEGER) AS position,
  substr('ACGT', CAST(l_partkey % 4 AS INTEGER) + 1, 1) AS reference, substr('ACGT', CAST(l_suppkey % 4 AS INTEGER) + 1, 1) AS target, CAST(floor(l_quantity) AS BIGINT) AS reads FROM lineitem)
  WHERE reference <> target GROUP BY ALL)"""


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment blocks: a line item's part against its supplier, with aligned texts from its keys."""
    items = table(spark, sf_dir, "lineitem")
    text = lambda c: F.translate(F.lpad(F.col(c).cast("string"), 12, "0"), "0123456789", "ACGTACGTN-")
    return items.select(
        F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("name1"), F.floor("l_quantity").cast("int").alias("s1"), F.lit(12).alias("o1"), text("l_partkey").alias("aln1"),
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("name2"), F.col("l_linenumber").alias("s2"), F.lit(12).alias("o2"), text("l_orderkey").alias("aln2"),
    )


BLOCKS = """blocks AS (SELECT 'p' || l_partkey AS name1, CAST(floor(l_quantity) AS INTEGER) AS s1, 12 AS o1, translate(lpad(CAST(l_partkey AS VARCHAR), 12, '0'), '0123456789', 'ACGTACGTN-') AS aln1,
  's' || l_suppkey AS name2, l_linenumber AS s2, 12 AS o2, translate(lpad(CAST(l_orderkey AS VARCHAR), 12, '0'), '0123456789', 'ACGTACGTN-') AS aln2 FROM lineitem)"""


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse graph: every order and its customer, by name."""
    name = lambda c, letter: F.concat(F.lit(letter), F.col(c).cast("string"))
    return table(spark, sf_dir, "orders").select(name("o_custkey", "c").alias("src"), name("o_orderkey", "o").alias("dst")).distinct()


EDGES = "edges AS (SELECT DISTINCT 'c' || o_custkey AS src, 'o' || o_orderkey AS dst FROM orders)"


def dense_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense graph: every order's customer and each of its parts, by name."""
    orders, items = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    return orders.join(items, orders.o_orderkey == items.l_orderkey).select(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("src"), F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("dst")).distinct()


DENSE = "edges AS (SELECT DISTINCT 'c' || o_custkey AS src, 'p' || l_partkey AS dst FROM orders JOIN lineitem ON o_orderkey = l_orderkey)"



def rare_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse graph with chains, cycles and cliques: reads that share a word of 31 bases which two to five reads have."""
    return sharing_reads(reads(spark, sf_dir), 31, 2, 5)


RARE = f"""{READS}, spots AS (SELECT read_id, seq, unnest(range(0, length(seq) - 30)) AS i FROM reads WHERE length(seq) >= 31), words AS (SELECT DISTINCT read_id, substr(seq, i + 1, 31) AS word FROM spots),
  rare AS (SELECT word FROM words GROUP BY word HAVING count(*) BETWEEN 2 AND 5), held AS (SELECT * FROM words JOIN rare USING (word)),
  edges AS (SELECT DISTINCT x.read_id AS src, y.read_id AS dst FROM held x JOIN held y ON x.word = y.word AND x.read_id > y.read_id)"""

#: Least names walk along the edges until none changes; one row for each node is kept.
WALKED = """both_ways AS (SELECT src AS a, dst AS b FROM edges UNION SELECT dst, src FROM edges),
  labels(node, component) USING KEY (node) AS (SELECT DISTINCT a, a FROM both_ways UNION
    SELECT e.b, min(l.component) FROM labels l JOIN both_ways e ON l.node = e.a JOIN recurring.labels r ON r.node = e.b WHERE l.component < r.component GROUP BY e.b)"""

COMPONENTS = """both_ways AS (SELECT src AS a, dst AS b FROM edges UNION SELECT dst, src FROM edges),
  reach(node, root) AS (SELECT a, a FROM both_ways UNION SELECT b, root FROM reach JOIN both_ways ON node = a),
  labels AS (SELECT node, min(root) AS component FROM reach GROUP BY node)"""
