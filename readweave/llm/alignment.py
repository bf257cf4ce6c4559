"""Cross-tokenizer alignment: where two tokenizers' tokens end together, by Spark relations.

Tokens are exploded with their places, their byte lengths summed up in windows, both sides joined on equal ends; the
running count of these cuts names the groups, whose token ranges give the links. No token of either vocabulary reaches over
a space that follows a visible sign, so texts are cut there into segments first, and the relations are built once for
each distinct segment, not for each of its occurrences. A text's groups are those of its segments, one after another.

Segments that are frequent for their length make a table of bounded size that is broadcast, since only so many can be;
rarer ones meet in joins in which no key has more than a bounded share of the rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from readweave.session import materialize, shuffle_partitions

#: Bytes of all frequent segments together: one is frequent if its occurrences times this are at least the bytes of all texts.
FREQUENT_BYTES = 1 << 24
#: The same for pairs of ids and the links of all documents.
FREQUENT_PAIRS = 1 << 19
#: Ids of the second tokenizer are below this, so that a pair of ids is one int.
SECOND = 1 << 15
#: A space after a letter, number, mark of punctuation or symbol.
CUT = r"(?<=[\\p{L}\\p{N}\\p{P}\\p{S}])(?= )"


@cache
def _tables(first: str, second: str) -> tuple:
    """The two tokenizers and the byte length of each of their tokens; loaded once a worker."""
    import sentencepiece
    from tokenizers import Tokenizer

    one = Tokenizer.from_file(first)
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=second)
    # byte-level vocabularies write each byte as one character
    lengths = [0] * one.get_vocab_size()
    for token, k in one.get_vocab().items():
        lengths[k] = len(token)
    pieces = [two.id_to_piece(k) for k in range(two.get_piece_size())]
    if any("▁" in p.lstrip("▁") for p in pieces) or len(pieces) > SECOND:
        raise ValueError("pieces of the second tokenizer must begin at spaces and number at most SECOND")
    bytes_of = [bytes([int(p[3:5], 16)]) if two.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)]
    return one, two, lengths, bytes_of


def tokenized(segments: Sequence[str], first: str, second: str) -> tuple[list, list, list, list, list]:
    """Ids and byte lengths of both tokenizers' tokens for segments that begin with a space; whether the bytes agree."""
    one, two, lengths, bytes_of = _tables(first, second)
    a = [x.ids for x in one.encode_batch(list(segments), add_special_tokens=False)]
    # a sign before the segment keeps its leading spaces together; its own piece comes first and goes
    b = [x[1:] for x in two.encode(["a" + s for s in segments])]
    ok = [b"".join(bytes_of[k] for k in x) == s.encode() for x, s in zip(b, segments, strict=True)]
    return a, b, [[lengths[k] for k in x] for x in a], [[len(bytes_of[k]) for k in x] for x in b], ok


@contextmanager
def _partitioned_by_fewer(spark: SparkSession) -> Iterator[None]:
    """Joins may use a partitioning by some of their keys: what is dealt by segment stays where it is."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _ends(tokens: DataFrame, side: str) -> DataFrame:
    """(sid, end, place): how many bytes of its segment each token and those before it have."""
    w = Window.partitionBy("sid").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    each = tokens.select("sid", F.posexplode(f"l{side}").alias("i", "n"))
    return each.select("sid", F.sum("n").over(w).alias("end"), (F.col("i") + 1).alias(side))


def _groups(tokens: DataFrame) -> DataFrame:
    """(sid, a0, a1, b0, b1, g): the token ranges between neighbouring cuts, numbered by the running count of cuts."""
    cuts = _ends(tokens, "a").join(_ends(tokens, "b"), ["sid", "end"])
    w = Window.partitionBy("sid").orderBy("end")
    before = lambda c: F.coalesce(F.lag(c).over(w), F.lit(0))
    return cuts.select("sid", F.row_number().over(w).alias("g"), before("a").alias("a0"), F.col("a").alias("a1"), before("b").alias("b0"), F.col("b").alias("b1"))


def segment_groups(segments: DataFrame, first: str, second: str) -> DataFrame:
    """(sid, segment, frequent, ok, n_a, n_b, n_groups, text, links) of distinct segments (sid, segment, frequent).

    text: the groups written out; links: a pair of ids for each pair of tokens that share a group.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 2048):
                batch = whole.slice(start, 2048)
                made = tokenized(batch.column("segment").to_pylist(), first, second)
                kinds = [pa.list_(pa.int32())] * 4 + [pa.bool_()]
                yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(x, t) for x, t in zip(made, kinds, strict=True))], [*batch.schema.names, "a", "b", "la", "lb", "ok"])

    spark = segments.sparkSession
    made = segments.select("sid", "segment", "frequent").mapInArrow(run, "sid long, segment string, frequent boolean, a array<int>, b array<int>, la array<int>, lb array<int>, ok boolean")
    tokens = materialize(made, "segment-tokens")
    dealt = tokens.repartition(shuffle_partitions(spark), "sid")
    with _partitioned_by_fewer(spark):
        groups = _groups(dealt.where("ok").select("sid", "la", "lb")).groupBy("sid").agg(F.array_sort(F.collect_list(F.struct("g", "a0", "a1", "b0", "b1"))).alias("gs"))
        joined = dealt.select("sid", "segment", "frequent", "ok", "a", "b").join(groups, "sid", "left")
        of = lambda side, g: F.slice(side, g[side + "0"] + 1, g[side + "1"] - g[side + "0"])
        listed = lambda side, g: F.array_join(of(side, g).cast("array<string>"), ",")
        written = F.array_join(F.transform("gs", lambda g: F.concat(listed("a", g), F.lit("|"), listed("b", g))), ";")
        linked = lambda g: F.flatten(F.transform(of("a", g), lambda x: F.transform(of("b", g), lambda y: x * SECOND + y)))
        links = F.flatten(F.transform("gs", linked))
        return materialize(joined.select("sid", "segment", "frequent", "ok", F.size("a").alias("n_a"), F.size("b").alias("n_b"), F.size("gs").alias("n_groups"), written.alias("text"), links.alias("links")), "segment-groups")


def aligned(docs: DataFrame, first: str, second: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256): one row for each row of docs.

    first and second: files of a byte-level tokenizer and of a sentencepiece model. Each whole text, with a space before it, is encoded by
    both; byte offsets at which tokens of both end cut them into groups, and every pair of tokens of one group is a
    link. A pair of ids counts how many rows of docs hold it linked; n_best: links whose count is the highest of those
    with their first id; count_sum: counts over links. Null and empty texts, and texts that the second tokenizer does
    not give back byte for byte (U+2581 in them), have zeros and ''. Repeated rows and ids are rows of their own; a row without an id
    keeps null; other columns are not looked at; no rows give no rows.
    """
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    named = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).withColumn("k", F.monotonically_increasing_id())
    full = named.where("text <> ''").select("k", "doc_id", F.concat(F.lit(" "), "text").alias("text"))
    split = F.expr(f"split(text, '{CUT}', -1)")

    counted = full.select(F.explode(split).alias("segment")).groupBy("segment").agg(F.count(F.lit(1)).alias("n"))
    counted = materialize(counted.withColumn("sid", F.monotonically_increasing_id()), "segments")
    size = counted.agg(F.sum(F.col("n") * F.octet_length("segment"))).first()[0] or 0
    known = segment_groups(counted.select("sid", "segment", (F.col("n") * FREQUENT_BYTES >= size).alias("frequent")), first, second)

    fields = ["sid", "ok", "n_a", "n_b", "n_groups", "text", "links"]
    held = known.select("segment", "frequent", F.struct(*fields).alias("s"))
    words = full.repartition(parts, "k").select("k", "doc_id", F.posexplode(split).alias("i", "segment"))
    joined = words.join(F.broadcast(held.where("frequent").drop("frequent")), "segment", "left")
    item = F.struct("i", F.col("s.text").alias("text"))
    summed = [F.min("s.ok").alias("ok"), *(F.sum(f"s.{c}").alias(c) for c in ("n_a", "n_b", "n_groups")), F.sum(F.size("s.links")).alias("n_links"), F.collect_list(item).alias("items"), F.collect_list("s.links").alias("links"), F.collect_list("s.sid").alias("sids")]
    by = lambda rows: rows.groupBy("k", "doc_id").agg(*summed)
    often = by(joined.where("s is not null"))
    seldom = by(joined.where("s is null").select("k", "doc_id", "i", "segment").join(held.where("not frequent").drop("frequent"), "segment"))
    suffixed = lambda rows, to: rows.withColumnsRenamed({c: c + to for c in rows.columns if c != "k"})
    merged = suffixed(often, "1").join(suffixed(seldom, "2"), "k", "full_outer")
    # a text with a segment that is not given back has no tokens
    ok = F.coalesce("ok1", F.lit(True)) & F.coalesce("ok2", F.lit(True))
    total = lambda c: F.when(ok, F.coalesce(f"{c}1", F.lit(0)) + F.coalesce(f"{c}2", F.lit(0))).otherwise(0).cast("bigint")

    def whole(c: str) -> Column:
        none = F.array().cast(often.schema[c].dataType)
        return F.when(ok, F.concat(F.coalesce(f"{c}1", none), F.coalesce(f"{c}2", none))).otherwise(none)

    text = F.array_join(F.transform(F.array_sort(whole("items")), lambda x: x["text"]), ";")
    merged = merged.select(
        "k", F.coalesce("doc_id1", "doc_id2").alias("doc_id"), *(total(c).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links")),
        F.when(ok, F.sha2(text, 256)).otherwise("").alias("groups_sha256"), F.array_distinct(F.flatten(whole("links"))).alias("pairs"), whole("sids").alias("sids"),
    )
    found = materialize(merged, "aligned")

    counts = materialize(found.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")), "pair-counts")
    best = counts.groupBy(F.expr(f"pair div {SECOND}").alias("a")).agg(F.max("n").alias("most"))
    total_pairs = counts.agg(F.sum("n")).first()[0] or 0
    counts = materialize(counts.join(best, F.expr(f"pair div {SECOND}") == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).cast("long").alias("best")), "pair-best")
    common = F.col("n") * FREQUENT_PAIRS >= total_pairs
    links = known.select("sid", F.explode("links").alias("pair")).join(F.broadcast(counts.where(common)), "pair", "left")
    rest = links.where("n is null").select("sid", "pair").join(counts.where(~common), "pair").select("sid", "n", "best")
    scores = links.where("n is not null").select("sid", "n", "best").unionAll(rest).groupBy("sid").agg(F.sum("n").alias("count_sum"), F.sum("best").alias("n_best"))
    scores = materialize(scores.join(known.select("sid", "frequent"), "sid"), "segment-scores")

    own = found.select("k", F.explode("sids").alias("sid")).join(F.broadcast(scores.where("frequent").drop("frequent")), "sid", "left")
    rest = own.where("n_best is null").select("k", "sid").join(scores.where("not frequent").drop("frequent"), "sid")
    sums = own.where("n_best is not null").select("k", "n_best", "count_sum").unionAll(rest.select("k", "n_best", "count_sum")).groupBy("k").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    scores = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("n_best", "count_sum")]
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    out = found.drop("pairs", "sids").join(sums, "k", "left").select(*columns[:5], *scores, "groups_sha256")
    none = named.where("coalesce(text, '') = ''").select("doc_id", *(F.lit(0).cast("bigint").alias(c) for c in columns[1:-1]), F.lit("").alias("groups_sha256"))
    return out.unionAll(none)
