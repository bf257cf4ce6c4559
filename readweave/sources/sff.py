"""Standard flowgram format: a reader, a writer, header checks and a read index.

Files are read whole as binary rows, one task a file; records are parsed with struct and come out as Arrow
batches. Damaged files fail the query.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the format.
MAGIC = 0x2E736666
VERSION = b"\x00\x00\x00\x01"
FLOWS = (400, 800, 1400)
_HEADER = ">IIQIIHHHB"
_READ = ">HHIHHHH"

READ_SCHEMA = "file string, read_id string, num_bases int, clip_qual_left int, clip_qual_right int, clip_adapter_left int, clip_adapter_right int, flowgram array<int>, flow_index array<smallint>, bases string, quality array<smallint>"
HEADER_SCHEMA = "file string, index_offset decimal(20,0), index_length bigint, num_reads bigint, header_length int, key_length int, num_flows_per_read int, flow_chars string, key_sequence string"


def parse_header(data: bytes) -> dict:
    magic, version, index_offset, index_length, n, header, key, flows, form = struct.unpack_from(_HEADER, data)
    if magic != MAGIC or struct.pack(">I", version) != VERSION or form != 1:
        raise ValueError("not a flowgram file of version 1")
    at = struct.calcsize(_HEADER)
    return {
        "index_offset": index_offset, "index_length": index_length, "num_reads": n, "header_length": header, "key_length": key, "num_flows_per_read": flows,
        "flow_chars": data[at : at + flows].decode(), "key_sequence": data[at + flows : at + flows + key].decode(),
    }


def parse_read(data: bytes, at: int, flows: int) -> tuple[dict, int]:
    """The record that begins at `at`, and where the next one does."""
    length, name, n, ql, qr, al, ar = struct.unpack_from(_READ, data, at)
    read_id = data[at + 16 : at + 16 + name].decode()
    at += length
    flowgram = struct.unpack_from(f">{flows}H", data, at)
    at += 2 * flows
    flow_index, bases, quality = data[at : at + n], data[at + n : at + 2 * n].decode(), data[at + 2 * n : at + 3 * n]
    at += 3 * n
    at += -(2 * flows + 3 * n) % 8
    row = {
        "read_id": read_id, "num_bases": n, "clip_qual_left": ql, "clip_qual_right": qr, "clip_adapter_left": al, "clip_adapter_right": ar,
        "flowgram": list(flowgram), "flow_index": list(flow_index), "bases": bases, "quality": list(quality),
    }
    return row, at


def _lists(parts: list[bytes], kind: str, to: type) -> pa.Array:
    """A list of numbers for each of parts."""
    values = np.frombuffer(b"".join(parts), kind)
    at = np.concatenate([[0], np.cumsum([len(p) for p in parts])]) // values.itemsize
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values.astype(to)))


def parse_batch(file: str, data: bytes, places: list[tuple[int, int]]) -> pa.RecordBatch:
    """The records that begin at places (place, flows), one or more; numbers are taken as arrays, not one by one."""
    heads, names, flowgram, index, bases, quality = [], [], [], [], [], []
    for at, flows in places:
        length, name, n, *clips = struct.unpack_from(_READ, data, at)
        first = at + length + 2 * flows
        if first + 3 * n > len(data):
            raise ValueError(f"{file} ends within a record")
        heads.append((n, *clips))
        names.append(data[at + 16 : at + 16 + name].decode())
        flowgram.append(data[at + length : first])
        index.append(data[first : first + n])
        bases.append(data[first + n : first + 2 * n].decode())
        quality.append(data[first + 2 * n : first + 3 * n])
    numbers = [pa.array(c, pa.int32()) for c in zip(*heads, strict=True)]
    lists = _lists(flowgram, ">u2", np.int32), _lists(index, "u1", np.int16), _lists(quality, "u1", np.int16)
    return pa.RecordBatch.from_arrays([pa.array([file] * len(places)), pa.array(names), *numbers, lists[0], lists[1], pa.array(bases), lists[2]], schema=_ARROW)


def parse_reads(data: bytes) -> Iterator[dict]:
    head = parse_header(data)
    at, flows = head["header_length"], head["num_flows_per_read"]
    index = range(head["index_offset"], head["index_offset"] + head["index_length"]) if head["index_offset"] else range(0)
    for _ in range(head["num_reads"]):
        if at in index:
            at = index.stop
        row, at = parse_read(data, at, flows)
        yield row


def header_bytes(n: int, flow_chars: str, key: str) -> bytes:
    """The common header of a file of n reads without an index."""
    length = struct.calcsize(_HEADER) + len(flow_chars) + len(key)
    length += -length % 8
    out = struct.pack(_HEADER, MAGIC, int.from_bytes(VERSION, "big"), 0, 0, n, length, len(key), len(flow_chars), 1) + flow_chars.encode() + key.encode()
    return out + bytes(length - len(out))


def read_bytes(r: dict, flows: int) -> bytes:
    """A record of a file with so many flows."""
    name = r["read_id"].encode()
    size = 16 + len(name)
    size += -size % 8
    head = struct.pack(_READ, size, len(name), r["num_bases"], r["clip_qual_left"], r["clip_qual_right"], r["clip_adapter_left"], r["clip_adapter_right"]) + name
    body = struct.pack(f">{flows}H", *r["flowgram"]) + bytes(r["flow_index"]) + r["bases"].encode() + bytes(r["quality"])
    return head + bytes(size - len(head)) + body + bytes(-len(body) % 8)


def _packed(column: pa.Array, kind: str) -> tuple[bytes, list[int]]:
    """All numbers of a column of lists as the format's bytes, and where each list begins and the last one ends."""
    offsets, values = column.offsets.to_numpy(), column.values
    values = values.slice(offsets[0], offsets[-1] - offsets[0])
    if column.null_count or values.null_count:
        raise ValueError("a flowgram record has no nulls")
    held, most = values.to_numpy(zero_copy_only=False), np.iinfo(kind).max
    if len(held) and not 0 <= held.min() <= held.max() <= most:
        raise ValueError(f"a flowgram record's number is not in 0 to {most}")
    return held.astype(kind).tobytes(), ((offsets - offsets[0]) * np.dtype(kind).itemsize).tolist()


def batch_bytes(batch: pa.RecordBatch, flows: int) -> Iterator[bytes]:
    """read_bytes of every row of a batch; its lists are packed for all rows at once."""
    lists = [_packed(batch.column(c), kind) for c, kind in (("flowgram", ">u2"), ("flow_index", "u1"), ("quality", "u1"))]
    plain = batch.select(["read_id", "num_bases", "clip_qual_left", "clip_qual_right", "clip_adapter_left", "clip_adapter_right", "bases"]).to_pylist()
    for i, r in enumerate(plain):
        own = [data[at[i] : at[i + 1]] for data, at in lists]
        if len(own[0]) != 2 * flows:
            raise ValueError(f"read {r['read_id']} has no {flows} flows")
        name = r["read_id"].encode()
        size = 16 + len(name)
        size += -size % 8
        head = struct.pack(_READ, size, len(name), r["num_bases"], r["clip_qual_left"], r["clip_qual_right"], r["clip_adapter_left"], r["clip_adapter_right"]) + name
        body = own[0] + own[1] + r["bases"].encode() + own[2]
        yield head + bytes(size - len(head)) + body + bytes(-len(body) % 8)


def file_bytes(reads: list[dict], flow_chars: str, key: str) -> bytes:
    """A whole file of the reads, without an index."""
    return header_bytes(len(reads), flow_chars, key) + b"".join(read_bytes(r, len(flow_chars)) for r in reads)


def _binary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def read_sff(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> DataFrame:
    """Reads of flowgram files; only those in wanted(read_id), if given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, data in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                held = []
                for r in parse_reads(data):
                    held.append({"file": file} | r)
                    if len(held) == 2000:
                        yield pa.RecordBatch.from_pylist(held, schema=_ARROW)
                        held = []
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=_ARROW)

    out = _binary(spark, path).mapInArrow(run, READ_SCHEMA)
    return out.join(wanted.select("read_id").distinct(), "read_id", "left_semi") if wanted is not None else out


_ARROW = pa.schema(
    [("file", pa.string()), ("read_id", pa.string())]
    + [(c, pa.int32()) for c in ("num_bases", "clip_qual_left", "clip_qual_right", "clip_adapter_left", "clip_adapter_right")]
    + [("flowgram", pa.list_(pa.int32())), ("flow_index", pa.list_(pa.int16())), ("bases", pa.string()), ("quality", pa.list_(pa.int16()))]
)


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """Headers only, one row a file."""
    parse = F.udf(lambda data: tuple(parse_header(bytes(data[:70000])).values()), HEADER_SCHEMA.replace("file string, ", "").replace("decimal(20,0)", "string"))
    rows = _binary(spark, path).select(F.col("path").alias("file"), parse(F.expr("substring(content, 1, 70000)")).alias("h")).select("file", "h.*")
    return rows.withColumn("index_offset", F.col("index_offset").cast("decimal(20,0)"))


def check_headers(headers: DataFrame) -> None:
    """Raise unless every file has a known number of flows and files of one number agree in their headers."""
    rows = headers.groupBy("num_flows_per_read").agg(F.count_distinct("header_length", "key_length", "flow_chars", "key_sequence").alias("n")).collect()
    for r in rows:
        if r[0] not in FLOWS:
            raise ValueError(f"unknown chemistry of {r[0]} flows")
        if r[1] > 1:
            raise ValueError(f"files of {r[0]} flows differ in their headers")


def write_sff(reads: DataFrame, path: str, flow_chars: str, key: str = "TCAG") -> None:
    """One flowgram file for each partition of reads, as binary rows (content) of a Parquet table at path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in b.to_pylist()]
        if rows:
            yield pa.RecordBatch.from_pylist([{"content": file_bytes(rows, flow_chars, key)}], schema=pa.schema([("content", pa.binary())]))

    reads.mapInArrow(run, "content binary").write.parquet(path)


def write_index(reads: DataFrame, table: str, buckets: int = 16) -> None:
    """A bucketed, sorted table of the reads, for lookups by name without a shuffle of the reads."""
    reads.write.bucketBy(buckets, "read_id").sortBy("read_id").saveAsTable(table)


def lookup(spark: SparkSession, table: str, names: DataFrame) -> DataFrame:
    """The reads of an indexed table that names(read_id) asks for."""
    return spark.table(table).join(names.select("read_id").distinct(), "read_id", "left_semi")


def trimmed(reads: DataFrame) -> DataFrame:
    """(read_id, seq, qual): bases between the clip points, lower case where masked by them is not kept."""
    left = F.greatest(F.lit(1), "clip_qual_left", "clip_adapter_left")
    ends = F.least(*(F.when(F.col(c) > 0, F.col(c)).otherwise(F.col("num_bases")) for c in ("clip_qual_right", "clip_adapter_right")))
    size = F.greatest(ends - left + 1, F.lit(0))
    return reads.select("read_id", F.substring("bases", left, size).alias("seq"), F.slice("quality", left, size).cast("array<int>").alias("qual"))
