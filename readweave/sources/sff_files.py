"""Flowgram files by byte ranges: an index of their records, reads of any part of it, files written by tasks.

A scan reads record headers only and leaves one row for each record with its file and byte range. Reads come from index
rows: tasks get neighbouring ranges of about the same size, so that one large file is many tasks' work, and an index narrowed to
wanted names (by a join, a cluster's members, one bucket of the stored index) reads no other record. Files are
opened where they are through pyarrow's file systems, which executors must reach.
"""

from __future__ import annotations

import struct
import tempfile
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readweave.session import materialize, shuffle_partitions
from readweave.sources import sff

INDEX = "read_id string, file string, at bigint, size bigint, num_bases int, num_flows_per_read int"
#: Bytes between wanted records that are read over rather than skipped, and bytes that one read asks for at most.
GAP, SPAN = 64 << 10, 8 << 20
#: Bytes of a header that are read at once; longer ones are read again.
FIRST = 4096


def _opened(file: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(file if ":" in file else f"file://{file}")


def listed(spark: SparkSession, path: str) -> DataFrame:
    """(file, length) of the files at path, contents unread."""
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "length")


def _header(held: BinaryIO) -> dict:
    first = held.read(FIRST)
    if len(first) < 31:
        raise ValueError("not a flowgram file of version 1")
    length = struct.unpack_from(">H", first, 24)[0]
    return sff.parse_header(first if length <= len(first) else first + held.read(length - len(first)))


def headers(spark: SparkSession, path: str) -> DataFrame:
    """One row a file with what its common header says; nothing else of the file is read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for file in batch.column("file").to_pylist():
                system, place = _opened(file)
                with system.open_input_file(place) as held:
                    rows.append({"file": file} | {k: str(v) if k == "index_offset" else v for k, v in _header(held).items()})
            yield pa.RecordBatch.from_pylist(rows, schema=_HEADERS)

    found = listed(spark, path).select("file").repartition(shuffle_partitions(spark), "file").mapInArrow(run, sff.HEADER_SCHEMA.replace("decimal(20,0)", "string"))
    return found.withColumn("index_offset", F.col("index_offset").cast("decimal(20,0)"))


_HEADERS = pa.schema([("file", pa.string()), ("index_offset", pa.string()), ("index_length", pa.int64()), ("num_reads", pa.int64()), *((c, pa.int32()) for c in ("header_length", "key_length", "num_flows_per_read")), ("flow_chars", pa.string()), ("key_sequence", pa.string())])
_INDEX = pa.schema([("read_id", pa.string()), ("file", pa.string()), ("at", pa.int64()), ("size", pa.int64()), ("num_bases", pa.int32()), ("num_flows_per_read", pa.int32())])


def _records(file: str) -> Iterator[dict]:
    """Index rows of one file, from the headers of its records; what lies between them is skipped."""
    system, place = _opened(file)
    with system.open_input_file(place) as held:
        head = _header(held)
        flows, at = head["num_flows_per_read"], head["header_length"]
        block, start = b"", 0

        def take(a: int, n: int) -> bytes:
            nonlocal block, start
            if a < start or a + n > start + len(block):
                held.seek(a)
                block, start = held.read(max(n, GAP)), a
            if a + n > start + len(block):
                raise ValueError(f"{file} ends within a record")
            return block[a - start : a - start + n]

        for _ in range(head["num_reads"]):
            if head["index_offset"] and at == head["index_offset"]:
                at += head["index_length"] + -head["index_length"] % 8
            length, name, n = struct.unpack(">HHI", take(at, 8))
            read_id = take(at + 16, name).decode()
            body = 2 * flows + 3 * n
            size = length + body + -body % 8
            yield {"read_id": read_id, "file": file, "at": at, "size": size, "num_bases": n, "num_flows_per_read": flows}
            at += size


def scan(spark: SparkSession, path: str) -> DataFrame:
    """(read_id, file, at, size, num_bases, num_flows_per_read): an index row for each record of the files at path, a task a file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column("file").to_pylist():
                rows = []
                for r in _records(file):
                    rows.append(r)
                    if len(rows) == 20000:
                        yield pa.RecordBatch.from_pylist(rows, schema=_INDEX)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema=_INDEX)

    return listed(spark, path).select("file").repartition(shuffle_partitions(spark), "file").mapInArrow(run, INDEX)


def _ranges(rows: list[dict]) -> Iterator[list[dict]]:
    """Rows of one file in order of place, as stretches that are read at once."""
    held: list[dict] = []
    for r in rows:
        if held and (r["at"] - held[-1]["at"] - held[-1]["size"] > GAP or r["at"] + r["size"] - held[0]["at"] > SPAN):
            yield held
            held = []
        held.append(r)
    if held:
        yield held


def read_records(index: DataFrame) -> DataFrame:
    """The reads that index rows name. Rows are dealt by file and place in ranges, so that tasks read neighbouring bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, held = None, None
        try:
            for batch in batches:
                by: dict[str, list[dict]] = {}
                for r in batch.to_pylist():
                    by.setdefault(r["file"], []).append(r)
                for name, rows in by.items():
                    if name != file:
                        if held is not None:
                            held.close()
                        system, place = _opened(name)
                        file, held = name, system.open_input_file(place)
                    for span in _ranges(rows):
                        first = span[0]["at"]
                        held.seek(first)
                        data = held.read(span[-1]["at"] + span[-1]["size"] - first)
                        places = [(r["at"] - first, r["num_flows_per_read"]) for r in span]
                        for k in range(0, len(places), 2000):
                            yield sff.parse_batch(name, data, places[k : k + 2000])
        finally:
            if held is not None:
                held.close()

    rows = index.select("file", "at", "size", "num_flows_per_read")
    dealt = rows.repartitionByRange(shuffle_partitions(index.sparkSession), "file", "at").sortWithinPartitions("file", "at")
    return dealt.mapInArrow(run, sff.READ_SCHEMA)


def read_sff(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> DataFrame:
    """Reads of the files at path; of wanted(read_id), if given, only those records are read."""
    index = materialize(scan(spark, path), "flowgram-index")  # ranges are sampled first; files are scanned once
    return read_records(index if wanted is None else index.join(wanted.select("read_id").distinct(), "read_id", "left_semi"))


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("read_id"), F.lit(buckets)).cast("int")


def write_index(index: DataFrame, path: str, buckets: int = 64) -> None:
    """The index as a table of hash buckets, sorted by name within each; the number of buckets is kept beside it."""
    spark = index.sparkSession
    index.withColumn("bucket", _bucket(buckets)).repartition(buckets, "bucket").sortWithinPartitions("bucket", "read_id").write.partitionBy("bucket").parquet(f"{path}/records")
    spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.parquet(f"{path}/buckets")


def lookup_index(spark: SparkSession, path: str, names: DataFrame) -> DataFrame:
    """Index rows of names(read_id). Names carry their bucket into the join, so that buckets without a name are not read."""
    buckets = spark.read.parquet(f"{path}/buckets").first()[0]
    held = spark.read.schema(f"{INDEX}, bucket int").parquet(f"{path}/records")
    asked = names.select("read_id").distinct().withColumn("bucket", _bucket(buckets))
    return held.join(asked, ["bucket", "read_id"], "left_semi").drop("bucket")


def lookup(spark: SparkSession, path: str, names: DataFrame) -> DataFrame:
    """The reads of names(read_id), from a stored index: their own byte ranges are read and nothing else."""
    return read_records(lookup_index(spark, path, names))


def write_files(reads: DataFrame, folder: str, flow_chars: str, key: str = "TCAG") -> list[str]:
    """A flowgram file for each partition of reads that has rows, in order of the rows; returns their places.

    A task writes its records to a spool of its own and copies that to the folder under a name of its attempt when it ends;
    the driver then gives the files of the attempts that counted their names and drops the rest, so that a task that ran twice
    leaves one file.
    """
    token = uuid.uuid4().hex[:12]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        count = 0
        with tempfile.TemporaryFile() as spool:
            spool.write(sff.header_bytes(0, flow_chars, key))
            for batch in batches:
                for record in sff.batch_bytes(batch, len(flow_chars)):
                    spool.write(record)
                    count += 1
            if not count:
                return
            spool.seek(0)
            spool.write(sff.header_bytes(count, flow_chars, key))
            spool.seek(0)
            system, place = _opened(folder)
            system.create_dir(f"{place}/_{token}", recursive=True)
            name = f"_{token}/{number:05d}-{attempt}.sff"
            with system.open_output_stream(f"{place}/{name}") as out:
                while data := spool.read(1 << 20):
                    out.write(data)
        yield pa.RecordBatch.from_pylist([{"number": number, "name": name, "reads": count}], schema=pa.schema([("number", pa.int32()), ("name", pa.string()), ("reads", pa.int64())]))

    # a row a partition, sorted here: a sort by ranges would sample them, and so write all files twice
    done = sorted(reads.mapInArrow(run, "number int, name string, reads bigint").collect(), key=lambda r: r.number)
    system, place = _opened(folder)
    out = []
    for k, r in enumerate(done):
        system.move(f"{place}/{r.name}", f"{place}/part-{k:05d}.sff")
        out.append(f"{folder.rstrip('/')}/part-{k:05d}.sff")
    if done:
        system.delete_dir(f"{place}/_{token}")
    return out
