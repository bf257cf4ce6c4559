"""Flowgram files by byte ranges: index, narrowed reads, buckets, files of several tasks, round trips."""

import random
import struct

import pytest

from readweave.sources import sff, sff_files

FLOWS = "TACG" * 100


def made(n, seed, prefix="r"):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        size = rng.randrange(1, 60)
        out.append({"read_id": f"{prefix}{k:04d}", "num_bases": size, "clip_qual_left": 1, "clip_qual_right": 0, "clip_adapter_left": 0, "clip_adapter_right": size, "flowgram": [rng.randrange(65536) for _ in FLOWS], "flow_index": [rng.randrange(4) for _ in range(size)], "bases": "".join(rng.choices("ACGTN", k=size)), "quality": [rng.randrange(41) for _ in range(size)]})
    return out


def read(df):
    return sorted((r.asDict() for r in df.drop("file").collect()), key=lambda r: r["read_id"])


@pytest.fixture
def folder(tmp_path):
    """Two files, one with an index of its own between header and records, and one without reads."""
    one, two = made(300, 1), made(40, 2, "s")
    (tmp_path / "a.sff").write_bytes(sff.file_bytes(one, FLOWS, "TCAG"))
    plain = sff.file_bytes(two, FLOWS, "TCAG")
    length = struct.unpack_from(">H", plain, 24)[0]
    block = b".mft1.00" + bytes(13)
    data = bytearray(plain[:length] + block + bytes(-len(block) % 8) + plain[length:])
    struct.pack_into(">QI", data, 8, length, len(block))
    (tmp_path / "b.sff").write_bytes(data)
    (tmp_path / "c.sff").write_bytes(sff.file_bytes([], FLOWS, "TCAG"))
    return tmp_path, one, two


def test_index_and_reads(spark, folder):
    path, one, two = folder
    index = sff_files.scan(spark, f"{path}/*.sff").cache()
    assert {(r.read_id, r.num_bases) for r in index.collect()} == {(r["read_id"], r["num_bases"]) for r in one + two}
    reads = sff_files.read_records(index)
    assert read(reads) == sorted(one + two, key=lambda r: r["read_id"])
    assert reads.selectExpr("spark_partition_id() as p").distinct().count() > 2  # a file is several tasks' work
    head = {r.file.rsplit("/", 1)[-1]: r for r in sff_files.headers(spark, f"{path}/*.sff").collect()}
    assert {k: r.num_reads for k, r in head.items()} == {"a.sff": 300, "b.sff": 40, "c.sff": 0}
    assert head["b.sff"].index_length == 21 and head["a.sff"].index_offset == 0
    sff.check_headers(sff_files.headers(spark, f"{path}/*.sff"))


def test_wanted_and_stored_index(spark, folder):
    path, one, two = folder
    names = spark.createDataFrame([("r0007",), ("s0003",), ("r0007",), ("gone",), (None,)], "read_id string")
    want = [one[7], two[3]]
    assert read(sff_files.read_sff(spark, f"{path}/*.sff", names)) == want
    sff_files.write_index(sff_files.scan(spark, f"{path}/*.sff"), f"{path}/index", 8)
    assert read(sff_files.lookup(spark, f"{path}/index", names)) == want
    assert sff_files.lookup_index(spark, f"{path}/index", names.where("read_id = 'gone'")).count() == 0


def test_files_of_several_tasks(spark, folder):
    path, one, two = folder
    reads = sff_files.read_sff(spark, f"{path}/*.sff").repartition(3, "read_id")
    files = sff_files.write_files(reads, str(path / "out"), FLOWS)
    assert len(files) == 3 and sorted(p.name for p in (path / "out").iterdir()) == ["part-00000.sff", "part-00001.sff", "part-00002.sff"]
    assert read(sff_files.read_sff(spark, str(path / "out"))) == sorted(one + two, key=lambda r: r["read_id"])
    again = sorted((r for f in files for r in sff.parse_reads(open(f, "rb").read())), key=lambda r: r["read_id"])
    assert again == sorted(one + two, key=lambda r: r["read_id"])
    assert sff_files.write_files(reads.where("false"), str(path / "none"), FLOWS) == []


def test_damaged_files_fail(spark, tmp_path):
    data = sff.file_bytes(made(5, 3), FLOWS, "TCAG")
    (tmp_path / "a.sff").write_bytes(data[:-900])
    with pytest.raises(Exception, match="ends within"):
        sff_files.scan(spark, str(tmp_path / "a.sff")).collect()
    (tmp_path / "b.sff").write_bytes(b"nonsense" * 20)
    with pytest.raises(Exception, match="flowgram"):
        sff_files.scan(spark, str(tmp_path / "b.sff")).collect()


def test_files_are_written_and_scanned_once(spark, tmp_path):
    """Neither a sort nor the sampling of ranges runs them twice (F19, F20); what has no place in a record raises."""
    rows = made(50, 7)
    df = spark.createDataFrame(rows, sff.READ_SCHEMA.replace("file string, ", "")).repartition(3)
    wrote = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            wrote.add(batch.num_rows)
            yield batch

    sff_files.write_files(df.mapInArrow(counted, df.schema), f"{tmp_path}/out", FLOWS)
    assert wrote.value == 50

    back = sff_files.read_sff(spark, f"{tmp_path}/out")
    assert back._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1  # the index is stored
    assert read(back) == sorted(rows, key=lambda r: r["read_id"])
    for change in ({"quality": [300]}, {"flowgram": [1] * 399}, {"flow_index": [None]}):
        with pytest.raises(Exception, match="flow"):
            sff_files.write_files(spark.createDataFrame([rows[0] | change], df.schema), f"{tmp_path}/bad", FLOWS)
