"""Adding runs from a stream: whole runs of a micro-batch, or runs that come in several, once the watermark has passed them."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from readweave.plans.project import Project, digest_of_reads


def add_runs(stream: DataFrame, project: Project, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Start a query that adds the runs of a stream(run_id, individual, read_id, seq, qual, ord).

    A run comes whole in one micro-batch; runs of a batch are added in order of their names. A run that is
    already there with the same reads is skipped, so a batch that is repeated after a failure changes nothing. With
    other reads, more of a run has come late: the query fails, and no row is lost silently.
    """

    def fold(batch: DataFrame, _: int) -> None:
        batch.persist()
        known = {r.run_id: r.digest for r in project.table("runs").collect()}  # one row for each run
        brought = batch.groupBy("run_id", "individual").agg(digest_of_reads().alias("digest")).collect()
        for run_id, individual, digest in sorted(map(tuple, brought)):
            if run_id not in known:
                project.add(batch.where(batch.run_id == run_id), run_id, individual)
            elif known[run_id] != digest:
                raise ValueError(f"rows of run {run_id} came after it was added")
        batch.unpersist()

    writer = stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


ROWS = "run_id string, individual string, read_id string, seq string, qual array<int>, ord long"
SUMS = "run_id string, individual string, last timestamp, digest string"


class Gathered:
    """Rows of runs that come in several micro-batches, kept in a folder by batch and run until their run is whole.

    A run is whole once the watermark, the greatest time of any row less the delay, is past its last row; it is
    then added to the project, runs in order of their last rows and names. A batch that is repeated after a failure
    is written over itself. Rows without a time neither move the watermark nor keep a run open. A run has one
    individual; rows that name another fail it. Rows of a run that was added already fail the query: they are kept, and
    no row is lost silently.
    """

    def __init__(self, project: Project, folder: str, delay: timedelta):
        self.project, self.folder, self.delay = project, folder, delay

    def _read(self, kind: str, schema: str) -> DataFrame:
        return self.project.spark.read.schema(schema + ", batch long").parquet(f"{self.folder}/{kind}")

    def keep(self, batch: DataFrame, number: int) -> None:
        """Write a batch's rows, one folder a run, and one line for each of its runs."""
        rows = batch.select("run_id", "individual", "read_id", "seq", "qual", F.col("ord").cast("long").alias("ord"), F.col("at").cast("timestamp").alias("at")).persist()
        rows.drop("at").write.mode("overwrite").partitionBy("run_id").parquet(f"{self.folder}/rows/batch={number}")
        sums = rows.groupBy("run_id", "individual").agg(F.max("at").alias("last"), digest_of_reads().alias("digest"))
        sums.write.mode("overwrite").parquet(f"{self.folder}/sums/batch={number}")
        rows.unpersist()

    def fold(self, every: bool = False) -> list[str]:
        """Add the runs that are whole (or every run) to the project; their names, in the order in which they were added."""
        known = self.project.table("runs").select("run_id", F.col("individual").alias("person"), F.col("digest").alias("held"))
        sums = self._read("sums", SUMS)
        runs = sums.groupBy("run_id").agg(
            F.max("last").alias("last"), F.min("individual").alias("individual"), F.max("individual").alias("other"),
            F.sum(F.col("digest").cast("decimal(38,0)")).cast("string").alias("digest"),
        )
        newest = sums.agg(F.max("last")).first()[0]
        joined = runs.join(known, "run_id", "left").where("held is null or held <> digest or individual <> other or person <> individual")
        whole = []
        for r in joined.collect():  # a line for each run that is open
            if r.individual != r.other:
                raise ValueError(f"rows of run {r.run_id} name more than one individual")
            if r.held is not None:
                raise ValueError(f"rows of run {r.run_id} came after it was added")
            if every or r.last is None or (newest is not None and r.last + self.delay < newest):
                whole.append((r.last is not None, r.last, r.run_id, r.individual))
        rows = self._read("rows", ROWS)
        for _, _, run_id, individual in sorted(whole):
            # the run's folders only are read
            self.project.add(rows.where(F.col("run_id") == run_id).drop("batch"), run_id, individual)
        return [x[2] for x in sorted(whole)]


def gather_runs(stream: DataFrame, project: Project, checkpoint: str, delay: timedelta, once: bool = True) -> StreamingQuery:
    """Start a query that adds the runs of a stream(run_id, individual, read_id, seq, qual, ord, at), whose rows may come in
    any number of micro-batches and in any order within delay. See Gathered; finish_runs adds what is still open."""
    gathered = Gathered(project, f"{checkpoint}/gathered", delay)

    def take(batch: DataFrame, number: int) -> None:
        gathered.keep(batch, number)
        gathered.fold()

    writer = stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def finish_runs(project: Project, checkpoint: str) -> list[str]:
    """Add the runs that gather_runs has kept and not added, when no more rows will come."""
    return Gathered(project, f"{checkpoint}/gathered", timedelta()).fold(every=True)
