"""A stored event log as a stream source with offsets.

``write_log`` lays rows out in one Spark job as ``chunk=<n>`` folders: chunks
are stretches of time in order, and the rows of a chunk are dealt to several
files by a key, so all rows of a key in a chunk are in one file.

``LogSource`` (format ``marquee_log``) streams such a folder.  An offset is
the number of the next chunk.  A micro-batch takes up to ``chunksPerTrigger``
chunks (if it is told the query's checkpoint), as one Spark partition per file: reading is spread over executors
while each key's rows still arrive in order of time.  New chunks may be
added while a query runs.  A restarted query goes on from the offsets in its
checkpoint; a failed batch is planned again from the same files.

Files are read with pyarrow where the task runs, so the folder must be on a
file system that pyarrow knows (local or shared mounts, HDFS, S3, GCS).
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

FORMAT = "marquee_log"


def write_log(df: DataFrame, path: str, time: Column, key: Column, chunk: int, files: int | None = None) -> str:
    """Write ``df`` as a log of chunks of ``chunk`` time units, in one job;
    rows without a time go to the first chunk."""
    n = files or max(2, min(16, df.sparkSession.sparkContext.defaultParallelism // 2))
    rows = df.withColumn("chunk", F.coalesce(F.floor(time / chunk), F.lit(0)).cast("long"))
    deal = F.pmod(F.xxhash64(key), F.lit(n))
    rows.repartitionById(n, deal.cast("int")).write.partitionBy("chunk").parquet(path)
    return path


@dataclass
class LogFile(InputPartition):
    path: str


def _file_system(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _listed(path: str) -> dict[int, list[str]]:
    """{chunk: its files} of a log folder."""
    from pyarrow import fs
    system, root = _file_system(path)
    out: dict[int, list[str]] = {}
    for f in system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
        parts = f.path.rsplit("/", 2)
        # not what lies deeper: a writer's unfinished files
        own = parts[0] == root.rstrip("/") and parts[-2].startswith("chunk=") and parts[-1].startswith("part-")
        if own and f.type == fs.FileType.File:
            out.setdefault(int(parts[-2].removeprefix("chunk=")), []).append(f.path)
    return out


def _planned(checkpoint: str) -> int | None:
    """The end of the last batch that a query planned, from the offset log in
    its checkpoint (a text file per batch, a line of JSON per source)."""
    from pyarrow import fs
    system, root = _file_system(checkpoint)
    found = system.get_file_info(fs.FileSelector(f"{root.rstrip('/')}/offsets", allow_not_found=True))
    last = max((f for f in found if f.base_name.isdigit()), key=lambda f: int(f.base_name), default=None)
    if last is None:
        return None
    with system.open_input_file(last.path) as f:
        return json.loads(f.read().decode().strip().splitlines()[-1])["chunk"]


class LogReader(DataSourceStreamReader):
    """Offsets are {"chunk": first chunk not read}.  Spark asks for the
    latest offset before it says where a query stands, so the position of a
    new or restarted query is read from its checkpoint; without one, the
    first batch takes all there is, which never steps back."""

    def __init__(self, path: str, schema: StructType, step: int, checkpoint: str | None = None):
        self.path, self.schema, self.step, self.checkpoint = path, schema, step, checkpoint
        self.at: int | None = None

    def initialOffset(self) -> dict:
        return {"chunk": min(_listed(self.path), default=0)}

    def latestOffset(self) -> dict:
        chunks = sorted(_listed(self.path))
        if self.at is None and self.checkpoint:
            planned = _planned(self.checkpoint)
            self.at = min(chunks, default=0) if planned is None else planned
        if self.at is not None:
            ahead = [c for c in chunks if c >= self.at][:self.step]
            return {"chunk": ahead[-1] + 1 if ahead else self.at}
        return {"chunk": chunks[-1] + 1 if chunks else 0}

    def partitions(self, start: dict, end: dict) -> list[LogFile]:
        self.at = end["chunk"]
        chunks = _listed(self.path)
        return [LogFile(f) for c in sorted(chunks) if start["chunk"] <= c < end["chunk"] for f in sorted(chunks[c])]

    def commit(self, end: dict) -> None:
        self.at = end["chunk"]

    def read(self, partition: LogFile):
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema
        kind = to_arrow_schema(self.schema)
        system, _ = _file_system(self.path)
        with system.open_input_file(partition.path) as f:
            for batch in pq.ParquetFile(f).iter_batches(batch_size=10_000, columns=kind.names):
                yield pa.RecordBatch.from_arrays([batch.column(n).cast(kind.field(n).type) for n in kind.names], schema=kind)


class LogSource(DataSource):
    """``spark.readStream.format("marquee_log").schema(...).load(path)``"""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamReader(self, schema: StructType) -> LogReader:
        return LogReader(self.options["path"], schema, int(self.options.get("chunksPerTrigger", 1)), self.options.get("checkpoint"))


def read_log(spark: SparkSession, path: str, schema: StructType, checkpoint: str | None = None, chunks_per_trigger: int = 1) -> DataFrame:
    """The log as a stream; ``checkpoint`` is that of the query to be."""
    spark.dataSource.register(LogSource)
    source = spark.readStream.format(FORMAT).schema(schema).option("chunksPerTrigger", chunks_per_trigger)
    return (source.option("checkpoint", checkpoint) if checkpoint else source).load(path)
