"""The change log of a streamed table.

Each micro-batch writes only its own changes, as one piece, and then commits
a manifest: a small file ``_log/<version>`` that names the pieces of the log
as of that version.  Readers take the newest manifest, so they never see a
batch that is not complete and never list the data.

Pieces are merged in tiers: ``fan`` neighbours of one tier become one piece
of the next, so a row is written again only when the log has grown ``fan``
times, and a log of n batches has at most (fan - 1) * log_fan(n) + 1 pieces.
A merge may drop rows that newer ones replace (``reduce``).

A retried batch starts from the manifest before it, so it replaces what its
first try wrote.  The two newest manifests and their pieces are kept; what
only older ones name is deleted, so a reader may lag one version behind.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FAN = 8


class ChangeLog:
    def __init__(self, root: str, name: str, fan: int = FAN):
        self.path = f"{root.rstrip('/')}/{name}"
        self.fan = max(2, fan)

    # ------------------------------------------------------------ manifests

    def _fs(self, spark: SparkSession):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        return path, path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self, spark: SparkSession) -> list[int]:
        """The manifests that are kept, oldest first."""
        path, fs = self._fs(spark)
        folder = path(f"{self.path}/_log")
        names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        return sorted(int(n) for n in names if n.isdigit())

    def pieces(self, spark: SparkSession, version: int) -> list[list]:
        """[first version, last version, tier, folder] of a manifest."""
        path, fs = self._fs(spark)
        stream = fs.open(path(f"{self.path}/_log/{version}"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _commit(self, spark: SparkSession, version: int, pieces: list[list]) -> None:
        path, fs = self._fs(spark)
        final, draft = path(f"{self.path}/_log/{version}"), path(f"{self.path}/_log/.{version}-{uuid.uuid4().hex}")
        stream = fs.create(draft)
        stream.write(bytearray(json.dumps(pieces).encode()))
        stream.close()
        if fs.exists(final):                       # a retried batch
            fs.delete(final, False)
        if not fs.rename(draft, final):
            raise OSError(f"manifest {version} of {self.path} could not be committed")

    def _sweep(self, spark: SparkSession) -> None:
        path, fs = self._fs(spark)
        versions = self.versions(spark)
        kept = {p[3] for v in versions[-2:] for p in self.pieces(spark, v)}
        for v in versions[:-2]:
            for p in self.pieces(spark, v):
                if p[3] not in kept:
                    fs.delete(path(f"{self.path}/{p[3]}"), True)
            fs.delete(path(f"{self.path}/_log/{v}"), False)

    # ----------------------------------------------------------------- rows

    def _write(self, df: DataFrame, first: int, last: int, tier: int) -> list:
        name = f"{first}-{last}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(f"{self.path}/{name}")
        return [first, last, tier, name]

    def _rows(self, spark: SparkSession, pieces: list[list]) -> DataFrame:
        return spark.read.parquet(*[f"{self.path}/{p[3]}" for p in pieces])

    def write(self, df: DataFrame, version: int, reduce: Callable[[DataFrame], DataFrame] | None = None) -> None:
        """Append the rows of a batch, with its number as column ``v``."""
        spark = df.sparkSession
        known = self.versions(spark)
        before = [v for v in known if v < version]
        old = self.pieces(spark, before[-1]) if before else []
        tried = [p for v in known if v == version for p in self.pieces(spark, v)]      # of a first try
        made = [self._write(df.withColumn("v", F.lit(version)), version, version, 0)]
        pieces = [*old, made[0]]
        while len(pieces) >= self.fan and len({p[2] for p in pieces[-self.fan:]}) == 1:
            run = pieces[-self.fan:]
            rows = self._rows(spark, run)
            made.append(self._write(reduce(rows) if reduce else rows, run[0][0], version, run[0][2] + 1))
            pieces[-self.fan:] = made[-1:]
        self._commit(spark, version, pieces)
        kept = {p[3] for p in [*pieces, *old]}
        path, fs = self._fs(spark)
        for p in [*made, *tried]:
            if p[3] not in kept:
                fs.delete(path(f"{self.path}/{p[3]}"), True)
        self._sweep(spark)

    def read(self, spark: SparkSession, before: int | None = None) -> DataFrame | None:
        """All rows as of the newest version (below ``before``)."""
        versions = [v for v in self.versions(spark) if before is None or v < before]
        pieces = self.pieces(spark, versions[-1]) if versions else []
        return self._rows(spark, pieces) if pieces else None
