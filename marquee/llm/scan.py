"""Running totals over sorted segments, without one task per segment.

Rows are dealt by range of (segment, order), so a segment may span many
partitions.  Each partition sums up its own rows; its last segment and that
segment's totals are one extra row, and those rows (one per partition) are
combined in order into what each partition has to add to the rows of the
segment that it began with.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import stored


def running(df: DataFrame, segment: Sequence[str], order: Sequence[str], name: str, sums: dict | None = None,
            xors: dict | None = None, before: dict | None = None) -> DataFrame:
    """``df`` with running values per segment in the given order.

    ``sums``, ``xors`` and ``before`` map new names to long columns: the sum
    or the exclusive or of the rows up to and with this one, or the value of
    the row before (null in a segment's first row).  ``segment`` names long
    columns without nulls (none: all rows are one segment).  Rows that are
    equal in segment and order come in any order.  No rows, no output.
    """
    sums, xors, before = sums or {}, xors or {}, before or {}
    made = [*sums, *xors, *before]
    extra = [T.StructField(c, T.LongType()) for c in made]
    extra += [T.StructField("__part", T.IntegerType()), T.StructField("__open", T.BooleanType()), T.StructField("__edge", T.BooleanType())]
    kind = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields] + extra)

    def scan(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        at, total, last, first, form = None, {}, {}, True, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            col = lambda c: batch.column(c).to_numpy(zero_copy_only=False)  # noqa: B023,E731
            seg = np.stack([col(c) for c in segment]) if segment else np.zeros((1, n), np.int64)
            new = np.ones(n, bool)
            new[1:] = (seg[:, 1:] != seg[:, :-1]).any(axis=0)
            new[0] = at is not None and (seg[:, 0] != at).any()
            group = np.cumsum(new)
            begin = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            old = group == 0                       # goes on from the batch before
            out = {}
            for c, v in ((c, col(v)) for c, v in sums.items()):
                run = np.cumsum(v)
                out[c] = run - (run - v)[begin] + np.where(old, total.get(c, 0), 0)
            for c, v in ((c, col(v)) for c, v in xors.items()):
                run = np.bitwise_xor.accumulate(v)
                out[c] = run ^ (run ^ v)[begin] ^ np.where(old, total.get(c, 0), 0)
            arrays = {c: pa.array(v) for c, v in out.items()}
            for c, v in ((c, col(v)) for c, v in before.items()):
                shifted = np.concatenate([[last.get(c, 0)], v[:-1]])
                gone = new.copy()
                gone[0] |= at is None
                arrays[c] = pa.array(shifted, mask=gone)
                last[c] = int(v[-1])
            open_ = old & first
            at, total = seg[:, -1], {c: int(v[-1]) for c, v in out.items()}
            first = bool(open_[-1])
            form = pa.schema([*batch.schema, *[(c, pa.int64()) for c in made], ("__part", pa.int32()), ("__open", pa.bool_()), ("__edge", pa.bool_())])
            yield pa.RecordBatch.from_arrays([*batch.columns, *[arrays[c].cast(pa.int64()) for c in made], pa.array(np.full(n, part, np.int32)),
                                              pa.array(open_), pa.array(np.zeros(n, bool))], schema=form)
        if at is not None:
            edge = dict(zip(segment, at.tolist())) | total | last | {"__part": part, "__open": first, "__edge": True}
            yield pa.RecordBatch.from_arrays([pa.array([edge.get(f.name)], f.type) for f in form], schema=form)

    def carry(pdfs):
        import pandas as pd
        seg, held = None, {}
        rows = []
        for pdf in pdfs:
            for r in pdf.to_dict("records"):
                here = [int(r[c]) for c in segment]
                rows.append({"__part": int(r["__part"]), "__any": seg is not None} | {f"__s{i}": v for i, v in enumerate(seg or [0] * len(segment))}
                            | {f"__c{i}": held.get(c, 0) for i, c in enumerate(made)})
                same = r["__open"] and here == seg
                held = {c: int(r[c]) + (held[c] if same else 0) for c in sums} | {c: int(r[c]) ^ (held[c] if same else 0) for c in xors} \
                    | {c: int(r[c]) for c in before}
                seg = here
        if rows:
            yield pd.DataFrame(rows)

    dealt = df.repartitionByRange(*segment, *order).sortWithinPartitions(*segment, *order)
    rows = stored(dealt.mapInArrow(scan, kind), name)
    edges = rows.filter("__edge").select(*segment, *made, "__part", "__open").coalesce(1).sortWithinPartitions("__part")
    # one row per partition, so never large
    carried = F.broadcast(edges.mapInPandas(carry, ", ".join(
        ["__part int", "__any boolean"] + [f"__s{i} long" for i in range(len(segment))] + [f"__c{i} long" for i in range(len(made))])))
    same = F.col("__open") & F.col("__any")
    for i, c in enumerate(segment):
        same &= F.col(c) == F.col(f"__s{i}")
    out = rows.filter(~F.col("__edge")).join(carried, "__part", "left")
    for i, c in enumerate(made):
        more = F.when(same, F.col(f"__c{i}")).otherwise(0)
        value = F.col(c) + more if c in sums else F.col(c).bitwiseXOR(more) if c in xors else F.coalesce(c, F.when(same, F.col(f"__c{i}")))
        out = out.withColumn(f"__v{i}", value)
    return out.select(*df.columns, *[F.col(f"__v{i}").alias(c) for i, c in enumerate(made)])
