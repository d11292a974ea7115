"""Substring dedup by a join of window hashes (operator 10), in place of
relative Lempel-Ziv parsing.

The index holds the windows of ``window`` words (by 64-bit hash) with the
smallest document in which each starts.  A window of a document that is also
in one of smaller id is covered; stretches of covered windows that overlap or
touch are united, and their words go.  No stretch has a reference position.

To keep the index small, only windows that can repeat enter it: a window's
minimizer (its ``gram``-word run of smallest hash) is the same wherever the
window occurs, so windows whose minimizer occurs in a single document are
left out.  That drops no repeat.

Defined results: null texts have no words; a row with a null id is never a
reference and loses nothing; rows that share an id are one another's equals,
not references; texts shorter than a window keep all words; no rows, no
output.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import WordHasher, grams, small_batches


def minimizers(h: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(minimizer hash of each window, hashes of all windows)."""
    g = grams(h, gram)
    if len(h) < window:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return sliding_window_view(g, window - gram + 1).min(axis=1), grams(h, window)


def duplicate_spans(docs: DataFrame, window: int = 13, gram: int = 6, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The factors of each document that has any: ``row`` (hash of id and text),
    ``doc_id`` and ``spans``, array<struct<start, stop>> of word positions,
    stop exclusive."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def seeds(batches):
        hasher = WordHasher()
        for pdf in batches:
            found = [np.unique(minimizers(hasher.words(t), window, gram)[0]) for t in pdf["text"]]
            sizes = [len(f) for f in found]
            if sum(sizes):
                yield pd.DataFrame({"g": np.concatenate(found).view(np.int64), "doc_id": np.repeat(pdf["doc_id"].to_numpy(), sizes)})

    # seeds, and windows below, are made and moved once: a window over them
    # instead of a join with their own counts
    grown = rows.filter("doc_id is not null").mapInPandas(seeds, "g long, doc_id long")
    shared = grown.withColumn("n", F.count("*").over(Window.partitionBy("g"))).filter("n > 1")
    per_doc = shared.groupBy(F.col("doc_id").alias("__at")).agg(F.collect_set("g").alias("__gs"))

    def windows(batches):
        hasher = WordHasher()
        for pdf in batches:
            keys, names, rids, at = [], [], [], []
            for name, rid, text, gs in zip(pdf["doc_id"], pdf["row"], pdf["text"], pdf["gs"]):
                if gs is None:
                    continue
                small, whole = minimizers(hasher.words(text), window, gram)
                spot = np.flatnonzero(np.isin(small, np.asarray(gs, np.int64).view(np.uint64)))
                keys.append(whole[spot])
                names.append(np.full(len(spot), name))
                rids.append(np.full(len(spot), rid))
                at.append(spot)
            if keys:
                yield pd.DataFrame({"w": np.concatenate(keys).view(np.int64), "doc_id": np.concatenate(names).astype(np.int64),
                                    "row": np.concatenate(rids), "at": np.concatenate(at)})

    # the same move of the texts serves ``without_spans``, so rows without seeds stay
    dealt = _dealt(docs, id_col, text_col).join(per_doc, "__at", "left")
    cand = dealt.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col("__row").alias("row"), F.col("__gs").alias("gs")) \
        .mapInPandas(windows, "w long, doc_id long, row long, at int")
    hits = cand.withColumn("first", F.min("doc_id").over(Window.partitionBy("w"))).filter("first < doc_id").groupBy("row", "doc_id").agg(F.sort_array(F.collect_set("at")).alias("ats"))
    return hits.select("row", "doc_id", _factors(F.col("ats"), window).alias("spans"))


def _row(id_col: str, text_col: str):
    return F.xxhash64(F.col(id_col).cast("long"), F.col(text_col))


def _dealt(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows by ``__at``: their id, or where it is null their hash."""
    rows = docs.withColumn("__row", _row(id_col, text_col))
    return rows.withColumn("__at", F.coalesce(F.col(id_col).cast("long"), "__row")).repartition("__at")


def _factors(ats, window: int):
    """Greedy factors of sorted window starts: a start that does not follow
    its predecessor directly begins a factor, one that has no direct
    successor ends it; factors that overlap or touch are joined."""
    n = F.size(ats)
    begin = F.filter(ats, lambda a, i: (i == 0) | (F.get(ats, i - 1) + window < a))
    end = F.filter(ats, lambda a, i: (i == n - 1) | (a + window < F.get(ats, i + 1)))
    return F.zip_with(begin, end, lambda a, b: F.struct(a.alias("start"), (b + window).alias("stop")))


def without_spans(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input rows with ``n_words``, ``n_removed`` and ``kept_words``
    (the words left, joined by one space)."""
    docs = docs.drop(*[c for c in ("n_words", "n_removed", "kept_words") if c in docs.columns])
    # rows that share an id may have other texts: each finds its own among their spans
    found = spans.groupBy(F.col("doc_id").cast("long").alias("__at")).agg(F.collect_list(F.struct("row", "spans")).alias("__all"))
    mine = F.get(F.filter("__all", lambda s: s["row"] == F.col("__row")), F.lit(0))["spans"]
    rows = _dealt(docs, id_col, text_col).join(found, "__at", "left").withColumn("__mine", mine)
    rows = rows.withColumns({"__a": F.transform("__mine", lambda s: s["start"]), "__b": F.transform("__mine", lambda s: s["stop"])}) \
        .drop("__row", "__at", "__all", "__mine")
    names = [c for c in rows.columns if c not in ("__a", "__b")]
    schema = docs.select(*names).schema.add("n_words", "long").add("n_removed", "long").add("kept_words", "string")
    at = [rows.columns.index(c) for c in (text_col, "__a", "__b")]
    keep = [rows.columns.index(c) for c in names]

    def cut(batches):
        import pyarrow as pa
        for b in batches:
            total, gone, left = [], [], []
            for text, a, z in zip(*(b.column(i).to_pylist() for i in at)):
                ws = text.encode("utf-8", "surrogatepass").split() if text else []
                out, done = [], 0
                for s, e in zip(a or [], z or []):
                    out.extend(ws[done:s])
                    done = e
                out.extend(ws[done:])
                total.append(len(ws))
                gone.append(len(ws) - len(out))
                left.append(b" ".join(out).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in keep], pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
                                              pa.array(left, pa.string())], names=[*names, "n_words", "n_removed", "kept_words"])

    return rows.mapInArrow(cut, schema)
