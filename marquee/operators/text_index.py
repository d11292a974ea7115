"""A stored inverted index and exact BM25 over it.

Layout, as Parquet folders under one root:

* ``postings/bucket=<b>`` -- one row per (field, term, shard): the documents
  of the shard that have the term, ascending, their term counts and lengths,
  and the block's largest count and smallest length.  Rows are sorted by
  (field, term), buckets are hashes of (field, term);
* ``terms/bucket=<b>``    -- (field, term, df);
* ``stats``               -- (field, n_docs, tokens, shards, buckets, id_type).

Documents are hashed into shards of bounded size, so no term is ever one
row, one group or one task however common it is: a hot term is one bounded
block per shard.  Building moves texts once (to their shard, where terms are
counted) and blocks once (to their bucket).

A search reads the buckets of its own terms only and joins them with its
terms, so postings of other terms are not moved.  Queries and shards are
dealt into a few groups each, and a group of queries meets one of shards in a
cell: a task holds the queries and streams the shards, so each shard is moved
once per group of queries.  A shard's scores are a product of two sparse
matrices.  The task keeps each query's n best documents so far; a shard whose
largest weights cannot lift a query above the n-th is left out, and n
documents per query leave the cell.  A query that cannot reach its n-th score
without certain terms is scored only for the documents that have the two
rarest of them.  Few queries over many shards first
visit their best shard alone (by the blocks' largest counts and smallest
lengths), and start from the n-th score found there.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.operators.factor_blocks import HELD_BYTES, ROWS_OUT, _by_cell, _dealt, _runs
from marquee.session import scratch_path

# BM25 parameters of the public search-engine documentation.
K1 = 1.2
B = 0.75

TOKEN_SPLIT = r"[^\p{L}\p{N}]+"
SHARD_DOCS = 4096
SHARD_TOKENS = 2_000_000
BUCKET_TOKENS = 4_000_000
MAX_BUCKETS = 4096
SLOT_SHARDS = 512         # shards of a bucket that share a file, so files grow with the input
GROUP_QUERIES = 4096
CELLS = 4_000_000         # scores held at once
QUERIES_AT_ONCE = 1024
DOCS_AT_ONCE = 2 * CELLS // QUERIES_AT_ONCE
PRUNE_SHARDS = 64         # from here on few queries visit their best shard first

# Scores equal to this many decimals are ties, broken by the smaller id, so
# the ranking does not depend on the order in which partial sums were added.
RANK_DECIMALS = 9
TIE = 2e-9                # scores further apart are no ties


def tokens(col) -> Column:
    """Lower-case word tokens of a whole text (letters and digits)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.filter(F.split(F.lower(c), TOKEN_SPLIT), lambda t: F.length(t) > 0)


def rank_key(col: str) -> Column:
    return F.round(F.col(col), RANK_DECIMALS)


def idf(n_docs, df) -> Column:
    return F.log(F.lit(1.0) + (n_docs - df + F.lit(0.5)) / (df + F.lit(0.5)))


@dataclass
class Index:
    spark: SparkSession
    path: str
    stats: dict = field(default_factory=dict)     # {field: (n_docs, avgdl)}
    shards: int = 1
    buckets: int = 1
    id_type: str = "long"

    def _read(self, name: str, kind: str) -> DataFrame:
        return self.spark.read.schema(kind).parquet(f"{self.path}/{name}")

    @property
    def blocks(self) -> DataFrame:
        return self._read("postings", "shard int, field string, term string, docs array<long>, tfs array<int>, dls array<int>, "
                                      "n int, max_tf int, min_dl int, tokens long, share double, bucket int")

    @property
    def terms(self) -> DataFrame:
        """(field, term, df) of the whole index, with its bucket."""
        return self._read("terms", "field string, term string, df long, bucket int")

    @property
    def postings(self) -> DataFrame:
        """(field, term, doc, tf, dl): one row per posting."""
        rows = self.blocks.select("field", "term", F.explode(F.arrays_zip("docs", "tfs", "dls")).alias("p"))
        return rows.select("field", "term", F.col("p.docs").cast(self.id_type).alias("doc"), F.col("p.tfs").cast("long").alias("tf"), F.col("p.dls").cast("long").alias("dl"))

    def of_field(self, which: int) -> Column:
        """A field's number of documents (0) or mean length (1)."""
        expr = F.lit(None).cast("double")
        for name, v in self.stats.items():
            expr = F.when(F.col("field") == name, F.lit(float(v[which]))).otherwise(expr)
        return expr

    def bucket_of(self) -> Column:
        return F.pmod(F.xxhash64("field", "term"), F.lit(self.buckets)).cast("int")

    def shard_of(self, doc: Column) -> Column:
        return F.pmod(F.xxhash64(doc.cast("long")), F.lit(self.shards)).cast("int")


BLOCKS = ("shard int, field string, term string, docs array<long>, tfs array<int>, dls array<int>, "
          "n int, max_tf int, min_dl int, tokens long, share double")


def _counted(batches):
    """The blocks of a task's shards: rows (shard, field, doc, s), all of a
    shard's in one task, give one block for each of its terms.  Tokens are
    numbered and counted as arrays; rows that repeat an id are one document,
    its length is the first row's."""
    import pyarrow as pa
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    rows = pa.Table.from_batches(batches)
    del batches
    seg = rows.select(["shard", "field"]).group_by(["shard", "field"]).aggregate([]).combine_chunks()
    names = {k: i for i, k in enumerate(zip(seg["shard"].to_pylist(), seg["field"].to_pylist()))}
    seg_of = np.fromiter((names[k] for k in zip(rows["shard"].to_pylist(), rows["field"].to_pylist())), np.int64, len(rows))
    doc = rows["doc"].combine_chunks()
    ids, rank = np.unique(doc.fill_null(0).to_numpy(zero_copy_only=False), return_inverse=True)
    null = doc.is_null().to_numpy(zero_copy_only=False)
    rank = np.where(null, 0, rank + 1)                    # a null id is a document, the first
    n_docs = len(ids) + 1
    words = pa.chunked_array([c.flatten() for c in rows["s"].chunks]).dictionary_encode().unify_dictionaries().combine_chunks()
    size = np.concatenate([c.value_lengths().to_numpy(zero_copy_only=False) for c in rows["s"].chunks]).astype(np.int64)
    at, first = np.unique(seg_of * n_docs + rank, return_index=True)
    length = size[first]
    terms, code = words.dictionary, words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    del rows, words
    key, tf = np.unique((np.repeat(seg_of, size) * len(terms) + code) * n_docs + np.repeat(rank, size), return_counts=True)
    block, rank = key // n_docs, key % n_docs
    dl = length[np.searchsorted(at, block // len(terms) * n_docs + rank)]
    begin = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
    stop = np.append(begin[1:], len(block))
    sums = lambda f, v: f.reduceat(v, begin)
    whole = {"n": stop - begin, "max_tf": sums(np.maximum, tf), "min_dl": sums(np.minimum, dl), "tokens": sums(np.add, tf), "share": sums(np.add, tf / dl)}
    kind = {"n": pa.int32(), "max_tf": pa.int32(), "min_dl": pa.int32(), "tokens": pa.int64(), "share": pa.float64()}
    for x, y in _runs(whole["n"]):
        i, part = slice(x, y), slice(begin[x], stop[y - 1])
        ends = pa.array(np.append(begin[i], stop[y - 1]) - begin[x], pa.int32())
        of = seg.take(pa.array(block[begin[i]] // len(terms)))
        lists = [pa.array(ids[np.maximum(rank[part], 1) - 1], pa.int64(), mask=rank[part] == 0), pa.array(tf[part], pa.int32()), pa.array(dl[part], pa.int32())]
        cols = {"shard": of["shard"].combine_chunks(), "field": of["field"].combine_chunks(), "term": terms.take(pa.array(block[begin[i]] % len(terms)))}
        cols |= {c: pa.ListArray.from_arrays(ends, v) for c, v in zip(("docs", "tfs", "dls"), lists)}
        cols |= {c: pa.array(v[i], kind[c]) for c, v in whole.items()}
        yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))


def write_index(docs: DataFrame, id_col: str, fields: tuple[str, ...], path: str, shard_docs: int = SHARD_DOCS,
                shard_tokens: int = SHARD_TOKENS, bucket_tokens: int = BUCKET_TOKENS) -> Index:
    """Index ``fields`` of ``docs`` (whole texts; ids are unique whole
    numbers) into the folder ``path``, replacing an index there."""
    spark = docs.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = docs.agg(F.count("*").alias("n"), *[F.sum(F.length(f)).alias(f) for f in fields]).first()
    about = sum(size[f] or 0 for f in fields) // 6
    ix = Index(spark, path.rstrip("/"), id_type=docs.schema[id_col].dataType.simpleString())
    ix.shards = max(1, -(-size["n"] // shard_docs), -(-about // shard_tokens), min(cores, -(-size["n"] // 64)))
    ix.buckets = max(1, min(MAX_BUCKETS, -(-about // bucket_tokens)))
    doc = F.col(id_col).cast("long")
    rows = docs.select(doc.alias("doc"), ix.shard_of(doc).alias("shard"), *[F.col(f).alias(f"f{i}") for i, f in enumerate(fields)])
    rows = rows.repartitionById(ix.shards, "shard")      # each shard is one task's
    texts = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"f{i}").alias("text")) for i, f in enumerate(fields)]))
    rows = rows.select("shard", "doc", texts.alias("x")).select("shard", "doc", "x.field", tokens("x.text").alias("s")).filter(F.size("s") > 0)
    blocks = rows.select("shard", "field", "doc", "s").mapInArrow(_counted, BLOCKS).withColumn("bucket", ix.bucket_of())
    files = ix.buckets * -(-ix.shards // SLOT_SHARDS)
    blocks.repartition(max(files, min(cores, ix.shards)), "bucket", F.floor(F.col("shard") / SLOT_SHARDS), F.pmod(F.xxhash64("term"), F.lit(max(1, cores // files)))) \
        .sortWithinPartitions("bucket", "field", "term", "shard").write.mode("overwrite").partitionBy("bucket").parquet(f"{ix.path}/postings")
    terms = ix.blocks.groupBy("bucket", "field", "term").agg(F.sum("n").alias("df"))
    terms.repartition(max(1, min(ix.buckets, 4 * cores)), "bucket").sortWithinPartitions("bucket", "field", "term").write.mode("overwrite").partitionBy("bucket").parquet(f"{ix.path}/terms")
    # the shares that a document's terms have of its length add up to one
    per_shard = ix.blocks.groupBy("shard", "field").agg(F.round(F.sum("share")).cast("long").alias("n_docs"), F.sum("tokens").alias("tokens"))
    per_shard.groupBy("field").agg(F.sum("n_docs").alias("n_docs"), F.sum("tokens").alias("tokens")) \
        .withColumns({"shards": F.lit(ix.shards), "buckets": F.lit(ix.buckets), "id_type": F.lit(ix.id_type)}).coalesce(1).write.mode("overwrite").parquet(f"{ix.path}/stats")
    return open_index(spark, path, ix)


def open_index(spark: SparkSession, path: str, known: Index | None = None) -> Index:
    """An index written before."""
    ix = known or Index(spark, path.rstrip("/"))
    for r in ix._read("stats", "field string, n_docs long, tokens long, shards int, buckets int, id_type string").collect():      # one row per field
        ix.stats[r.field] = (r.n_docs, r.tokens / r.n_docs)
        ix.shards, ix.buckets, ix.id_type = r.shards, r.buckets, r.id_type
    return ix


def built_index(docs: DataFrame, id_col: str, fields: tuple[str, ...], **options) -> Index:
    """An index in a new scratch folder."""
    return write_index(docs, id_col, fields, scratch_path(docs.sparkSession, "index"), **options)


# ------------------------------------------------------------------ queries

def weighted(ix: Index, asked: DataFrame) -> DataFrame:
    """(qid, field, term, bucket, tid, w) of query terms (qid, field, term,
    qw) that the index has; written once, as it is read more than once."""
    asked = asked.withColumn("bucket", ix.bucket_of())
    rows = asked.join(ix.terms, ["bucket", "field", "term"])
    rows = rows.select("qid", "field", "term", "bucket", F.xxhash64("field", "term").alias("tid"), (F.col("qw") * idf(ix.of_field(0), F.col("df"))).alias("w"))
    path = scratch_path(ix.spark, "query-terms")
    rows.write.parquet(path)
    return ix.spark.read.schema(rows.schema).parquet(path)


def _tf_part(tf, dl, avgdl):
    return tf / (tf + K1 * ((1 - B) + B * dl / avgdl))


def _pack_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    """A shard's blocks by term: ids once, postings as places among them."""
    pdf = pdf.sort_values("tid", kind="stable")
    size = np.array([len(d) for d in pdf["docs"]], np.int64)
    tf, dl = (np.concatenate(pdf[c].to_numpy()).astype(np.float64) for c in ("tfs", "dls"))
    w = _tf_part(tf, dl, np.repeat(pdf["avgdl"].to_numpy(), size))
    ids, at = np.unique(np.concatenate(pdf["docs"].to_numpy()).astype(np.int64), return_inverse=True)
    return pd.DataFrame([{"shard": int(pdf["shard"].iloc[0]), "space": pdf["space"].iloc[0], "d_tids": pdf["tid"].to_numpy(np.int64).tobytes(),
                          "sizes": size.tobytes(), "ids": ids.tobytes(), "d_at": at.astype(np.int32).tobytes(), "ws": w.tobytes()}])


def _pack_queries(pdf: pd.DataFrame) -> pd.DataFrame:
    qid, first, at = np.unique(pdf["qid"].to_numpy(), return_index=True, return_inverse=True)
    return pd.DataFrame([{"g": int(pdf["g"].iloc[0]), "space": pdf["space"].iloc[0], "qids": list(qid), "at": at.astype(np.int64).tobytes(),
                          "q_tids": pdf["tid"].to_numpy(np.int64).tobytes(), "q_ws": pdf["w"].to_numpy(np.float64).tobytes(),
                          "only": pdf["only"].to_numpy(np.int64)[first].tobytes(), "least": pdf["least"].to_numpy(np.float64)[first].tobytes()}])


def products(q_at, q_tid, q_w, d_at, d_tid, d_w, nq: int, nd: int) -> np.ndarray:
    """Scores (nq x nd) of sparse rows."""
    terms, d_t = np.unique(d_tid, return_inverse=True)
    q_t = np.minimum(np.searchsorted(terms, q_tid), len(terms) - 1)
    q = np.flatnonzero(terms[q_t] == q_tid)
    q, d = q[np.argsort(q_t[q], kind="stable")], np.argsort(d_t, kind="stable")
    begin = np.append(0, np.cumsum(np.bincount(d_t, minlength=len(terms))))
    return _summed(q_at[q], q_t[q], q_w[q], begin, d_at[d], d_w[d], nq, nd)


def _summed(q_at, q_t, q_w, begin, d_at, d_w, nq: int, nd: int) -> np.ndarray:
    """Scores (nq x nd) of rows in order of their terms (``begin``: where
    the documents of each term begin): term by term, or as one dense product
    where terms are few and common."""
    used, at = np.unique(q_t, return_index=True)
    stop = np.append(at[1:], len(q_t))
    n_q, n_d = stop - at, begin[used + 1] - begin[used]
    if nq * nd * len(used) <= 40 * int((n_q * n_d).sum()) + CELLS and len(used) * max(nq, nd) <= 4 * CELLS:
        left, right = np.zeros((nq, len(used))), np.zeros((len(used), nd))
        np.add.at(left, (q_at, np.repeat(np.arange(len(used)), n_q)), q_w)
        for i, t in enumerate(used.tolist()):
            right[i, d_at[begin[t]:begin[t + 1]]] = d_w[begin[t]:begin[t + 1]]
        return left @ right
    out = np.zeros((nq, nd))
    for t, x, y in zip(used.tolist(), at.tolist(), stop.tolist()):
        d = slice(begin[t], begin[t + 1])
        out[q_at[x:y][:, None], d_at[d][None, :]] += q_w[x:y][:, None] * d_w[d][None, :]
    return out


def _best(at, doc, score, n: int):
    """The n best rows of each ``at``, scores equal after rounding are ties,
    to smaller ids; and each n-th score."""
    order = np.lexsort((doc, -np.round(score, RANK_DECIMALS), at))
    at, doc, score = at[order], doc[order], score[order]
    begin = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else np.zeros(0, np.int64)
    place = np.arange(len(at)) - np.repeat(begin, np.diff(np.append(begin, len(at))))
    last = place == n - 1
    return (at[place < n], doc[place < n], score[place < n]), at[last], score[last]


def _spans(start: np.ndarray, size: np.ndarray):
    """(which span, place) of all places in spans."""
    of = np.repeat(np.arange(len(size)), size)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start, size)


def _weights(at, w, size, asked, nd: int):
    """The weight of a term in a document, 0 where it does not have it, for
    arrays of documents and of terms among ``asked``."""
    term = np.repeat(np.arange(len(size)), size)
    used = np.unique(asked)
    if len(used) * nd <= 2 * CELLS:
        local = np.full(len(size), -1)
        local[used] = np.arange(len(used))
        table, has = np.zeros((nd, len(used))), local[term] >= 0
        table[at[has], local[term[has]]] = w[has]
        return lambda doc, t: table[doc, local[t]]
    key = term * nd + at
    order = np.argsort(key, kind="stable")
    key, w = key[order], w[order]

    def find(doc, t):
        i = np.minimum(np.searchsorted(key, t * nd + doc), len(key) - 1)
        return np.where(key[i] == t * nd + doc, w[i], 0.0)
    return find


class _Asked:
    """The queries of a cell and space, in runs of ``QUERIES_AT_ONCE``, each
    run's terms in order."""

    def __init__(self, packs: list):
        self.qids = np.concatenate([np.asarray(r.qids) for r in packs])
        base = np.cumsum([0] + [len(r.qids) for r in packs])
        read = lambda c, kind: np.concatenate([np.frombuffer(getattr(r, c), kind) for r in packs])
        at = np.concatenate([np.frombuffer(r.at, np.int64) + b for r, b in zip(packs, base)])
        self.only, self.low = read("only", np.int64), np.maximum(read("least", np.float64) - TIE, np.nextafter(0, 1))
        self.terms, t = np.unique(read("q_tids", np.int64), return_inverse=True)
        order = np.lexsort((t, at // QUERIES_AT_ONCE))
        self.at, self.t, self.w = at[order], t[order], read("q_ws", np.float64)[order]
        self.runs = np.searchsorted(self.at // QUERIES_AT_ONCE, np.arange(-(-len(self.qids) // QUERIES_AT_ONCE) + 1))
        self.by_query = np.argsort(self.at, kind="stable")
        # each query's n-th row so far: its rounded score and its document
        self.nth, self.last = np.full(len(self.qids), -np.inf), np.zeros(len(self.qids), np.int64)
        self.found, self.new, self.fresh = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)), [], 0

    def settle(self, n: int) -> None:
        self.found, at, nth = _best(*(np.concatenate(c) for c in zip(self.found, *self.new)), n)
        self.low[at] = np.maximum(self.low[at], nth - TIE)
        ends = np.flatnonzero(np.append(self.found[0][1:] != self.found[0][:-1], True)) if len(self.found[0]) else np.zeros(0, np.int64)
        full = ends[np.isin(self.found[0][ends], at, assume_unique=True)]
        self.nth[at], self.last[at] = np.round(self.found[2][full], RANK_DECIMALS), self.found[1][full]
        self.new, self.fresh = [], 0

    def gather(self, at, doc, score) -> None:
        """Rows that come before the n-th of their query."""
        place = np.round(score, RANK_DECIMALS)
        keep = (place > self.nth[at]) | ((place == self.nth[at]) & (doc < self.last[at]))
        if keep.any():
            self.new.append((at[keep], doc[keep], score[keep]))
            self.fresh += int(np.count_nonzero(keep))

    def narrow(self, r, ids, at, w, size, most, place, known, exclude_self: bool) -> np.ndarray:
        """Score the queries that need certain terms: without one of them a
        document cannot reach the n-th score, so only those are scored that
        have the rarest two.  Returns the queries that are left."""
        e = self.by_query[known[self.t[self.by_query]]]
        q_at, t, q_w = self.at[e], place[self.t[e]], self.w[e]
        reach = np.bincount(q_at, q_w * most[t], len(self.qids))
        go = (reach * (1 + 1e-12) >= self.low) & ((self.only < 0) | (self.only == r.shard))
        some = go[q_at]
        q_at, t, q_w = q_at[some], t[some], q_w[some]
        needed = np.flatnonzero(reach[q_at] * (1 + 1e-12) - q_w * most[t] < self.low[q_at])
        if not len(needed):
            return go
        needed = needed[np.lexsort((size[t[needed]], q_at[needed]))]
        of = q_at[needed]
        first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        second = np.minimum(first + 1, len(of) - 1)
        qs, one = of[first], t[needed[first]]
        two = np.where((second > first) & (of[second] == qs), t[needed[second]], -1)
        count = np.bincount(q_at, minlength=len(self.qids))
        begin = np.cumsum(count) - count
        few = size[one] * count[qs] <= len(ids)
        qs, one, two = qs[few], one[few], two[few]
        if not len(qs):
            return go
        weight = _weights(at, w, size, t, len(ids))
        # the documents of every two terms, then of every query
        sets, mine = np.unique(one * (len(size) + 1) + two + 1, return_inverse=True)
        one, two = sets // (len(size) + 1), sets % (len(size) + 1) - 1
        of, i = _spans(np.cumsum(size)[one] - size[one], size[one])
        doc = at[i]
        both = two[of] < 0
        both[~both] = weight(doc[~both], two[of[~both]]) > 0
        of, doc = of[both], doc[both]
        n_docs = np.bincount(of, minlength=len(sets))
        start, n_docs = (np.cumsum(n_docs) - n_docs)[mine], n_docs[mine]
        part = np.cumsum(n_docs) // CELLS
        for x in np.unique(part).tolist():
            now = part == x
            of, i = _spans(start[now], n_docs[now])
            q, d = qs[now][of], doc[i]
            score, terms = np.zeros(len(q)), count[q]
            for j in range(int(terms.max(initial=0))):
                live = np.flatnonzero(terms > j)
                entry = begin[q[live]] + j
                score[live] += q_w[entry] * weight(d[live], t[entry])
            keep = score >= self.low[q]
            if exclude_self:
                keep &= ids[d] != self.qids[q]
            self.gather(q[keep], ids[d[keep]], score[keep])
        go[qs] = False
        return go

    def meet(self, r, n: int, exclude_self: bool) -> None:
        """Score a shard's documents for the queries that its terms' largest
        weights can still lift above their n-th score."""
        tids, size = np.frombuffer(r.d_tids, np.int64), np.frombuffer(r.sizes, np.int64)
        ids, at, w = np.frombuffer(r.ids, np.int64), np.frombuffer(r.d_at, np.int32), np.frombuffer(r.ws, np.float64)
        place = np.minimum(np.searchsorted(tids, self.terms), len(tids) - 1)
        known = tids[place] == self.terms
        stop = np.cumsum(size)
        most = np.maximum.reduceat(w, stop - size)
        left = self.narrow(r, ids, at, w, size, most, place, known, exclude_self)
        for lo in range(0, len(ids), DOCS_AT_ONCE):
            docs, d_at, d_w, begin = ids[lo:lo + DOCS_AT_ONCE], at, w, np.append(0, stop)
            if len(docs) < len(ids):
                some = (at >= lo) & (at < lo + len(docs))
                d_at, d_w, begin = at[some] - lo, w[some], np.append(0, np.cumsum(some))[begin]
            for run in range(len(self.runs) - 1):
                rows = slice(self.runs[run], self.runs[run + 1])
                first = run * QUERIES_AT_ONCE
                q_at, t, q_w = self.at[rows] - first, self.t[rows], self.w[rows]
                real = known[t]
                q_at, t, q_w = q_at[real], place[t[real]], q_w[real]
                here = slice(first, first + QUERIES_AT_ONCE)
                low, mine = self.low[here], self.qids[here]
                go = np.flatnonzero(left[here])
                if not len(go):
                    continue
                if len(go) < len(low):
                    to = np.full(len(low), -1)
                    to[go] = np.arange(len(go))
                    q_at = to[q_at]
                    q_at, t, q_w = q_at[q_at >= 0], t[q_at >= 0], q_w[q_at >= 0]
                    low, mine = low[go], mine[go]
                score = _summed(q_at, t, q_w, begin, d_at, d_w, len(go), len(docs))
                if exclude_self:
                    own = np.minimum(np.searchsorted(docs, mine), len(docs) - 1)
                    is_own = docs[own] == mine
                    score[np.flatnonzero(is_own), own[is_own]] = 0
                keep = score >= low[:, None]
                if score.shape[1] > n and np.count_nonzero(keep) > 4 * n * len(go):
                    nth = np.partition(score, -n, axis=1)[:, -n] - TIE
                    low = np.maximum(low, nth)
                    self.low[first + go] = low
                    keep = score >= low[:, None]
                row, col = np.nonzero(keep)
                if len(row):
                    self.gather(first + go[row], docs[col], score[row, col])
        if self.fresh > max(ROWS_OUT, len(self.found[0])):
            self.settle(n)


def _score(n: int, exclude_self: bool):
    def run(batches):
        for held, met in _by_cell(batches):
            asked = {s: _Asked([r for r in held if r.space == s]) for s in {r.space for r in held}}
            held.clear()
            for r in met:
                if r.space in asked:
                    asked[r.space].meet(r, n, exclude_self)
            for a in asked.values():
                a.settle(n)
                at, doc, score = a.found
                for begin in range(0, len(at), ROWS_OUT):
                    part = slice(begin, begin + ROWS_OUT)
                    yield pd.DataFrame({"qid": a.qids[at[part]], "doc": doc[part], "score": score[part]})
    return run


def _visits(ix: Index, asked: DataFrame) -> DataFrame:
    """(qid, shard, bound): the most a query can score in a shard, from its
    blocks' largest counts and smallest lengths.  Reads no posting."""
    most = F.col("max_tf") / (F.col("max_tf") + K1 * ((1 - B) + B * F.col("min_dl") / ix.of_field(1)))
    ends = _of_terms(ix, asked).select("shard", "tid", most.alias("most"))
    return asked.join(ends, "tid").groupBy("qid", "shard").agg(F.sum(F.col("w") * F.col("most")).alias("bound"))


def _of_terms(ix: Index, asked: DataFrame) -> DataFrame:
    """The index's blocks of the terms asked for: other buckets are not read,
    other terms not moved."""
    terms = asked.select("bucket", "field", "term", "tid").distinct()
    blocks = ix.blocks
    if ix.buckets > 1:
        used = [r.bucket for r in terms.select("bucket").distinct().collect()]      # at most MAX_BUCKETS numbers
        blocks = blocks.filter(F.col("bucket").isin(used) if len(used) < ix.buckets else F.lit(True))
    return blocks.join(terms, ["bucket", "field", "term"])


def _scored(ix: Index, asked: DataFrame, n: int, exclude_self: bool, space: Column, starts: DataFrame | None = None) -> DataFrame:
    """(qid, doc, score): of every cell (and space), n best for each query.
    ``starts`` (qid, only, least): the one shard that a query visits (-1: it
    visits all), and a score that n documents are known to reach."""
    hits = _of_terms(ix, asked).select("shard", space.alias("space"), "tid", ix.of_field(1).alias("avgdl"), "docs", "tfs", "dls")
    shards = hits.groupBy("shard", "space").applyInPandas(_pack_shard, "shard int, space string, d_tids binary, sizes binary, ids binary, d_at binary, ws binary")
    count = asked.select("qid").distinct().count()
    groups = max(1, -(-count // GROUP_QUERIES))
    mine = asked.select("qid", "tid", "w", space.alias("space"), F.pmod(F.xxhash64("qid"), F.lit(groups)).alias("g"))
    mine = mine.withColumns({"only": F.lit(-1).cast("long"), "least": F.lit(0.0)}) if starts is None else mine.join(starts, "qid")
    qid = asked.schema["qid"].dataType.simpleString()
    queries = mine.groupBy("g", "space").applyInPandas(
        _pack_queries, f"g long, space string, qids array<{qid}>, at binary, q_tids binary, q_ws binary, only binary, least binary")
    # a groups of queries meet b groups of shards: each side moves little, and what a cell holds is bounded
    cells = 4 * ix.spark.sparkContext.defaultParallelism
    docs = max([1, *(v[0] for v in ix.stats.values())])
    a = min(groups, max(1, round(math.sqrt(cells * count / docs)), -(-count * (50 * n + 500) // HELD_BYTES)))
    b = max(1, min(ix.shards, -(-cells // a)))
    other = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("o")
    held = queries.select("*", other(b)).withColumn("cell", (F.pmod("g", F.lit(a)) * b + F.col("o")).cast("int")).drop("g", "o")
    met = shards.select("*", other(a)).withColumn("cell", (F.col("o") * b + F.pmod("shard", F.lit(b))).cast("int")).drop("o")
    return _dealt(held, met, a * b, "shard").mapInPandas(_score(n, exclude_self), f"qid {qid}, doc long, score double")


def top_n(scores: DataFrame, key: str, n: int) -> DataFrame:
    w = Window.partitionBy(key).orderBy(rank_key("score").desc(), F.col("doc").asc())
    return scores.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n) \
        .select(key, F.col("rank").cast("int").alias("rank"), "doc", "score")


def scored_top(ix: Index, asked: DataFrame, n: int, exclude_self: bool = False, best_field: bool = False,
               prune_shards: int = PRUNE_SHARDS) -> DataFrame:
    """(qid, rank, doc, score): n best documents by the sum over terms, or by
    the best of the fields' sums."""
    asked = weighted(ix, asked)
    space = F.col("field") if best_field else F.lit("")
    starts = None
    if ix.shards >= prune_shards and asked.select("qid").distinct().count() <= GROUP_QUERIES:
        # few queries and many shards: a cell has few shards to learn a bound from, so each query's best one is visited first;
        # bounds over all fields together hold for each of them, too
        one = _visits(ix, asked).groupBy("qid").agg(F.max_by("shard", "bound").cast("long").alias("only")).withColumn("least", F.lit(0.0))
        first = _scored(ix, asked, n, exclude_self, space, one).groupBy("qid", "doc").agg(F.max("score").alias("score"))
        least = top_n(first, "qid", n).filter(F.col("rank") == n).select("qid", F.col("score").alias("least"))
        starts = asked.select("qid").distinct().join(least, "qid", "left") \
            .select("qid", F.lit(-1).cast("long").alias("only"), F.coalesce("least", F.lit(0.0)).alias("least"))
        path = scratch_path(ix.spark, "starts")
        starts.write.parquet(path)
        starts = ix.spark.read.schema(starts.schema).parquet(path)
    found = _scored(ix, asked, n, exclude_self, space, starts)
    if best_field:
        found = found.groupBy("qid", "doc").agg(F.max("score").alias("score"))
    return top_n(found.withColumn("doc", F.col("doc").cast(ix.id_type)), "qid", n)
