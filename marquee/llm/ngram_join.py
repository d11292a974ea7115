"""N-gram Jaccard self-join by multiple global orders (operator 3).

A document's set holds the hashes of its distinct five-word shingles
(lower-cased A-Z).  Two documents link when 100 * |x & y| >= 80 * |x | y|.
A linked pair must share tokens in its prefixes under every global order:

1. hash order, with prefixes a twentieth longer than needed: a document must
   have that many more prefix tokens in common with other documents, so
   texts that merely share a passage leave early;
2. rarity order (document frequency among those left, then hash): the
   buckets from which candidates come, with the size, frequency and position
   bounds of prefix filtering;
3. hash order again, pair by pair: the plain prefixes must overlap.

What passes is verified on the whole sets.  Equal sets are one node, so
copies are never paired; ``linking`` keeps near copies from being paired
with each other.  Tokens and sets are known by 64-bit hashes.

Defined results: no words, no set, linked with nothing; fewer than five
words, one shingle; rows with a null id get no component and link nothing;
rows sharing an id share a component; no rows, no output.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import WordHasher, _mix, among, grams, small_batches, stored
from marquee.llm.linking import link_buckets

SHINGLE = 5


def shingles(hasher: WordHasher, text: str | None, k: int) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    h = hasher.words(text)
    if not len(h):
        return h
    return np.unique(grams(h, min(k, len(h))))


def _key(tokens: np.ndarray) -> int:
    return int(_mix(tokens ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)) if len(tokens) else 0


def sketch(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """(doc_id, n, key): size and hash of each document's set."""
    def run(batches):
        hasher = WordHasher(lower=True)
        for pdf in batches:
            sets = [shingles(hasher, t, k) for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n": [len(s) for s in sets], "key": [_key(s) for s in sets]})

    return docs.mapInPandas(run, "doc_id long, n long, key long")


def _prefixes(docs: DataFrame, k: int) -> DataFrame:
    """(tok, doc_id) of the lengthened hash-order prefixes."""
    def run(batches):
        hasher = WordHasher(lower=True)
        for pdf in batches:
            sets = [shingles(hasher, t, k) for t in pdf["text"]]
            sets = [s[:len(s) // 5 + 1 + len(s) // 20] for s in sets]
            sizes = [len(s) for s in sets]
            if sum(sizes):
                yield pd.DataFrame({"tok": np.concatenate(sets).view(np.int64), "doc_id": np.repeat(pdf["doc_id"].to_numpy(), sizes)})

    return docs.mapInPandas(run, "tok long, doc_id long")


_SIGN = np.uint64(1 << 63)


def _whole_sets(docs: DataFrame, k: int) -> DataFrame:
    """(key, n, cut, toks): ``cut`` is the last token of the plain hash-order
    prefix, shifted so that Spark's signed longs have the hashes' order."""
    def run(batches):
        hasher = WordHasher(lower=True)
        for pdf in batches:
            sets = [shingles(hasher, t, k) for t in pdf["text"]]
            cuts = [int((s[len(s) // 5] ^ _SIGN).view(np.int64)) if len(s) else 0 for s in sets]
            yield pd.DataFrame({"key": [_key(s) for s in sets], "n": [len(s) for s in sets], "cut": cuts, "toks": [s.view(np.int64) for s in sets]})

    return docs.mapInPandas(run, "key long, n long, cut long, toks array<long>").filter("n > 0")


def jaccard_components(docs: DataFrame, k: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id for every row."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = stored(sketch(docs, k), "ngram-sketch")
    known = docs.filter("doc_id is not null")
    classes = rows.filter("n > 0 and doc_id is not null").groupBy("key", "n").agg(F.min("doc_id").alias("doc_id"))

    # order 1: enough prefix tokens that other documents' prefixes hold too
    # (counted where they lie, so prefixes are made and moved once)
    times = F.count("*").over(Window.partitionBy("tok"))
    common = _prefixes(known, k).withColumn("c", times).filter("c > 1").groupBy("doc_id").agg(F.count("*").alias("h"))
    least = 1 + F.floor(F.ceil(F.col("n") * 4 / 5) / 20)
    alive = stored(classes.join(common, "doc_id").filter(F.col("h") >= least).select("doc_id").distinct(), "ngram-alive")

    # order 2: document frequencies among those left (texts stay where they
    # lie; the few others that come along can link with nothing)
    whole = stored(_whole_sets(among(known, "doc_id", alive), k), "ngram-sets")
    flat = whole.select("key", "n", "cut", F.explode("toks").alias("tok"))
    sets = flat.withColumn("c", times).filter("c > 1").groupBy("key", "n", "cut").agg(F.sort_array(F.collect_set(F.struct("c", "tok"))).alias("t"))
    sets = sets.withColumn("s", F.size("t").cast("long")).filter("5 * s >= 4 * n")
    sets = stored(sets.select(F.col("key").alias("rid"), "n", "cut", "s", "t", F.aggregate(
        "t", F.lit(0).cast("long"), lambda a, t: a + t["c"]).alias("sum_c")), "ngram-core")
    lone = F.col("n") - F.col("s")                      # tokens of no other document come first
    take = F.greatest(F.lit(0).cast("long"), F.floor(F.col("n") / 5) + 1 - lone).cast("int")
    buckets = sets.select("rid", "n", "s", (F.col("sum_c") / F.col("n")).alias("w"), lone.alias("lone"),
                          F.posexplode(F.slice(F.transform("t", lambda t: t["tok"]), F.lit(1), take)).alias("i", "bkt")) \
        .select("bkt", "rid", "n", "s", "w", (F.col("lone") + F.col("i")).alias("pos"))

    def size_ok(x, y):
        n = F.col(f"{x}.n") + F.col(f"{y}.n")
        return (9 * F.least(f"{x}.s", f"{y}.s") >= 4 * n) & (5 * F.least(f"{x}.n", f"{y}.n") >= 4 * F.greatest(f"{x}.n", f"{y}.n"))

    def place_ok(x, y):
        rest = lambda c: F.col(f"{c}.n") - F.col(f"{c}.pos")
        return size_ok(x, y) & (9 * F.least(rest(x), rest(y)) >= 4 * (F.col(f"{x}.n") + F.col(f"{y}.n")))

    front = F.transform(F.filter("t", lambda t: t["tok"].bitwiseXOR(F.lit(-(1 << 63))) <= F.col("cut")), lambda t: t["tok"])
    held = sets.select("rid", "n", F.transform("t", lambda t: t["tok"]).alias("toks"), front.alias("front"))

    def verify(pairs):
        ids = pairs.select(F.explode(F.array("x", "y")))
        few = among(held, "rid", ids)
        side = lambda c: few.select(F.col("rid").alias(c), *[F.col(v).alias(f"{c}_{v}") for v in ("n", "toks", "front")])
        both = pairs.join(side("x"), "x").join(side("y"), "y").filter(F.arrays_overlap("x_front", "y_front"))
        same = F.size(F.array_intersect("x_toks", "y_toks"))
        return both.withColumn("i", same).filter("100 * i >= 80 * (x_n + y_n - i)").select("x", "y")

    labels = link_buckets(buckets, verify, place_ok, size_ok)

    ids = classes.join(labels.select(F.col("node").alias("key"), "comp"), "key", "left") \
        .withColumn("comp", F.coalesce("comp", "key"))
    low = ids.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    ids = ids.join(low, "comp").select("key", "n", "component_id")
    out = rows.join(ids, ["key", "n"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
