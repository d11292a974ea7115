"""Language identification by averaged subword embeddings (operator 11).

A text, in lower case and between two spaces, is seen as the byte n-grams
(2 to 5 bytes) within its words, where the space before or after a word may
be an n-gram's end.  Each n-gram is hashed to one of ``BUCKETS`` rows of an
embedding table; the mean of a text's embeddings goes through a linear layer
and a softmax over the languages.

Embeddings and layer are trained by stochastic gradient descent in numpy, in
one task, on a bounded sample of labelled rows: per language the ``per_lang``
of smallest id hash, ``sample`` rows in all, languages in turn.  A fifth of
the sample (by id) is kept from training; on it a temperature is fitted to
the scores, and the lowest score at which accepted texts are right in
``precision`` of cases is the limit below which a text is rejected.

Prediction needs embedding and layer only as one table of logits per bucket,
held in whole numbers, so that a text's sums do not depend on what is added
first.  Whole texts are read, a bounded piece at a time.

Defined results: a text that is null or has no letter is ``und`` with score
0 and rejected, and so is every text where nothing could be learned; rows
without a label, an id or a letter are not learned from; equal scores go to
the smaller name; repeated rows get the same answer; no rows, no output.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import stored

BITS = 15
BUCKETS = 1 << BITS
SIZES = (2, 3, 4, 5)      # bytes of an n-gram
PIECE = 1 << 18           # bytes looked up at once
FIXED = 1 << 24           # logits are held in this part of one
UNKNOWN = "und"
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def _pieces(texts: list):
    """(first text, starts, bucket of every n-gram start) of the texts side by
    side, each between two spaces, in pieces; ``BUCKETS`` where there is no
    n-gram.  ``starts``: where texts begin in the piece (the first at 0)."""
    raw = [b" " + (t or "").lower().encode("utf-8", "surrogatepass") + b" " for t in texts]
    begin = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    whole = np.frombuffer(b"".join(raw), np.uint8)
    for a in range(0, len(whole), PIECE):
        z = min(a + PIECE, len(whole))
        part = np.concatenate([whole[a:z + SIZES[-1]], np.full(SIZES[-1], 32, np.uint8)])
        gap = SPACE[part]
        code = np.where(gap, 32, part).astype(np.uint32) + np.uint32(1)
        n = z - a
        first = int(np.searchsorted(begin, a, "right")) - 1
        last = int(np.searchsorted(begin, z, "left"))
        starts = np.maximum(begin[first:last] - a, 0)
        h, open_ = code[:n].copy(), np.ones(n, bool)
        for k in range(1, SIZES[-1]):
            h = h * np.uint32(0x01000193) + code[k:k + n]
            if k > 1:
                open_ &= ~gap[k - 1:k - 1 + n]
            if k + 1 in SIZES:
                some = open_ if k > 1 else ~(gap[:n] & gap[1:1 + n])
                mixed = (h ^ h >> np.uint32(15)) * np.uint32(0x2C1B3C6D) + np.uint32(k)
                mixed = (mixed ^ mixed >> np.uint32(12)) * np.uint32(0x297A2D39)
                yield first, starts, np.where(some, mixed >> np.uint32(32 - BITS), np.uint32(BUCKETS))


def counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, times) of a text's n-grams."""
    total = np.zeros(BUCKETS + 1, np.int64)
    for _, _, bucket in _pieces([text]):
        total += np.bincount(bucket, minlength=BUCKETS + 1)
    at = np.flatnonzero(total[:BUCKETS])
    return at.astype("<u2"), total[at].astype("<u4")


def logits(texts: list, table: np.ndarray) -> np.ndarray:
    """Sum of the table's rows over each text's n-grams; the table's last
    column counts them."""
    out = np.zeros((len(texts), table.shape[1]), np.int64)
    for first, starts, bucket in _pieces(texts):
        out[first:first + len(starts)] += np.add.reduceat(table[bucket], starts, axis=0)
    return out


# ----------------------------------------------------------------- learning

def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def descend(docs: list, truth: np.ndarray, n_lang: int, dim: int = 16, epochs: int = 8, batch: int = 32, rate: float = 1.0, seed: int = 11):
    """(embeddings, layer, offset) by SGD on the cross entropy; ``docs`` are
    (bucket, times) pairs.  An embedding's step is not shrunk by the length
    of the text: its gradient is scaled by ``BUCKETS`` / 32."""
    rng = np.random.default_rng(seed)
    emb = rng.uniform(-1, 1, (BUCKETS, dim)).astype(np.float32) / np.float32(dim)
    layer, offset = np.zeros((dim, n_lang), np.float32), np.zeros(n_lang, np.float32)
    steps = max(1, epochs * -(-len(docs) // batch))
    done = 0
    for _ in range(epochs):
        order = rng.permutation(len(docs))
        for a in range(0, len(order), batch):
            use = order[a:a + batch]
            x = np.zeros((len(use), BUCKETS), np.float32)
            for i, d in enumerate(use):
                x[i, docs[d][0]] = docs[d][1] / docs[d][1].sum()
            mean = x @ emb
            grad = softmax(mean @ layer + offset)
            grad[np.arange(len(use)), truth[use]] -= 1
            grad /= len(use)
            step = np.float32(rate * (1 - done / steps))
            back = grad @ layer.T
            layer -= step * 8 * (mean.T @ grad)
            offset -= step * grad.sum(axis=0)
            touched = np.flatnonzero(x.any(axis=0))
            emb[touched] -= step * np.float32(BUCKETS / 32) * (x[:, touched].T @ back)
            done += 1
    return emb, layer, offset


def calibrate(scores: np.ndarray, truth: np.ndarray, precision: float) -> tuple[float, float]:
    """(temperature, least accepted score) on logits not trained on."""
    if not len(scores):
        return 1.0, 0.0
    grid = np.exp(np.linspace(-2.5, 2.5, 101))
    loss = [-np.log(np.maximum(softmax(scores / t)[np.arange(len(truth)), truth], 1e-12)).mean() for t in grid]
    warm = float(grid[int(np.argmin(loss))])
    p = softmax(scores / warm)
    best, right = p.max(axis=1), p.argmax(axis=1) == truth
    order = np.argsort(-best, kind="stable")
    share = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero((share >= precision) & np.append(best[order][1:] < best[order][:-1], True))
    return warm, float(best[order][good[-1]]) if len(good) else 1.0


@dataclass
class Model:
    """``table``: whole-number logits per bucket (one row more, of zeros, and
    one column more, of ones: the count)."""
    langs: list
    table: np.ndarray
    offset: np.ndarray
    temperature: float
    least: float

    def predict(self, texts: list) -> tuple[list, np.ndarray]:
        if not texts or not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        total = logits(texts, self.table)
        mean = total[:, :-1] / np.maximum(total[:, -1:], 1) / FIXED + self.offset
        p = softmax(mean / self.temperature)
        return [self.langs[i] for i in p.argmax(axis=1)], p.max(axis=1)


def _learn(pdf: pd.DataFrame, precision: float, seed: int) -> Model:
    pdf = pdf.sort_values(["lang", "doc_id"], kind="stable")
    docs = [(np.frombuffer(b, "<u2"), np.frombuffer(c, "<u4").astype(np.float32)) for b, c in zip(pdf["bucket"], pdf["times"])]
    kept = pdf["keep"].to_numpy(bool)
    langs = sorted(set(pdf["lang"]))
    truth = pdf["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(np.int64)
    # a language that the fifth kept back holds alone is trained on as well
    only = ~np.isin(truth, truth[~kept])
    train = np.flatnonzero(~kept | only)
    emb, layer, offset = descend([docs[i] for i in train], truth[train], len(langs), seed=seed)
    flat = np.rint((emb @ layer).astype(np.float64) * FIXED).astype(np.int64)
    table = np.zeros((BUCKETS + 1, len(langs) + 1), np.int64)
    table[:-1, :-1], table[:-1, -1] = flat, 1
    offset = offset.astype(np.float64)
    test = np.flatnonzero(kept)
    raw = np.array([(flat[docs[i][0]] * docs[i][1].astype(np.int64)[:, None]).sum(axis=0) / docs[i][1].sum(dtype=np.float64) / FIXED + offset for i in test])
    warm, least = calibrate(raw, truth[test], precision)
    return Model(langs, table, offset, warm, least)


def train(docs: DataFrame, learn: Column, keep: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample: int = 4096, per_lang: int = 1024, precision: float = 0.99, seed: int = 11) -> Model:
    """A model from the rows with ``learn``; those with ``keep`` calibrate."""
    rows = docs.filter(learn & F.col(lang_col).isNotNull() & F.col(id_col).isNotNull())
    rows = rows.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"),
                       F.coalesce(keep, F.lit(False)).alias("keep"))
    chance = F.xxhash64(F.lit(seed), F.col("doc_id"))
    # a common language is ranked in 64 parts first, each of which keeps few
    inner = Window.partitionBy("lang", "part").orderBy("chance", "doc_id")
    part = rows.select("doc_id", "lang", chance.alias("chance"), F.pmod(chance, F.lit(64)).alias("part"))
    part = part.withColumn("p", F.row_number().over(inner)).filter(F.col("p") <= per_lang)
    whole = Window.partitionBy("lang").orderBy("chance", "doc_id")
    picked = part.withColumn("r", F.row_number().over(whole)).filter(F.col("r") <= per_lang)
    picked = picked.orderBy("r", "lang").limit(sample).select("doc_id", "lang").distinct()      # at most ``sample`` rows
    chosen = rows.join(F.broadcast(picked), ["doc_id", "lang"]).filter(has_letter(F.col("text"))).dropDuplicates(["doc_id", "lang"])

    def features(batches):
        for pdf in batches:
            got = [counts(t) for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype(str), "lang": pdf["lang"], "keep": pdf["keep"],
                                "bucket": [b.tobytes() for b, _ in got], "times": [c.tobytes() for _, c in got]})

    # AQE may put the few rows in one partition; their texts are worth many tasks
    found = stored(chosen.repartition(docs.sparkSession.sparkContext.defaultParallelism, "doc_id").mapInPandas(
        features, "doc_id string, lang string, keep boolean, bucket binary, times binary"), "lang-features")

    def fit(batches):
        batches = [b for b in batches if len(b)]
        if batches:
            m = _learn(pd.concat(batches, ignore_index=True), precision, seed)
            yield pd.DataFrame([{"langs": m.langs, "table": m.table.astype("<i8").tobytes(), "offset": m.offset.tobytes(),
                                 "temperature": m.temperature, "least": m.least}])

    got = found.coalesce(1).mapInPandas(fit, "langs array<string>, table binary, offset binary, temperature double, least double").collect()
    if not got:
        return Model([], np.zeros((BUCKETS + 1, 1), np.int64), np.zeros(0), 1.0, 1.0)
    r = got[0]
    return Model(list(r.langs), np.frombuffer(r.table, "<i8").reshape(BUCKETS + 1, -1), np.frombuffer(r.offset, np.float64), r.temperature, r.least)


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The input rows (without columns of these names) with ``lang_pred``,
    ``score`` and ``accepted``."""
    made = ("lang_pred", "score", "accepted", "__text")
    docs = docs.drop(*[c for c in made if c in docs.columns])
    rows = docs.withColumn("__text", F.when(has_letter(F.col(text_col)), F.col(text_col)))
    kind = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                         T.StructField("accepted", T.BooleanType())])

    def run(batches):
        for batch in batches:
            texts = batch.column("__text").to_pylist()
            known = [i for i, t in enumerate(texts) if t is not None]
            langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if known:
                got, p = model.predict([texts[i] for i in known])
                scores[known] = p
                for i, lang in zip(known, got):
                    langs[i] = lang
            accepted = (scores >= model.least) & (scores > 0)
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i, c in enumerate(batch.schema.names) if c != "__text"],
                                              pa.array(langs, pa.string()), pa.array(scores), pa.array(accepted)],
                                             names=[*[c for c in batch.schema.names if c != "__text"], "lang_pred", "score", "accepted"])

    return rows.mapInArrow(run, kind)
