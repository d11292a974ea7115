"""Hard negatives for contrastive training by Hilbert blocks (operator 12).

Candidates are sorted along a Hilbert curve through all dimensions, within
their label, and cut into blocks, each a row of a Parquet table with a zone
map: the smallest and largest value of every dimension.  An anchor times a
zone map, in interval arithmetic, bounds the scores that the block can hold:
with weight w, a dimension contributes between min(w lo, w hi) and
max(w lo, w hi).  An anchor's own block (its neighbours on the curve) gives
the score that its last positive has at least; the blocks of its label whose
upper bound reaches it are read for the positives.  Each positive's score s
opens a window [s * low, s * high], and the blocks of other labels whose
bounds meet a window are read for its negatives.

Anchors are read in groups of neighbours on the curve.  A group meets a block
once, if any of its anchors needs it, and only those anchors are scored.
Every group meets every zone map (in pages of many), which costs two numbers
per dimension and block, not per row.

Defined results: rows with a null id, label or vector, an empty vector, or a
null or non-finite component take no part; only vectors of one length are
compared; ties go to the smaller id; of rows that share an id one is the
anchor (smallest vector hash, then label), and none is its positive or
negative; a negative score opens no window.  Scores are exact; one beyond 64
bits in a result is an error.  No rows, no output.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import stored
from marquee.llm.topk import _floor

BITS = 4                  # of each dimension in the Hilbert order
BLOCK_ROWS = 1024
GROUP_ROWS = 512
PAGE_ZONES = 512
EXACT = 2.0**53           # products below are whole numbers in doubles
BLOCK = "block long, d int, label long, n int, asked binary, ids binary, form string, mat binary, lo binary, hi binary"
GROUP = "g long, d int, ids binary, labels binary, form string, mat binary, least binary, windows binary"


def quantised(vectors: DataFrame, label: Column, asked: Column, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(id, label, asked, d, v) of the rows that take part; v holds whole
    numbers as doubles."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.coalesce(asked, F.lit(False)).alias("asked"),
                          F.transform(F.col(vec_col), lambda x: x.cast("double")).alias("v"))
    rows = rows.filter("id is not null and label is not null and v is not null and size(v) > 0").filter(~F.exists("v", bad))
    return rows.select("id", "label", "asked", F.size("v").alias("d"), F.transform("v", lambda x: _floor(x * scale)).alias("v"))


# ------------------------------------------------------------ Hilbert curve

def hilbert_keys(points: np.ndarray, bits: int) -> list[bytes]:
    """Places on the Hilbert curve of points (rows of whole numbers below
    2^bits), as bytes that sort like them.  The curve's axes are turned and
    mirrored bit by bit from the top, then Gray-coded (Skilling 2004)."""
    x = points.T.astype(np.int64).copy()
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for i in range(len(x)):
            up = (x[i] & q) != 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(up, low, swap)
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.int64)
    q = top
    while q > 1:
        turn ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turn
    planes = [(x >> b & 1).astype(np.uint8).T for b in range(bits - 1, -1, -1)]
    return [r.tobytes() for r in np.packbits(np.concatenate(planes, axis=1), axis=1)]


def with_keys(rows: DataFrame, lo: float, hi: float, bits: int = BITS) -> DataFrame:
    """The rows with ``key``: components are scaled from [lo, hi]."""
    width = max(hi - lo, 1.0)

    def run(batches):
        for pdf in batches:
            key = np.empty(len(pdf), object)
            for _, at in pdf.groupby("d").indices.items():
                mat = np.stack(pdf["v"].to_numpy()[at])
                key[at] = hilbert_keys(np.minimum((mat / width - lo / width) * 2**bits, 2**bits - 1).astype(np.int64), bits)
            pdf["key"] = key
            yield pdf

    return rows.mapInPandas(run, "id long, label long, asked boolean, d int, v array<double>, key binary")


# ------------------------------------------------------------------ blocks

def _packed(mat: np.ndarray) -> tuple[str, bytes]:
    """The matrix in the smallest whole-number type that holds it."""
    most = np.abs(mat).max(initial=0)
    form = "<i2" if most < 2**15 else "<i4" if most < 2**31 else "<f8"
    return form, mat.astype(form).tobytes()


def _matrix(form: str, mat: bytes, d: int) -> np.ndarray:
    return np.frombuffer(mat, form).reshape(-1, d).astype(np.float64)


def _cut(batches, same: list[str], size: int):
    """Pieces of a sorted partition: at most ``size`` rows, equal in ``same``."""
    held = None
    for pdf in batches:
        pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
        held = None
        if not len(pdf):
            continue
        begin = np.flatnonzero((pdf[same] != pdf[same].shift()).any(axis=1))
        ends = np.append(begin[1:], len(pdf))
        for a, b in zip(begin, ends):
            for at in range(a, b, size):
                piece = pdf.iloc[at:min(at + size, b)]
                if b == len(pdf) and at + size >= b:
                    held = piece
                else:
                    yield piece
    if held is not None and len(held):
        yield held


def hilbert_blocks(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The blocks, written as Parquet."""
    rows = stored(rows, "negatives-rows")
    span = rows.agg(F.min(F.array_min("v")).alias("lo"), F.max(F.array_max("v")).alias("hi")).first()
    keyed = with_keys(rows, span["lo"] or 0.0, span["hi"] or 0.0)

    def run(batches):
        from pyspark import TaskContext
        name = TaskContext.get().partitionId() << 32
        for k, pdf in enumerate(_cut(batches, ["d", "label"], block_rows)):
            mat = np.stack(pdf["v"].to_numpy())
            form, data = _packed(mat)
            yield pd.DataFrame([{"block": name + k, "d": mat.shape[1], "label": int(pdf["label"].iloc[0]), "n": len(pdf),
                                 "asked": pdf["asked"].to_numpy(bool).tobytes(), "ids": pdf["id"].to_numpy(np.int64).tobytes(), "form": form, "mat": data,
                                 "lo": mat.min(axis=0).tobytes(), "hi": mat.max(axis=0).tobytes()}])

    order = ["d", "label", "key", "id"]       # the id splits copies of one vector
    return stored(keyed.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(run, BLOCK), "negatives-blocks")


# ------------------------------------------------------------------ scores

def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles where that is exact, else in Python's
    whole numbers (an array of objects)."""
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1] < EXACT:
        return a @ b.T
    whole = lambda m: np.array([int(x) for x in m.ravel()], object).reshape(m.shape)
    return whole(a).dot(whole(b).T)


def _best(score: np.ndarray, allowed: np.ndarray, ids: np.ndarray, k: int):
    """(row, column) of each row's k best allowed scores, ties to smaller ids."""
    if score.dtype != object and score.shape[1] > k:
        masked = np.where(allowed, score, -np.inf)
        allowed = allowed & (masked >= np.partition(masked, -k, axis=1)[:, -k:].min(axis=1, keepdims=True))
    row, col = np.nonzero(allowed)
    value = score[row, col]
    if score.dtype == object:
        order = np.array(sorted(range(len(row)), key=lambda i: (row[i], -value[i], ids[col[i]])), np.int64)
    else:
        order = np.lexsort((ids[col], -value, row))
    row, col = row[order], col[order]
    begin = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.zeros(0, np.int64)
    place = np.arange(len(row)) - np.repeat(begin, np.diff(np.append(begin, len(row))))
    return row[place < k], col[place < k]


def _long(values) -> np.ndarray:
    if any(abs(int(v)) >= 2**63 for v in values):
        raise OverflowError("a score does not fit in 64 bits")
    return np.array([int(v) for v in values], np.int64)


def anchors_of(blocks: DataFrame, k: int) -> DataFrame:
    """(id, label, d, block, place, v, least): the anchors in their order on
    the curve, and the k-th best score of an anchor in its own block (null
    if that has fewer)."""
    def run(batches):
        for pdf in batches:
            for r in pdf.itertuples():
                at = np.flatnonzero(np.frombuffer(r.asked, bool))
                if not len(at):
                    continue
                ids, mat = np.frombuffer(r.ids, np.int64), _matrix(r.form, r.mat, r.d)
                for a in range(0, len(at), GROUP_ROWS):
                    use = at[a:a + GROUP_ROWS]
                    score = _scores(mat[use], mat).astype(np.float64)
                    allowed = ids[use][:, None] != ids[None, :]
                    least = np.full(len(use), np.nan)
                    if len(ids) >= k:
                        kth = np.partition(np.where(allowed, score, -np.inf), -k, axis=1)[:, -k:].min(axis=1)
                        least[np.isfinite(kth)] = kth[np.isfinite(kth)]
                    yield pd.DataFrame({"id": ids[use], "label": r.label, "d": r.d, "block": r.block, "place": use, "v": list(mat[use]), "least": least})

    found = blocks.select("block", "d", "label", "asked", "ids", "form", "mat").mapInPandas(
        run, "id long, label long, d int, block long, place long, v array<double>, least double")
    one = Window.partitionBy("id").orderBy(F.xxhash64("v"), "label", "block", "place")
    found = found.withColumn("r", F.row_number().over(one)).filter("r = 1").drop("r")
    return found.withColumn("least", F.when(F.isnan("least"), None).otherwise(F.col("least")))


def _groups(anchors: DataFrame, slots: int) -> DataFrame:
    """Anchors packed in groups, with ``least`` and the scores of up to
    ``slots`` positives (``scores``; lowest number: none)."""
    def run(batches):
        from pyspark import TaskContext
        name = TaskContext.get().partitionId() << 32
        for k, pdf in enumerate(_cut(batches, ["d"], GROUP_ROWS)):
            form, data = _packed(np.stack(pdf["v"].to_numpy()))
            windows = np.full((len(pdf), slots), -2**63, np.int64)
            for i, s in enumerate(pdf["scores"]):
                windows[i, :len(s)] = s
            yield pd.DataFrame([{"g": name + k, "d": int(pdf["d"].iloc[0]), "ids": pdf["id"].to_numpy(np.int64).tobytes(),
                                 "labels": pdf["label"].to_numpy(np.int64).tobytes(), "form": form, "mat": data,
                                 "least": pdf["least"].fillna(-np.inf).to_numpy(np.float64).tobytes(), "windows": windows.tobytes()}])

    order = ["d", "block", "place"]
    return stored(anchors.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(run, GROUP), "negatives-groups")


def _pages(blocks: DataFrame, page_zones: int) -> tuple[DataFrame, int]:
    """Zone maps packed in pages."""
    pages = max(1, -(-blocks.count() // page_zones))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([{"page": int(pdf["page"].iloc[0]), "d": int(pdf["d"].iloc[0]), "blocks": pdf["block"].to_numpy(np.int64).tobytes(),
                              "block_labels": pdf["label"].to_numpy(np.int64).tobytes(), "lo": b"".join(pdf["lo"]), "hi": b"".join(pdf["hi"])}])

    zones = blocks.select("block", "d", "label", "lo", "hi").withColumn("page", F.pmod(F.xxhash64("block"), F.lit(pages)))
    return zones.groupBy("page", "d").applyInPandas(pack, "page long, d int, blocks binary, block_labels binary, lo binary, hi binary"), pages


def bounds(weights: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each row of weights with any point
    of each box, widened where doubles may round."""
    up, down = np.maximum(weights, 0), np.minimum(weights, 0)
    least, most = up @ lo.T + down @ hi.T, up @ hi.T + down @ lo.T
    size = np.abs(weights) @ np.maximum(np.abs(lo), np.abs(hi)).T
    slack = np.where(size < EXACT, 0.0, size * 1e-12)
    return least - slack, most + slack


def _window(scores: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Whole scores from ``low`` to ``high`` hundredths of a positive's; none
    where the positive is missing or its score is below zero."""
    share = lambda part: np.array([part(int(s)) for s in scores.ravel()], object).reshape(scores.shape)
    real = scores >= 0
    first, last = np.where(real, share(lambda s: -(-low * s // 100)), 1), np.where(real, share(lambda s: high * s // 100), 0)
    return first, last


def _needed(groups: DataFrame, pages: DataFrame, n_pages: int, slots: int, limits: tuple[int, int] | None) -> DataFrame:
    """(g, block) to read: for positives (no limits), blocks of an anchor's
    label that may reach its least score; else blocks of other labels that
    may hold a score in one of its windows."""
    def run(batches):
        for pdf in batches:
            for r in pdf.itertuples():
                names, their = np.frombuffer(r.blocks, np.int64), np.frombuffer(r.block_labels, np.int64)
                least, most = bounds(_matrix(r.form, r.mat, r.d), *(np.frombuffer(z, np.float64).reshape(-1, r.d) for z in (r.lo, r.hi)))
                same = np.frombuffer(r.labels, np.int64)[:, None] == their[None, :]
                if limits is None:
                    need = same & (most >= np.frombuffer(r.least, np.float64)[:, None])
                else:
                    first, last = _window(np.frombuffer(r.windows, np.int64).reshape(-1, slots), *limits)
                    need = np.zeros(same.shape, bool)
                    for j in range(slots):
                        a, z = first[:, j].astype(np.float64)[:, None], last[:, j].astype(np.float64)[:, None]
                        near = np.abs(z) * 1e-12 * (np.abs(z) >= EXACT)
                        need |= ~same & (a <= z) & (most >= a - near) & (least <= z + near)
                yield pd.DataFrame({"g": r.g, "block": names[need.any(axis=0)]})

    spread = groups.withColumn("page", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_pages - 1).cast("long"))))
    return spread.join(pages, ["page", "d"]).repartition("g", "page").mapInPandas(run, "g long, block long")


def _read(groups: DataFrame, blocks: DataFrame, needed: DataFrame, slots: int, k: int, limits: tuple[int, int] | None) -> DataFrame:
    """(anchor, slot, vec, score): each block's k best for every anchor of a
    group (slot 0), or for each of its windows."""
    def run(batches):
        for pdf in batches:
            for r in pdf.itertuples():
                own, ids = np.frombuffer(r.g_ids, np.int64), np.frombuffer(r.ids, np.int64)
                score = _scores(_matrix(r.g_form, r.g_mat, r.d), _matrix(r.form, r.mat, r.d))
                same = np.repeat((np.frombuffer(r.labels, np.int64) == r.label)[:, None], len(ids), axis=1)
                other = own[:, None] != ids[None, :]
                if limits is None:
                    asked = [(0, same & other)]
                else:
                    first, last = _window(np.frombuffer(r.windows, np.int64).reshape(-1, slots), *limits)
                    exact = first if score.dtype == object else first.astype(np.float64), last if score.dtype == object else last.astype(np.float64)
                    asked = [(j, ~same & other & (score >= exact[0][:, j:j + 1]).astype(bool) & (score <= exact[1][:, j:j + 1]).astype(bool))
                             for j in range(slots)]
                for slot, allowed in asked:
                    row, col = _best(score, allowed, ids, k)
                    if len(row):
                        yield pd.DataFrame({"anchor": own[row], "slot": slot, "vec": ids[col], "score": _long(score[row, col])})

    mine = groups.select("g", F.col("ids").alias("g_ids"), "labels", F.col("form").alias("g_form"), F.col("mat").alias("g_mat"), "windows")
    theirs = blocks.select("block", "d", "label", "ids", "form", "mat")
    met = needed.join(mine, "g").join(theirs, "block")
    return met.mapInPandas(run, "anchor long, slot int, vec long, score long")


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, label: Column, asked: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
                   scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding", block_rows: int = BLOCK_ROWS,
                   page_zones: int = PAGE_ZONES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score): for the rows ``asked`` for, the first ``negatives`` rows
    of other labels that score ``low`` to ``high`` hundredths of each of
    their ``positives`` best rows of the same label."""
    blocks = hilbert_blocks(quantised(vectors, label, asked, id_col, vec_col, scale), block_rows)
    pages, n_pages = _pages(blocks, page_zones)
    pages = stored(pages, "negatives-zones")
    anchors = stored(anchors_of(blocks, positives), "negatives-anchors")
    groups = _groups(anchors.withColumn("scores", F.array().cast("array<long>")), positives)
    found = _read(groups, blocks, stored(_needed(groups, pages, n_pages, positives, None), "negatives-needed"), positives, positives, None)
    liked = stored(_first(found, ["anchor"], positives).select("anchor", (F.col("rank") - 1).alias("slot"), F.col("vec").alias("positive_id"),
                                                               F.col("score").alias("positive_score")), "negatives-positives")
    scores = liked.groupBy(F.col("anchor").alias("id")).agg(F.array_sort(F.collect_list(F.struct("slot", "positive_score"))).alias("s")) \
        .select("id", F.transform("s", lambda x: x["positive_score"]).alias("scores"))
    groups = _groups(anchors.join(scores, "id"), positives)
    found = _read(groups, blocks, stored(_needed(groups, pages, n_pages, positives, (low, high)), "negatives-needed"), positives, negatives, (low, high))
    return _first(found, ["anchor", "slot"], negatives).join(liked, ["anchor", "slot"]).select(
        F.col("anchor").alias("anchor_id"), "positive_id", "rank", F.col("vec").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
