"""Exact pruning for products of factor tables.

Similarity: unit vectors are gathered around pivots and cut into blocks with
a centroid and an angular radius.  By the triangle inequality two blocks hold
no pair within an angle unless their centroids are at most that angle plus
both radii apart, so other block pairs are never built.

Top-k: items are cut into blocks by falling norm.  A user's score of an item
is at most the product of their norms, so once the k-th best score reaches
the user's norm times a block's largest norm, that block and all after it
are left out.  Every user first meets the block of the largest norms; users
are then gathered by the norm that an item must have to still matter to
them, and each gathering meets only the blocks that reach it.

Scores are looked at in tiles of single numbers first, and only pairs that
come near to what the user needs are multiplied in full.

Block pairs meet in cells: both sides are dealt into a few groups, and a task
gets one group of each side, holds the first and streams the second.  Each
vector is so moved once per group of the other side, not once per block pair,
and the groups' number follows from the cluster's cores; it grows only where
a held group would pass ``HELD_BYTES``.

Where only some movies' pairs are asked for, the held side has their rows
alone.  Where each movie's pairs are wanted as one list, rows are dealt by
their id and a task streams all blocks past its rows, so lists are whole when
they leave it and no pair is moved.

Only the pivots and a sample (bounded numbers of vectors), sizes and the name
of one block pass the driver.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.schemas import RECS
from marquee.session import scratch_path

MAX_PIVOTS = 1024
PAGE_BLOCKS = 512
SLACK = 1e-7              # of an angle or a norm, far above rounding
HELD_BYTES = 64 << 20     # of the vectors that a task holds
AT_ONCE = 4096            # held rows multiplied at once
TILE = 512                # rows and columns of products that stay in a core's cache
ROWS_OUT = 200_000        # rows gathered before they leave a task
LIST_BYTES = 256 << 20    # of the lists that a task gathers
TASK_ROWS = 64            # lists that are worth a task
SAMPLE = 1024             # vectors that tell how many pairs to expect


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _pieces(batches, same: str | None, size: int):
    """A sorted partition in pieces of at most ``size`` rows, equal in ``same``."""
    held = None
    for pdf in batches:
        pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
        held = None
        if not len(pdf):
            continue
        begin = np.flatnonzero(pdf[same] != pdf[same].shift()) if same else np.zeros(1, np.int64)
        for a, b in zip(begin, np.append(begin[1:], len(pdf))):
            for at in range(a, b, size):
                piece = pdf.iloc[at:min(at + size, b)]
                if b == len(pdf) and at + size >= b:
                    held = piece
                else:
                    yield piece
    if held is not None and len(held):
        yield held


def _named():
    from pyspark import TaskContext
    return TaskContext.get().partitionId() << 32


def usable(factors: DataFrame, id_col: str, feat_col: str) -> DataFrame:
    """(id, v): rows with a vector of finite numbers and a norm above zero."""
    f = factors.select(F.col(id_col).cast("int").alias("id"), F.col(feat_col).cast("array<double>").alias("v"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return f.filter("id is not null and v is not null and size(v) > 0").filter(~F.exists("v", bad) & F.exists("v", lambda x: x != 0))


# ------------------------------------------------------------------- cells

def _cells(blocks: DataFrame) -> int:
    """Tasks to aim at."""
    return 4 * blocks.sparkSession.sparkContext.defaultParallelism


def _groups(blocks: DataFrame, others: float | None = None) -> int:
    """Groups that the blocks are dealt into, to meet ``others`` groups
    (default: as many)."""
    size = blocks.agg(F.count("*").alias("n"), F.sum(F.length("mat")).alias("bytes")).first()
    few = math.ceil(math.sqrt(_cells(blocks)) if others is None else _cells(blocks) / others)
    return max(1, min(size.n, max(few, -(-(size.bytes or 0) // HELD_BYTES))))


def _group(groups: int):
    return F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int")


def _dealt(held: DataFrame, met: DataFrame, cells: int, order: str) -> DataFrame:
    """Both sides by ``cell``, the held one first, the other along ``order``."""
    rows = held.withColumn("met", F.lit(0)).unionByName(met.withColumn("met", F.lit(1)), allowMissingColumns=True)
    return rows.repartitionById(cells, "cell").sortWithinPartitions("cell", "met", order)


def _by_cell(batches):
    """(held rows, met rows) of each cell; the met rows are an iterator."""
    rows = (r for pdf in batches for r in pdf.itertuples())
    for _, of_cell in itertools.groupby(rows, lambda r: r.cell):
        held, first = [], None
        for r in of_cell:
            if r.met:
                first = r
                break
            held.append(r)
        if held and first is not None:
            yield held, itertools.chain([first], of_cell)


# -------------------------------------------------------------- similarity

BLOCK = "block long, n int, ids binary, mat binary, asked binary, centroid binary, radius double"


def unit_blocks(factors: DataFrame, block_rows: int, n_items: int) -> DataFrame:
    """(block, ids, mat, asked, centroid, radius): unit vectors around pivots;
    ``asked`` has a byte for each, of the input's column if there is one."""
    k = max(1, min(MAX_PIVOTS, -(-n_items // block_rows)))
    chosen = factors.orderBy(F.xxhash64("id"), "id").limit(k).collect()
    if not chosen:
        return factors.sparkSession.createDataFrame([], BLOCK)
    pivots = np.array([r.v for r in chosen])
    pivots /= np.linalg.norm(pivots, axis=1, keepdims=True)

    def near(batches):
        for pdf in batches:
            if len(pdf):
                unit = np.stack(pdf["v"].to_numpy())
                unit = unit / np.linalg.norm(unit, axis=1, keepdims=True)
                cos = unit @ pivots.T
                at = cos.argmax(axis=1)
                yield pd.DataFrame({"id": pdf["id"], "unit": list(unit), "asked": pdf["asked"], "pivot": at.astype(np.int32), "far": 1 - cos[np.arange(len(at)), at]})

    def cut(batches):
        name = _named()
        for i, pdf in enumerate(_pieces(batches, "pivot", block_rows)):
            mat = np.stack(pdf["unit"].to_numpy())
            mean = mat.mean(axis=0)
            size = np.linalg.norm(mean)
            centroid = mean / size if size > 1e-12 else mat[0]
            radius = float(np.arccos(np.clip(mat @ centroid, -1, 1)).max())
            yield pd.DataFrame([{"block": name + i, "n": len(mat), "ids": pdf["id"].to_numpy(np.int64).tobytes(), "mat": mat.tobytes(),
                                 "asked": pdf["asked"].to_numpy(bool).tobytes(), "centroid": centroid.tobytes(), "radius": radius}])

    factors = factors if "asked" in factors.columns else factors.withColumn("asked", F.lit(True))
    placed = factors.mapInPandas(near, "id int, unit array<double>, asked boolean, pivot int, far double")
    placed = placed.repartitionByRange("pivot", "far", "id").sortWithinPartitions("pivot", "far", "id")
    return _stored(placed.mapInPandas(cut, BLOCK), "unit-blocks")


def _near(centroids_a, radii_a, centroids_b, radii_b, threshold: float):
    """Which blocks may hold a pair of cosine above the threshold."""
    apart = np.arccos(np.clip(centroids_a @ centroids_b.T, -1, 1))
    return apart <= radii_a[:, None] + radii_b[None, :] + float(np.arccos(np.clip(threshold, -1, 1))) + SLACK


def _in_pairs(blocks: DataFrame, columns: list[str], order: str) -> DataFrame:
    """A cell for every two groups of the blocks, and for each with itself."""
    groups = _groups(blocks)
    mine = blocks.select("block", *columns, _group(groups).alias("g"))
    cell = lambda low, high: (F.col(high) * (F.col(high) + 1) / 2 + F.col(low)).cast("int").alias("cell")
    held = mine.withColumn("o", F.explode(F.sequence("g", F.lit(groups - 1)))).select("block", *columns, cell("g", "o"), (F.col("g") == F.col("o")).alias("same"))
    met = mine.withColumn("o", F.explode(F.sequence(F.lit(0), "g"))).select("block", *columns, cell("o", "g"), (F.col("g") == F.col("o")).alias("same"))
    return _dealt(held, met, groups * (groups + 1) // 2, order)


def near_pairs(blocks: DataFrame, threshold: float) -> DataFrame:
    """(bi, bj), bi <= bj, of the blocks that may hold a pair of cosine above
    the threshold; no vector is read."""
    def run(batches):
        for held, met in _by_cell(batches):
            names, centroids, radii = _rims(held)
            for r in met:
                name, centroid, radius = _rims([r])
                mine = names[_near(centroids, radii, centroid, radius, threshold)[:, 0] & ((names <= name) | (not r.same))]
                yield pd.DataFrame({"bi": np.minimum(mine, name), "bj": np.maximum(mine, name)})

    return _in_pairs(blocks, ["centroid", "radius"], "block").mapInPandas(run, "bi long, bj long")


def _rims(rows):
    return (np.array([r.block for r in rows], np.int64), np.stack([np.frombuffer(r.centroid, np.float64) for r in rows]),
            np.array([r.radius for r in rows]))


def similar_pairs(factors: DataFrame, threshold: float, block_rows: int, n_items: int) -> DataFrame:
    """(mid, sim_mid, sim), both ways, of all pairs above the threshold."""
    blocks = unit_blocks(factors, block_rows, n_items)

    def vectors(r):
        ids = np.frombuffer(r.ids, np.int64)
        return ids, np.frombuffer(r.mat, np.float64).reshape(len(ids), -1)

    def run(batches):
        for held, met in _by_cell(batches):
            names, centroids, radii = _rims(held)
            kept = [vectors(r) for r in held]
            out, rows = [], 0
            for r in met:
                name, centroid, radius = _rims([r])
                ib, b = vectors(r)
                for i in np.flatnonzero(_near(centroids, radii, centroid, radius, threshold)[:, 0] & ((names <= name) | (not r.same))):
                    ia, a = kept[i]
                    cos = a @ b.T
                    keep = cos > threshold
                    one = names[i] == name[0]
                    if one:
                        np.fill_diagonal(keep, False)
                    x, y = np.nonzero(keep)
                    value = cos[x, y]
                    out.append((ia[x], ib[y], value))
                    if not one:
                        out.append((ib[y], ia[x], value))
                    rows += len(x) * (2 - one)
                    if rows >= ROWS_OUT:
                        yield _pairs(out)
                        out, rows = [], 0
            if rows:
                yield _pairs(out)

    return _in_pairs(blocks, ["ids", "mat", "centroid", "radius"], "block").mapInPandas(run, "mid int, sim_mid int, sim double")


def _asked(factors: DataFrame, of: DataFrame | None) -> DataFrame:
    """``factors`` with ``asked``: whether the id is among those of ``of``
    (one column; default: all are)."""
    if of is None:
        return factors.withColumn("asked", F.lit(True))
    wanted = of.select(F.col(of.columns[0]).cast("int").alias("id"), F.lit(True).alias("asked")).filter("id is not null").distinct()
    return factors.join(wanted, "id", "left").withColumn("asked", F.coalesce("asked", F.lit(False)))


def _of_rows(blocks: DataFrame, groups: int, others: int, columns: list[str]) -> DataFrame:
    """Cells of ``groups`` groups of asked rows, dealt by id, and ``others``
    groups of blocks.  The held rows keep their block's centroid and radius."""
    def split(batches):
        for pdf in batches:
            for r in pdf.itertuples():
                ids, wanted = np.frombuffer(r.ids, np.int64), np.frombuffer(r.asked, bool)
                mat = np.frombuffer(r.mat, np.float64).reshape(len(ids), -1)
                g = _spread(ids) % groups
                out = []
                for one in np.unique(g[wanted]).tolist():
                    at = np.flatnonzero(wanted & (g == one))
                    out.append({"block": r.block, "g": one, "at": at.tobytes(), "ids": ids[at].tobytes(), "mat": mat[at].tobytes(),
                                "centroid": r.centroid, "radius": r.radius})
                if out:
                    yield pd.DataFrame(out)

    other = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("o")
    held = blocks.mapInPandas(split, "block long, g int, at binary, ids binary, mat binary, centroid binary, radius double")
    held = held.select("*", other(others)).withColumn("cell", F.col("g") * others + F.col("o")).drop("g", "o")
    met = blocks.select("block", *columns, _group(others).alias("g"), other(groups)).withColumn("cell", F.col("o") * others + F.col("g")).drop("g", "o")
    return _dealt(held, met, groups * others, "block")


def _spread(ids: np.ndarray) -> np.ndarray:
    return (ids.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)


def _met_rows(held, met, threshold: float):
    """(first of a run of held rows, row, met block, column, cosine) of the
    pairs above the threshold; a row does not meet itself."""
    names, centroids, radii = _rims(held)
    sizes = np.array([len(r.at) // 8 for r in held])
    mat = np.concatenate([np.frombuffer(r.mat, np.float64) for r in held]).reshape(int(sizes.sum()), -1)
    at, name = np.concatenate([np.frombuffer(r.at, np.int64) for r in held]), np.repeat(names, sizes)
    for r in met:
        own, centroid, radius = _rims([r])
        near = np.repeat(_near(centroids, radii, centroid, radius, threshold)[:, 0], sizes)
        right = np.frombuffer(r.mat, np.float64).reshape(-1, mat.shape[1]).T
        for begin in range(0, len(mat), AT_ONCE):
            rows = begin + np.flatnonzero(near[begin:begin + AT_ONCE])
            if not len(rows):
                continue
            cos = (mat[begin:begin + AT_ONCE] if len(rows) == AT_ONCE else mat[rows]) @ right
            keep = cos > threshold
            same = np.flatnonzero(name[rows] == own[0])
            keep[same, at[rows[same]]] = False
            x, y = np.nonzero(keep)
            if len(x):
                yield begin, rows[x], r, y, cos[x, y]


def pairs_of(factors: DataFrame, of: DataFrame, threshold: float, block_rows: int, n_items: int) -> DataFrame:
    """(mid, sim_mid, sim), both ways, of the pairs above the threshold in
    which a movie of ``of`` is."""
    factors = _asked(factors, of)
    blocks = unit_blocks(factors, block_rows, n_items)
    size = blocks.agg(F.sum(F.length("mat")).alias("bytes"), F.sum("n").alias("n")).first()
    asked = factors.filter("asked").count()
    cells, share = _cells(blocks), asked / max(1, size.n or 0)
    groups = max(1, round(math.sqrt(cells * share)), math.ceil((size.bytes or 0) * share / HELD_BYTES))

    def run(batches):
        for held, met in _by_cell(batches):
            ids = np.concatenate([np.frombuffer(r.ids, np.int64) for r in held])
            out, rows = [], 0
            for _, row, r, col, value in _met_rows(held, met, threshold):
                other = np.frombuffer(r.ids, np.int64)[col]
                out.append((ids[row], other, value))
                back = ~np.frombuffer(r.asked, bool)[col]       # others are held somewhere
                out.append((other[back], ids[row[back]], value[back]))
                rows += len(row) + int(back.sum())
                if rows >= ROWS_OUT:
                    yield _pairs(out)
                    out, rows = [], 0
            if rows:
                yield _pairs(out)

    return _of_rows(blocks, groups, max(1, -(-cells // groups)), ["ids", "mat", "asked", "centroid", "radius"]) \
        .mapInPandas(run, "mid int, sim_mid int, sim double")


def whole_lists(factors: DataFrame, of: DataFrame | None, threshold: float, block_rows: int, n_items: int) -> DataFrame:
    """(mid, recs): every movie's pairs above the threshold, best first
    (scores equal to 9 decimals are ties, to smaller ids), of the movies in
    ``of``.  A task has all rows of an id and meets all blocks."""
    factors = _asked(factors, of)
    blocks = unit_blocks(factors, block_rows, n_items)
    asked = factors.filter("asked").count()
    some = factors.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()
    pairs = 0.0
    if len(some) > 1:
        unit = np.array([r.v for r in some])
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        pairs = (np.count_nonzero(unit @ unit.T > threshold) - len(some)) / (len(some) * (len(some) - 1)) * asked * n_items
    groups = max(1, min(_cells(blocks), -(-asked // TASK_ROWS)), math.ceil(12 * pairs / LIST_BYTES))

    def run(batches):
        import pyarrow as pa
        for held, met in _by_cell(b.to_pandas() for b in batches):
            ids = np.concatenate([np.frombuffer(r.ids, np.int64) for r in held])
            found: dict = {}
            # a movie with several rows has one list
            names, list_of = np.unique(ids, return_inverse=True)
            for _, row, r, col, value in _met_rows(held, met, threshold):
                mine = list_of[row]
                for part in np.unique(mine // AT_ONCE).tolist():
                    here = mine // AT_ONCE == part
                    found.setdefault(part, []).append((mine[here].astype(np.int32), np.frombuffer(r.ids, np.int64)[col[here]].astype(np.int32), value[here]))
            for part in sorted(found):
                mine, other, value = (np.concatenate(c) for c in zip(*found.pop(part)))
                order = np.lexsort((other, -np.round(value, 9), mine))
                mine, other, value = mine[order], other[order], value[order]
                begin = np.flatnonzero(np.append(True, mine[1:] != mine[:-1]))
                stop = np.append(begin[1:], len(mine))
                for a, b in _runs(stop - begin):
                    rows = slice(begin[a], stop[b - 1])
                    recs = pa.StructArray.from_arrays([pa.array(other[rows]), pa.array(value[rows])], names=["mid", "score"])
                    ends = pa.array(np.append(begin[a:b], stop[b - 1]).astype(np.int64) - begin[a], pa.int32())
                    yield pa.RecordBatch.from_arrays([pa.array(names[mine[begin[a:b]]].astype(np.int32)), pa.ListArray.from_arrays(ends, recs)], names=["mid", "recs"])

    return _of_rows(blocks, groups, 1, ["ids", "mat", "centroid", "radius"]).mapInArrow(run, f"mid int, recs {RECS.simpleString()}")


def _runs(sizes: np.ndarray):
    """Runs a..b of lists that have at most ``ROWS_OUT`` entries, or of one."""
    a, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > a and total + n > ROWS_OUT:
            yield a, i
            a, total = i, 0
        total += n
    if len(sizes):
        yield a, len(sizes)


def _pairs(parts) -> pd.DataFrame:
    mid, sim_mid, sim = (np.concatenate(c) for c in zip(*parts))
    return pd.DataFrame({"mid": mid.astype(np.int32), "sim_mid": sim_mid.astype(np.int32), "sim": sim})


# ------------------------------------------------------------------- top-k

PACK = "block long, n int, ids binary, mat binary, least double, most double, along binary"


def _packed(rows: DataFrame, by: str, block_rows: int, name: str) -> DataFrame:
    """Rows (id, v, <by>) in blocks along ``by``, with its range."""
    def cut(batches):
        first = _named()
        for i, pdf in enumerate(_pieces(batches, None, block_rows)):
            yield pd.DataFrame([{"block": first + i, "n": len(pdf), "ids": pdf["id"].to_numpy(np.int64).tobytes(), "mat": np.stack(pdf["v"].to_numpy()).tobytes(),
                                 "least": float(pdf[by].min()), "most": float(pdf[by].max()), "along": pdf[by].to_numpy(np.float64).tobytes()}])

    rows = rows.select("id", "v", by)
    return _stored(rows.repartitionByRange(by, "id").sortWithinPartitions(by, "id").mapInPandas(cut, PACK), name)


def _norm():
    return F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))


def _best(at, mid, score, k: int):
    """The k best rows of each ``at``, ties to smaller ids, and each k-th score."""
    order = np.lexsort((mid, -score, at))
    at, mid, score = at[order], mid[order], score[order]
    begin = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else np.zeros(0, np.int64)
    place = np.arange(len(at)) - np.repeat(begin, np.diff(np.append(begin, len(at))))
    last = place == k - 1
    return (at[place < k], mid[place < k], score[place < k]), at[last], score[last]


def _reaching(near: np.ndarray, mine: np.ndarray, need: np.ndarray, right: np.ndarray, most: float, k: int):
    """(row, column) pairs of the rows ``mine`` that hold all whose product
    may be among the row's k best: those that come to ``need``, a product
    with the row's unit vector.  Tiles of rounded unit vectors (``near``) and
    of vectors over their largest norm are looked at first, and ``slack``
    covers all their rounding, so only pairs close to what is needed are left
    to be multiplied in full.  ``need`` rises to what k columns of a tile
    are sure to reach."""
    slack = (right.shape[1] + 8) * 2.0**-23
    small = (right / most).astype(np.float32)
    rows, cols, pairs = [], [], 0
    for begin in range(0, len(mine), TILE):
        part = mine[begin:begin + TILE]
        left = near[part]
        for at in range(0, len(small), TILE):
            score = left @ small[at:at + TILE].T
            keep = score >= (need[part] / most - slack)[:, None]
            count = np.count_nonzero(keep)
            if count > 4 * k * len(part) and score.shape[1] > k:
                kth = np.partition(score, -k, axis=1)[:, -k].astype(np.float64)
                need[part] = np.maximum(need[part], (kth - slack) * most)
                keep = score >= (need[part] / most - slack)[:, None]
                count = np.count_nonzero(keep)
            if count:
                row, col = np.divmod(np.flatnonzero(keep), score.shape[1])
                rows.append(part[row])
                cols.append(at + col)
                pairs += count
            if pairs >= 8 * AT_ONCE:
                yield np.concatenate(rows), np.concatenate(cols)
                rows, cols, pairs = [], [], 0
    if pairs:
        yield np.concatenate(rows), np.concatenate(cols)


def _all(mine: np.ndarray, columns: int):
    """Every pair of the rows ``mine`` and the columns, in parts."""
    at_once = max(1, 8 * AT_ONCE // columns)
    for begin in range(0, len(mine), at_once):
        part = mine[begin:begin + at_once]
        yield np.repeat(part, columns), np.tile(np.arange(columns), len(part))


def _products(users: DataFrame, items: DataFrame, k: int, positive_only: bool) -> DataFrame:
    """(uid, mid, score): of every cell, each user's k best items among those
    whose norm reaches what the user needs (``along`` of the user blocks)."""
    b = _groups(items)
    a = _groups(users, b)
    other = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("o")
    held = users.select("ids", "mat", "along", _group(a).alias("g"), other(b)).select("ids", "mat", "along", (F.col("g") * b + F.col("o")).alias("cell"))
    met = items.select("ids", "mat", "most", _group(b).alias("g"), other(a)) \
        .select("ids", "mat", "most", (-F.col("most")).alias("at"), (F.col("o") * b + F.col("g")).alias("cell"))

    def run(batches):
        for held, met in _by_cell(batches):
            ids = np.concatenate([np.frombuffer(r.ids, np.int64) for r in held])
            need = np.concatenate([np.frombuffer(r.along, np.float64) for r in held])
            mat = np.concatenate([np.frombuffer(r.mat, np.float64) for r in held]).reshape(len(ids), -1)
            held.clear()
            norm = np.linalg.norm(mat, axis=1)
            near = (mat / norm[:, None]).astype(np.float32)
            plain = bool(np.all((norm > 1e-100) & (norm < 1e100)))
            found, new, fresh = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)), [], 0
            for r in met:
                mine = np.flatnonzero(r.most > need * (1 - SLACK) - 1e-12)
                mid = np.frombuffer(r.ids, np.int64)
                right = np.frombuffer(r.mat, np.float64).reshape(len(mid), -1)
                for row, col in _reaching(near, mine, need, right, r.most, k) if plain and 1e-100 < r.most < 1e100 else _all(mine, len(mid)):
                    score = np.einsum("ij,ij->i", mat[row], right[col])
                    if positive_only:
                        row, col, score = (x[score > 0] for x in (row, col, score))
                    if len(row):
                        new.append((row, mid[col], score))
                        fresh += len(row)
                if fresh > max(ROWS_OUT, len(found[0])):
                    found, at, kth = _best(*(np.concatenate(c) for c in zip(found, *new)), k)
                    need[at] = np.maximum(need[at], kth / norm[at])
                    new, fresh = [], 0
            (at, mid, score), _, _ = _best(*(np.concatenate(c) for c in zip(found, *new)), k)
            for begin in range(0, len(at), ROWS_OUT):
                part = slice(begin, begin + ROWS_OUT)
                yield pd.DataFrame({"uid": ids[at[part]].astype(np.int32), "mid": mid[part].astype(np.int32), "score": score[part]})

    return _dealt(held, met, a * b, "at").mapInPandas(run, "uid int, mid int, score double")


def _meet(users: DataFrame, items: DataFrame, norms: list[tuple[int, float]], reach: bool) -> DataFrame:
    """User blocks with the item blocks that may matter to them: of
    ``norms`` (block, largest norm; by falling norm) a leading part."""
    names, most = np.array([n for n, _ in norms], np.int64), np.array([m for _, m in norms])

    def run(batches):
        for pdf in batches:
            for r in pdf.itertuples():
                few = int(np.searchsorted(-most, -(r.least * (1 - SLACK) - 1e-12), "left")) if reach else len(names)
                for at in range(0, few, 10_000):
                    part = names[at:min(at + 10_000, few)]
                    yield pd.DataFrame({"u": np.full(len(part), r.block), "i": part})

    near = users.select("block", "least").mapInPandas(run, "u long, i long")
    left = users.select(F.col("block").alias("u"), F.col("ids").alias("u_ids"), F.col("mat").alias("u_mat"))
    right = items.select(F.col("block").alias("i"), "ids", "mat")
    met = near.join(left, "u").join(right, "i")
    return met.repartition(4 * users.sparkSession.sparkContext.defaultParallelism, "u", "i")


def top_products(users: DataFrame, items: DataFrame, k: int, positive_only: bool = True, block_rows: int = 4096) -> DataFrame:
    """(uid, rank, mid, score): each user's k best items by inner product;
    ``users`` and ``items`` as ``usable`` gives them."""
    spark = users.sparkSession
    users, items = _stored(users.withColumn("norm", _norm()), "factor-users"), _stored(items.withColumn("norm", _norm()), "factor-items")
    blocks = _packed(items.withColumn("less", -F.col("norm")), "less", block_rows, "factor-blocks")
    blocks = blocks.select("block", "n", "ids", "mat", (-F.col("most")).alias("least"), (-F.col("least")).alias("most"))
    first = blocks.orderBy(F.desc("most"), "block").select("block").first()
    if first is None:
        return spark.createDataFrame([], "uid int, rank int, mid int, score double")
    floor = F.lit(0.0) if positive_only else F.lit(float("-inf"))
    groups = _packed(users.withColumn("least", floor), "least", block_rows, "factor-groups")
    begin = _stored(_products(groups, blocks.filter(F.col("block") == first.block), k, positive_only), "factor-first")
    kth = begin.groupBy(F.col("uid").alias("id")).agg(F.count("*").alias("found"), F.min("score").alias("kth")).filter(F.col("found") >= k)
    need = users.join(kth.select("id", "kth"), "id", "left").withColumn("need", F.coalesce("kth", floor) / F.col("norm"))
    groups = _packed(need, "need", block_rows, "factor-groups")
    found = begin.unionByName(_products(groups, blocks.filter(F.col("block") != first.block), k, positive_only))
    w = Window.partitionBy("uid").orderBy(F.col("score").desc(), F.col("mid").asc())
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("uid", F.col("rank").cast("int").alias("rank"), "mid", "score")
