"""Hybrid blend and cold-start fallback."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.columns import pref_key
from marquee.operators.search import rank_key
from marquee.session import written

# The weights of the three sources in the hybrid blend.
SIMILAR_WEIGHT = 0.3
CONTENT_WEIGHT = 0.3
STREAM_WEIGHT = 0.4


def _cap(long: DataFrame, key: str, n: int) -> DataFrame:
    """The best n rows of each key of a long (key, mid, score) table."""
    w = Window.partitionBy(key).orderBy(rank_key("score").desc(), F.col("mid").asc())
    return long.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n).drop("_r")


def hybrid(similar: DataFrame, content: DataFrame, stream: DataFrame,
           requests: DataFrame, n: int = 10, dedupe: bool = False) -> DataFrame:
    """Per request (uid, anchor_mid) blend the anchor's similar movies
    (x0.3), its content neighbours (x0.3) and the user's streaming recs
    (x0.4); each source is capped at n first, then the union is ranked ->
    (uid, rank, mid, score).  ``similar`` and ``content`` are long tables
    (anchor, mid, score); ``stream`` is (uid, mid, score).  Duplicates are
    kept (R9) unless ``dedupe=True`` sums them."""
    req = requests.select("uid", "anchor_mid")
    s = _cap(similar, "anchor", n).select(F.col("anchor").alias("anchor_mid"), "mid",
                                          (F.col("score") * SIMILAR_WEIGHT).alias("score"))
    c = _cap(content, "anchor", n).select(F.col("anchor").alias("anchor_mid"), "mid",
                                          (F.col("score") * CONTENT_WEIGHT).alias("score"))
    t = _cap(stream, "uid", n).select("uid", "mid", (F.col("score") * STREAM_WEIGHT).alias("score"))
    parts = (req.join(s, "anchor_mid").select("uid", "mid", "score")
             .unionByName(req.join(c, "anchor_mid").select("uid", "mid", "score"))
             .unionByName(req.join(t, "uid").select("uid", "mid", "score")))
    if dedupe:
        parts = parts.groupBy("uid", "mid").agg(F.sum("score").alias("score"))
    w = Window.partitionBy("uid").orderBy(rank_key("score").desc(), F.col("mid").asc())
    return (parts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
            .select("uid", F.col("rank").cast("int").alias("rank"), "mid", "score"))


def choose_genre(uid: str, prefs: str, seed: int | None = 42) -> F.Column:
    """The fallback genre of a user: a hash of (uid, seed) picks one of the
    preference genres (``seed=None``: ``uid mod size``); text before the
    first space is the genre key (P11)."""
    size = F.size(F.col(prefs))
    idx = F.pmod(F.col(uid), size) if seed is None else F.pmod(F.xxhash64(F.col(uid), F.lit(seed)), size)
    return pref_key(F.element_at(F.col(prefs), (idx + 1).cast("int")))


def with_fallback(recs: DataFrame, users: DataFrame, top_genres: DataFrame,
                  n: int = 10, seed: int | None = 42) -> DataFrame:
    """Users without recs get the top list of one preference genre ->
    (uid, rank, mid, score, source).  ``top_genres`` is the long form
    (genre, rank, mid, avg).  Users with no preferences get nothing.  The
    recs are read twice and so written down once."""
    recs = written(recs.select("uid", "rank", "mid", "score"), "recs")
    have = recs.select("uid").distinct()
    cold = (users.join(have, "uid", "left_anti").filter(F.size("prefGenres") > 0)
            .select("uid", choose_genre("uid", "prefGenres", seed).alias("genre")))
    fb = (cold.join(top_genres.filter(F.col("rank") <= n), "genre")
          .select("uid", "rank", "mid", F.col("avg").alias("score"), F.lit("genre").alias("source")))
    return recs.select("uid", "rank", "mid", "score", F.lit("recs").alias("source")).unionByName(fb)
