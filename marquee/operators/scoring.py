"""Event scoring: from one rating event to a fresh suggestion list
(W2, W3, J5, J6, J10, A8, P5, T4, T5 in batch form).

For a rating event e = (uid, mid) at order (ts, event_id):

* recent(e)  -- the user's newest ``n_recent`` ratings up to and including e
  (the queue is pushed before the event is scored);
* cands(e)   -- the ``n_cand`` movies most similar to e.mid (similarity desc,
  id asc) that the user has not rated up to e (J6 + W3);
* score(e,c) -- mean of sim(c, r) * score(r) over recent ratings r with
  sim(c, r) > threshold, plus log2(#such r with score > 3) minus
  log2(#others); a missing side adds 0 (R1, R2).  Candidates with no such
  r get no score.

The plan is joins and aggregates only.  Every per-event list is bounded by a
parameter (recent <= n_recent, candidates <= n_cand), so the per-event join
is at most n_recent x n_cand rows.  The similarity table is joined, not
collected: Spark/AQE broadcasts it only when its measured size is small.
The same function runs on a static table and inside ``foreachBatch``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.columns import sort_recs
from marquee.schemas import RECS
from marquee.session import scratch_path, written


def user_sequence(events: DataFrame, partitions: int | None = None, rows_per_bucket: int = 100_000) -> DataFrame:
    """Number each user's events 0, 1, 2 ... in (ts, event_id) order
    without sorting any user's events in a single task; a null time is the
    earliest.

    Rows are cut at order statistics of (uid, ts, event_id) into pieces of
    about ``rows_per_bucket`` rows, so neither a user with a third of all
    events nor a stray time makes a piece larger than another.  Pieces are
    written down once, as every branch of a plan must see the same cuts.
    Rows are numbered within (user, piece) and shifted by the user's row
    count in earlier pieces (a prefix sum over one row per user and piece).
    """
    pieces = partitions or max(1, -(-events.count() // rows_per_bucket))
    path = scratch_path(events.sparkSession, "user-sequence")
    dealt = events.repartitionByRange(pieces, "uid", "ts", "event_id", *[c for c in events.columns if c not in ("uid", "ts", "event_id")])
    dealt.withColumn("_b", F.spark_partition_id()).write.parquet(path)
    cut = events.sparkSession.read.schema(dealt.withColumn("_b", F.spark_partition_id()).schema).parquet(path)
    rest = [c for c in events.columns if c not in ("uid", "ts", "event_id")]
    local = F.row_number().over(Window.partitionBy("uid", "_b").orderBy("ts", "event_id", *rest)) - 1
    numbered = cut.withColumn("_local", local)
    counts = cut.groupBy(F.col("uid").alias("_u"), F.col("_b").alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("_u").orderBy("_p")
                              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("_u", "_p", F.coalesce(before, F.lit(0)).alias("_off"))
    return (numbered.join(offsets, F.col("uid").eqNullSafe(F.col("_u")) & (F.col("_b") == F.col("_p")))
            .withColumn("seq", (F.col("_local") + F.col("_off")).cast("long"))
            .select(*events.columns, "seq"))


def recent_per_event(events: DataFrame, n_recent: int = 20) -> DataFrame:
    """W2 (per event): rows (event_id, pos, r_mid, r_score); pos 0 is the
    event itself, higher positions are older ratings of the same user.

    With each user's events numbered by ``user_sequence``, the ratings of
    event e are the events h with seq(e) - n < seq(h) <= seq(e).  Events are
    bucketed by floor(seq / n); e joins h on (uid, bucket) for its own and
    the previous bucket, so every join group holds at most 2n rows however
    active the user is.
    """
    seq = user_sequence(events.select("event_id", "uid", "mid", "score", "ts"))
    e = seq.select("event_id", "uid", F.col("seq").alias("e_seq"),
                   F.explode(F.array(F.floor(F.col("seq") / n_recent),
                                     F.floor(F.col("seq") / n_recent) - 1)).alias("b"))
    h = seq.select("uid", F.col("seq").alias("h_seq"), F.col("mid").alias("r_mid"),
                   F.col("score").alias("r_score"), F.floor(F.col("seq") / n_recent).alias("b"))
    j = (e.join(h, ["uid", "b"])
         .filter((F.col("h_seq") <= F.col("e_seq")) & (F.col("h_seq") > F.col("e_seq") - n_recent)))
    return j.select("event_id", (F.col("e_seq") - F.col("h_seq")).cast("int").alias("pos"),
                    "r_mid", "r_score")


def recent_queue(events: DataFrame, n: int = 20) -> DataFrame:
    """W2 (table): each user's newest ``n`` ratings -> (uid, pos, mid, score),
    pos 0 newest.  ``row_number() <= n`` is planned with a partial group
    limit before the shuffle, so a very active user ships n rows per task."""
    w = Window.partitionBy("uid").orderBy(F.col("ts").desc(), F.col("event_id").desc())
    return (events.withColumn("pos", F.row_number().over(w) - 1).filter(F.col("pos") < n)
            .select("uid", F.col("pos").cast("int").alias("pos"), "mid", "score"))


def first_rated(ratings: DataFrame, events: DataFrame) -> DataFrame:
    """Seen set: (uid, mid, f_ts, f_id) -- when the user first rated mid,
    over historic ratings (f_id = -1) and rating events.  One row per pair,
    partially aggregated before the shuffle."""
    hist = ratings.select("uid", "mid", "ts", F.lit(-1).cast("bigint").alias("event_id"))
    ev = events.select("uid", "mid", "ts", "event_id")
    first = F.min(F.struct("ts", "event_id"))
    return (hist.unionByName(ev).groupBy("uid", "mid").agg(first.alias("f"))
            .select("uid", "mid", F.col("f.ts").alias("f_ts"), F.col("f.event_id").alias("f_id")))


def ranked_sims(sims: DataFrame, per_bucket: int = 20) -> DataFrame:
    """The similarity table by rank: (mid, cand, csim, bucket), where
    bucket 0 holds a movie's ``per_bucket`` most similar movies, and so on."""
    w = Window.partitionBy("mid").orderBy(F.col("sim").desc(), F.col("sim_mid").asc())
    return sims.select("mid", F.col("sim_mid").alias("cand"), F.col("sim").alias("csim"),
                       F.floor((F.row_number().over(w) - 1) / per_bucket).cast("int").alias("bucket"))


def candidates(events: DataFrame, sims: DataFrame, seen: DataFrame, n_cand: int = 20) -> DataFrame:
    """J5 + J6 + W3: (event_id, uid, cand, csim, cand_rank).

    A user who has rated s movies finds ``n_cand`` unseen ones among the
    first n_cand + s ranks, so an event reads only the rank buckets up to
    there, however long the movie's list is.  The seen set is read twice and
    so written down once.
    """
    seen = written(seen, "seen")
    s = ranked_sims(sims, n_cand)
    buckets = sims.groupBy("mid").agg(F.floor((F.count(F.lit(1)) - 1) / n_cand).cast("int").alias("_last"))
    known = seen.groupBy("uid").agg(F.count(F.lit(1)).alias("_seen"))
    e = events.select("event_id", "uid", "mid", "ts").join(buckets, "mid").join(known, "uid", "left")
    need = F.floor((F.lit(n_cand - 1) + F.coalesce("_seen", F.lit(0))) / n_cand).cast("int")
    e = e.select("event_id", "uid", "mid", "ts", F.explode(F.sequence(F.lit(0), F.least("_last", need))).alias("bucket"))
    c = e.join(s, ["mid", "bucket"]).drop("bucket")
    seen_ = seen.select(F.col("uid").alias("s_uid"), F.col("mid").alias("s_mid"), "f_ts", "f_id")
    rated_before = ((c.uid == seen_.s_uid) & (c.cand == seen_.s_mid)
                    & ((seen_.f_ts < c.ts) | ((seen_.f_ts == c.ts) & (seen_.f_id <= c.event_id))))
    c = c.join(seen_, rated_before, "left_anti")
    w = Window.partitionBy("event_id").orderBy(F.col("csim").desc(), F.col("cand").asc())
    return (c.withColumn("cand_rank", F.row_number().over(w)).filter(F.col("cand_rank") <= n_cand)
            .select("event_id", "uid", "cand", "csim", F.col("cand_rank").cast("int").alias("cand_rank")))


def score_candidates(cands: DataFrame, recent: DataFrame, sims: DataFrame,
                     threshold: float = 0.6) -> DataFrame:
    """J10 + A8 + P5: (event_id, uid, mid, score)."""
    # The small per-event side takes the similarity table's key names, so a
    # similarity table already partitioned on (mid, sim_mid) is not shuffled.
    pairs = (cands.select("event_id", "uid", F.col("cand").alias("mid")).join(recent, "event_id")
             .withColumnRenamed("r_mid", "sim_mid"))
    contrib = (pairs.join(sims.select("mid", "sim_mid", "sim"), ["mid", "sim_mid"])
               .filter(F.col("sim") > F.lit(float(threshold))))
    agg = contrib.groupBy("event_id", "uid", F.col("mid").alias("cand")).agg(
        F.avg(F.col("sim") * F.col("r_score")).alias("base"),
        F.count_if(F.col("r_score") > 3).alias("hi"),
        F.count_if(F.col("r_score") <= 3).alias("lo"))
    score = (F.col("base") + F.log2(F.greatest(F.col("hi"), F.lit(1)))
             - F.log2(F.greatest(F.col("lo"), F.lit(1))))
    return agg.select("event_id", "uid", F.col("cand").alias("mid"), score.alias("score"))


def score_events(events: DataFrame, ratings: DataFrame, sims: DataFrame,
                 n_recent: int = 20, n_cand: int = 20, threshold: float = 0.6,
                 history: DataFrame | None = None) -> DataFrame:
    """T4: score every rating event -> (event_id, uid, mid, score).

    ``history`` (default: ``events``) holds the earlier rating events used
    for the recent lists and the seen set; in a micro-batch it is the
    stored events plus the batch.
    """
    hist = events if history is None else history
    recent = recent_per_event(hist, n_recent).join(events.select("event_id"), "event_id", "left_semi")
    seen = first_rated(ratings.join(hist.select("uid").distinct(), "uid", "left_semi"), hist)
    cands = candidates(events, sims, seen, n_cand)
    return score_candidates(cands, recent, sims, threshold)


def latest_recs(events: DataFrame, scores: DataFrame) -> DataFrame:
    """T5 (batch form, R12): per user, the recs of the last event by
    (ts, event_id) -> (uid, event_id, recs); an event without scores gives
    an empty list, which still replaces the old one."""
    w = Window.partitionBy("uid").orderBy(F.col("ts").desc(), F.col("event_id").desc())
    last = (events.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1")
            .select("uid", "event_id"))
    lists = scores.groupBy("event_id").agg(
        sort_recs(F.collect_list(F.struct(F.col("mid").cast("int").alias("mid"),
                                          F.col("score").cast("double").alias("score")))).cast(RECS).alias("recs"))
    return (last.join(lists, "event_id", "left")
            .select("uid", "event_id", F.coalesce("recs", F.array().cast(RECS)).alias("recs")))
