"""Structured Streaming operators.

The online loop of the reference (log line -> filter -> parse -> recent
queue -> score -> replace the user's list) is one streaming query here:

    source -> T1 filter -> T2 parse -> T3 keyed state (uid)
           -> foreachBatch: T4 score (the batch plan of
              ``marquee.operators.scoring``) -> T5/S9 versioned upsert

The only shuffle inside the stream is the state operator's repartition by
``uid``; scoring inside ``foreachBatch`` is an ordinary batch job on the
micro-batch.  Result tables are change logs (``streaming.change_log``): a
retried batch replaces its own version, so a lost executor or a restarted
query never duplicates or loses rows.  Checkpoints go under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from marquee.functions.columns import extract_rating_log, parse_rating_message
from marquee.operators import scoring as sc
from marquee.operators import tag_text
from marquee.operators.maintenance import upsert_ratings
from marquee.schemas import RECS
from marquee.sources.log_source import FORMAT, read_log
from marquee.streaming.change_log import FAN, ChangeLog

# Fixed values of the reference loop.
QUEUE_CAP = 40          # recent ratings kept per user
RECENT_READ = 20        # recent ratings read per event (R3)
LEAD = 64               # similar movies that travel with an event
TRIGGER_INTERVAL = "2 seconds"

LOG_SCHEMA = T.StructType([
    T.StructField("offset", T.LongType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
])


@contextmanager
def state_partitions(spark: SparkSession, n: int | None = None):
    """Start streaming queries with ``n`` shuffle (and state-store)
    partitions: by default ``marquee.state.partitions`` or the cluster's
    cores.  A streaming query fixes this number when it first starts (it is
    kept in the checkpoint), so it is sized to the cluster, not to the
    batch-job setting; the session value is restored afterwards."""
    n = n or int(spark.conf.get("marquee.state.partitions", None)
                 or spark.sparkContext.defaultParallelism)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        yield n
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


# ------------------------------------------------------------ sources/sinks

def rating_stream(spark: SparkSession, opts: dict) -> DataFrame:
    """The message source -> (offset, key, value).

    ``opts['format'] == 'kafka'`` subscribes to ``opts['topic']`` from the
    latest offsets (the reference's setting) with the given bootstrap
    servers; the Kafka connector must be on the classpath.  ``'marquee_log'``
    reads a stored log by chunks (``chunksPerTrigger``), several tasks a
    batch (see ``sources.log_source``).  Any file format reads ``opts['path']`` (``maxFilesPerTrigger`` per batch).
    """
    fmt = opts.get("format", "parquet")
    if fmt == "kafka":
        r = (spark.readStream.format("kafka")
             .option("kafka.bootstrap.servers", opts["servers"])
             .option("subscribe", opts["topic"])
             .option("startingOffsets", opts.get("startingOffsets", "latest")))
        if "group" in opts:
            r = r.option("kafka.group.id", opts["group"])
        df = r.load()
        return df.select(F.col("offset").cast("bigint").alias("offset"),
                         F.col("key").cast("string").alias("key"),
                         F.col("value").cast("string").alias("value"))
    if fmt == FORMAT:
        return read_log(spark, opts["path"], opts.get("schema", LOG_SCHEMA), opts.get("checkpoint"), int(opts.get("chunksPerTrigger", 1)))
    return (spark.readStream.schema(opts.get("schema", LOG_SCHEMA)).format(fmt)
            .option("maxFilesPerTrigger", int(opts.get("maxFilesPerTrigger", 1)))
            .load(opts["path"]))


def write_stream(df: DataFrame, opts: dict, checkpoint: str, trigger: dict | None = None):
    """Write a stream to a topic (key kept) or to files, with a
    checkpoint so the sink is exactly-once across restarts."""
    with state_partitions(df.sparkSession):
        return _write_stream(df, opts, checkpoint, trigger)


def _write_stream(df: DataFrame, opts: dict, checkpoint: str, trigger: dict | None = None):
    fmt = opts.get("format", "parquet")
    w = df.writeStream.option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"processingTime": TRIGGER_INTERVAL}))
    if fmt == "kafka":
        return (df.select(F.col("key").cast("binary"), F.col("value").cast("binary")).writeStream
                .option("checkpointLocation", checkpoint)
                .trigger(**(trigger or {"processingTime": TRIGGER_INTERVAL}))
                .format("kafka").option("kafka.bootstrap.servers", opts["servers"])
                .option("topic", opts["topic"]).start())
    return w.format(fmt).outputMode("append").start(opts["path"])


# ------------------------------------------------------------- stateless

def log_filter_stream(df: DataFrame, marker: str) -> DataFrame:
    """Keep marked log lines, strip everything up to the marker."""
    return extract_rating_log(df, marker)


def rating_message_stream(df: DataFrame) -> DataFrame:
    """Parse messages -> (event_id, uid, mid, score, ts); the source
    offset is the event id, so (ts, event_id) orders events (R12)."""
    p = parse_rating_message(df.select("offset", "value"))
    return p.select(F.col("offset").alias("event_id"), "uid", "mid", "score", "ts")


# ----------------------------------------------------------------- state

RECENT_OUT = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("uid", T.IntegerType()),
    T.StructField("mid", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("ts", T.LongType()),
    T.StructField("pos", T.IntegerType()),
    T.StructField("r_mid", T.IntegerType()),
    T.StructField("r_score", T.DoubleType()),
])

# A user's queue and set of rated movies are one value each: one call reads
# or writes them, however many entries there are.
_QUEUE = np.dtype([("ts", "<i8"), ("event_id", "<i8"), ("mid", "<i4"), ("score", "<f8")])
_PACKED = "entries binary"


def _entries(state, kind) -> list:
    got = state.get()
    return np.frombuffer(bytes(got[0]), kind).tolist() if got is not None else []


def _keep(state, entries: list, kind) -> None:
    state.update((np.array(entries, kind).tobytes(),))


class RecentRatings(StatefulProcessor):
    """Per-user queue of the newest ``cap`` ratings (ValueState).

    Each input event is added to the queue in (ts, event_id) order, and one
    row per queue entry up to ``read`` is emitted for that event: pos 0 is
    the event itself, then older ratings.  The state of a user never holds
    more than ``cap`` entries, so a very active user costs bounded state.
    """

    def __init__(self, cap: int = QUEUE_CAP, read: int = RECENT_READ):
        self.cap = cap
        self.read = read

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.queue = handle.getValueState("queue", _PACKED)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        q = _entries(self.queue, _QUEUE) + [(int(r.ts), int(r.event_id), int(r.mid), float(r.score))
                                            for r in initialState.itertuples(index=False)]
        _keep(self.queue, sorted(q)[-self.cap:], _QUEUE)

    def handleInputRows(self, key, rows, timerValues):
        uid = int(key[0])
        q = _entries(self.queue, _QUEUE)
        batch = pd.concat(list(rows), ignore_index=True).sort_values(["ts", "event_id"])
        out = []
        for eid, mid, score, ts in zip(*(batch[c].tolist() for c in ("event_id", "mid", "score", "ts"))):
            q.append((ts, eid, mid, score))
            q.sort()
            older = [e for e in q if (e[0], e[1]) <= (ts, eid)][-self.read:]
            for pos, e in enumerate(reversed(older)):
                out.append((eid, uid, mid, score, ts, pos, e[2], e[3]))
            q = q[-self.cap:]
        _keep(self.queue, q, _QUEUE)
        if out:
            yield pd.DataFrame(out, columns=RECENT_OUT.fieldNames()).astype(
                {"uid": "int32", "mid": "int32", "pos": "int32", "r_mid": "int32"})

    def close(self) -> None:
        pass


def recent_ratings_stream(events: DataFrame, cap: int = QUEUE_CAP, read: int = RECENT_READ,
                          initial: DataFrame | None = None) -> DataFrame:
    """Keyed state by uid -> RECENT_OUT rows.  ``initial`` is an
    optional queue dump (uid, ts, event_id, mid, score), see P7."""
    init = initial.groupBy("uid") if initial is not None else None
    return events.groupBy("uid").transformWithStateInPandas(
        statefulProcessor=RecentRatings(cap, read), outputStructType=RECENT_OUT,
        outputMode="Append", timeMode="None", initialState=init)


# ---------------------------------------------- keyed state of the online loop

LOOP_OUT = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("uid", T.IntegerType()),
    T.StructField("mid", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("ts", T.LongType()),
    T.StructField("kind", T.StringType()),      # 'r' recent rating, 'c' candidate, 's' rated movie
    T.StructField("pos", T.IntegerType()),
    T.StructField("x_mid", T.IntegerType()),
    T.StructField("x_val", T.DoubleType()),
])


class OnlineState(StatefulProcessor):
    """T3 + J6 + W3 in the state store, keyed by uid.

    State per user: the recent queue (newest ``cap`` ratings) and the set of
    movies the user has rated (loaded once from the ratings table through
    ``initialState``, then extended by every event).  Input rows are events
    with the head of their movie's list of similar movies (``leading_sims``).
    For each event in (ts, event_id) order it emits the newest ``read``
    ratings (kind 'r') and the ``n_cand`` most similar movies not yet rated
    (kind 'c').  Where the head has too few of them and the list goes on, the
    movies rated so far are emitted instead (kind 's'), and ``score_batch``
    looks further.  No micro-batch scans the ratings table; a user's state is
    read only when the user has an event, and the seen set is bounded by the
    catalogue.
    """

    def __init__(self, cap: int = QUEUE_CAP, read: int = RECENT_READ, n_cand: int = 20):
        self.cap, self.read, self.n_cand = cap, read, n_cand

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.queue = handle.getValueState("queue", _PACKED)
        self.seen = handle.getValueState("seen", _PACKED)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        # called once per user, before any input of the first batch
        _keep(self.seen, sorted(set(initialState["mid"].astype(int).tolist())), "<i4")

    def handleInputRows(self, key, rows, timerValues):
        uid = int(key[0])
        pdf = pd.concat(list(rows), ignore_index=True)
        events = pdf.drop_duplicates("event_id").sort_values(["ts", "event_id"])
        q, seen = _entries(self.queue, _QUEUE), set(_entries(self.seen, "<i4"))
        known, out = len(seen), []
        for eid, mid, sc_, ts, cands, csims, more in zip(*(events[c].tolist() for c in ("event_id", "mid", "score", "ts", "cands", "csims", "more"))):
            head = (eid, uid, mid, sc_, ts)
            q.append((ts, eid, mid, sc_))
            q.sort()
            older = [e for e in q if (e[0], e[1]) <= (ts, eid)][-self.read:]
            for pos, e in enumerate(reversed(older)):
                out.append(head + ("r", pos, e[2], e[3]))
            q = q[-self.cap:]
            seen.add(mid)
            if cands is None:
                continue
            free = [(int(c), float(s)) for c, s in zip(cands, csims) if c not in seen][:self.n_cand]
            if len(free) < self.n_cand and more:
                out.extend(head + ("s", pos, c, None) for pos, c in enumerate(sorted(seen)))
            else:
                out.extend(head + ("c", pos, c, s) for pos, (c, s) in enumerate(free))
        _keep(self.queue, q, _QUEUE)
        if len(seen) > known:
            _keep(self.seen, sorted(seen), "<i4")
        if out:
            yield pd.DataFrame(out, columns=LOOP_OUT.fieldNames()).astype(
                {"uid": "int32", "mid": "int32", "pos": "int32", "x_mid": "int32"})

    def close(self) -> None:
        pass


def leading_sims(sims: DataFrame, lead: int = LEAD) -> DataFrame:
    """(mid, cands, csims, more): the ``lead`` most similar movies of each
    movie, best first, and whether its list goes on."""
    rank = F.row_number().over(Window.partitionBy("mid").orderBy(F.col("sim").desc(), F.col("sim_mid").asc()))
    first = sims.select("mid", "sim_mid", "sim", rank.alias("n")).filter(F.col("n") <= lead + 1)
    lists = first.groupBy("mid").agg(F.sort_array(F.collect_list(F.struct("n", "sim_mid", "sim"))).alias("l"))
    head = F.slice("l", 1, lead)
    return lists.select("mid", head["sim_mid"].alias("cands"), head["sim"].alias("csims"), (F.size("l") > lead).alias("more"))


def further_candidates(batch: DataFrame, sims: DataFrame, n_cand: int) -> DataFrame:
    """(event_id, uid, cand): the ``n_cand`` most similar movies not yet rated,
    from the whole lists, of the events whose rated movies (kind 's') are in
    the batch."""
    seen = batch.filter(F.col("kind") == "s").select("event_id", "uid", "mid", F.col("x_mid").alias("cand"))
    events = seen.select("event_id", "uid", "mid").distinct()
    rows = events.join(sims.select("mid", F.col("sim_mid").alias("cand"), "sim"), "mid").join(seen.select("event_id", "cand"), ["event_id", "cand"], "left_anti")
    w = Window.partitionBy("event_id").orderBy(F.col("sim").desc(), F.col("cand").asc())
    return rows.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n_cand).select("event_id", "uid", "cand")


def online_state_stream(events: DataFrame, sims: DataFrame, ratings: DataFrame,
                        cap: int = QUEUE_CAP, read: int = RECENT_READ, n_cand: int = 20) -> DataFrame:
    """Events -> stream-static join with the heads of the similarity lists
    (``leading_sims``) -> keyed state -> LOOP_OUT rows.  ``ratings`` seeds the
    seen sets once."""
    joined = events.join(sims, "mid", "left")
    init = ratings.select("uid", "mid").distinct().groupBy("uid")
    return joined.groupBy("uid").transformWithStateInPandas(
        statefulProcessor=OnlineState(cap, read, n_cand), outputStructType=LOOP_OUT,
        outputMode="Append", timeMode="None", initialState=init)


# ------------------------------------------------------- current tables

STREAM_RECS_SCHEMA = T.StructType([
    T.StructField("uid", T.IntegerType()),
    T.StructField("event_id", T.LongType()),
    T.StructField("recs", RECS),
])


def newest_per_user(log: DataFrame) -> DataFrame:
    """Keep, per user, the row of the newest version (column ``v`` kept)."""
    newest = F.max_by(F.struct("event_id", "recs", "v"), F.col("v"))
    return (log.groupBy("uid").agg(newest.alias("x"))
            .select("uid", "x.event_id", "x.recs", "x.v"))


def current_stream_recs(spark, root: str) -> DataFrame | None:
    """T5: per user, the list written by the newest batch that had an
    event of that user (an empty list still replaces an older one)."""
    log = ChangeLog(root, "StreamRecs").read(spark)
    if log is None:
        return None
    return newest_per_user(log).drop("v")


def current_ratings(spark, root: str, base: DataFrame) -> DataFrame:
    """The ratings table with every logged rating event applied."""
    log = ChangeLog(root, "rating_events").read(spark)
    return base if log is None else upsert_ratings(base, log)


# ------------------------------------------------------- the online loop

def score_batch(spark: SparkSession, batch: DataFrame, batch_id: int, sims: DataFrame,
                out_root: str, threshold: float = 0.6, fan: int = FAN, n_cand: int = 20) -> None:
    """T4 + T5 + T7 for one micro-batch of LOOP_OUT rows: score the
    candidates against the recent ratings (J10 + A8), then append the
    batch's events and its users' new lists as version ``batch_id`` of two
    change logs.  The work is proportional to the batch."""
    batch = batch.persist()
    try:
        events = batch.select("event_id", "uid", "mid", "score", "ts").dropDuplicates(["event_id"])
        recent = batch.filter(F.col("kind") == "r").select(
            "event_id", "pos", F.col("x_mid").alias("r_mid"), F.col("x_val").alias("r_score"))
        cands = batch.filter(F.col("kind") == "c").select("event_id", "uid", F.col("x_mid").alias("cand"))
        if not batch.filter(F.col("kind") == "s").isEmpty():
            cands = cands.unionByName(further_candidates(batch, sims, n_cand))
        scores = sc.score_candidates(cands, recent, sims, threshold)
        latest = sc.latest_recs(events, scores)
        ChangeLog(out_root, "StreamRecs", fan).write(latest, batch_id, newest_per_user)
        ChangeLog(out_root, "rating_events", fan).write(events, batch_id)
    finally:
        batch.unpersist()


def partitioned_sims(sims: DataFrame, partitions: int | None = None):
    """The similarity table written once as two bucketed tables in the
    shared checkpoint folder, bucketed on the keys the loop looks up:
    ``mid`` (the heads of the lists, candidates of an event) and (``mid``,
    ``sim_mid``) (similarity of a candidate to a recent rating).  Bucketed
    scans keep their hash partitioning, so each micro-batch shuffles only its
    own small side of these joins, never the similarity table."""
    import uuid
    from marquee.session import scratch_path
    spark = sims.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tag = uuid.uuid4().hex[:12]
    out = []
    for rows, keys, name in ((leading_sims(sims), ["mid"], f"sims_by_mid_{tag}"), (sims, ["mid", "sim_mid"], f"sims_by_pair_{tag}")):
        (rows.write.mode("overwrite").bucketBy(n, *keys).sortBy(*keys)
         .option("path", scratch_path(spark, name)).saveAsTable(name))
        out.append(spark.table(name))
    return tuple(out)


def run_online_loop(spark: SparkSession, source: DataFrame, ratings_base: DataFrame,
                    sims: DataFrame, out_root: str, checkpoint: str, marker: str,
                    n_recent: int = RECENT_READ, n_cand: int = 20, threshold: float = 0.6,
                    trigger: dict | None = None, fan: int = FAN):
    """Start the whole loop (T1 -> T2 -> T3/J6/W3 state -> foreachBatch
    T4/T5/T7); ``fan`` is that of the change logs.  The similarity table is cached partitioned for the loop's
    lookups; a new table from the offline job is picked up by restarting
    the query (its checkpoint keeps the state)."""
    with state_partitions(spark):
        by_mid, by_pair = partitioned_sims(sims)
        events = rating_message_stream(log_filter_stream(source, marker))
        state = online_state_stream(events, by_mid, ratings_base, QUEUE_CAP, n_recent, n_cand)

        def each(batch_df, batch_id):
            score_batch(spark, batch_df, batch_id, by_pair, out_root, threshold, fan, n_cand)

        return (state.writeStream.option("checkpointLocation", checkpoint)
                .trigger(**(trigger or {"processingTime": TRIGGER_INTERVAL}))
                .foreachBatch(each).start())


def run_rating_log(source: DataFrame, out_root: str, checkpoint: str, marker: str,
                   trigger: dict | None = None, fan: int = FAN):
    """T1 -> T2 -> T7 alone: append every batch's rating events to the
    ``rating_events`` log, which ``current_ratings`` applies on reading."""
    log = ChangeLog(out_root, "rating_events", fan)
    events = rating_message_stream(log_filter_stream(source, marker))

    def each(batch_df, batch_id):
        log.write(batch_df.select("event_id", "uid", "mid", "score", "ts").dropDuplicates(["event_id"]), batch_id)

    return (events.writeStream.option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": TRIGGER_INTERVAL})).foreachBatch(each).start())


# ------------------------------------------------------------- tag feed

def current_documents(spark, root: str, docs_base: DataFrame) -> DataFrame:
    """The base documents, each with its logged tag text behind its own;
    movies first tagged by the feed get a row too."""
    log = ChangeLog(root, "tag_chunks").read(spark)
    if log is None:
        return docs_base
    add = tag_text.joined(log, ("v", "part", "chunk"))
    both = docs_base.join(add, "mid", "full_outer").withColumn("tags", tag_text.extended(F.col("tags"), F.col("add")))
    return both.select(*docs_base.columns)


def current_tags(spark, root: str, tags_base: DataFrame) -> DataFrame:
    """The base tags plus every logged tag row."""
    log = ChangeLog(root, "tags").read(spark)
    return tags_base if log is None else tags_base.unionByName(log.select(*tags_base.columns))


def run_tag_feed(spark: SparkSession, tag_stream: DataFrame, tags_base: DataFrame,
                 docs_base: DataFrame, out_root: str, checkpoint: str,
                 trigger: dict | None = None, fan: int = FAN):
    """T8 as a stream: each micro-batch of tags (uid, mid, tag, ts,
    event_id) is appended to the tags log, and as chunks of text to the log
    of tag chunks.  A batch reads and rewrites no document, so it costs
    O(batch) even if one movie gets all tags; ``docs_base`` stays as it is,
    and ``current_documents`` puts the chunks behind it."""
    tags_log = ChangeLog(out_root, "tags", fan)
    chunk_log = ChangeLog(out_root, "tag_chunks", fan)

    def each(batch_df, batch_id):
        b = batch_df.persist()
        try:
            chunk_log.write(tag_text.tag_chunks(b), batch_id, tag_text.merged)
            tags_log.write(b.select(*tags_base.columns), batch_id)
        finally:
            b.unpersist()

    with state_partitions(spark):
        return (tag_stream.writeStream.option("checkpointLocation", checkpoint)
                .trigger(**(trigger or {"processingTime": TRIGGER_INTERVAL}))
                .foreachBatch(each).start())
