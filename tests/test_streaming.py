"""Streams equal batches; restarting from the checkpoint neither loses nor
duplicates rows."""

from pyspark.sql import functions as F

from marquee.plans import queries_model as qm
from marquee.plans import queries_stream as qs
from marquee.session import scratch_path
from marquee.sources import standin as si
from marquee.sources.log_source import LogReader, _listed, read_log, write_log
from marquee.streaming import pipeline as pl
from tests.conftest import SF001


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_online_loop_equals_batch_and_restarts(spark):
    from marquee.plans.registry import QUERIES, load_all
    load_all()
    want = _rows(QUERIES["t5_latest_recs"](spark, SF001))
    sims = qm._sims(spark, SF001, reused=True)
    root, ck = scratch_path(spark, "t-loop"), scratch_path(spark, "t-ck")
    src = qs._log_source(spark, SF001, ck)
    q = pl.run_online_loop(spark, src, si.ratings(spark, SF001), sims, root, ck, si.RATING_MARKER,
                           qm.N_RECENT, qm.N_CAND, qm.TEST_THRESHOLD, qs.AT_ONCE)
    qs._finish(q)
    recs = pl.current_stream_recs(spark, root)
    got = _rows(recs.select("uid", "event_id", F.explode_outer("recs").alias("r"))
                .select("uid", "event_id", F.col("r.mid").alias("mid"), F.round("r.score", 6).alias("score")))
    assert got == want
    assert len([p for p in q.recentProgress if p["numInputRows"]]) >= 3
    newest = pl.ChangeLog(root, "StreamRecs").versions(spark)[-1]
    # restart on the same checkpoint: nothing new to process, nothing changes
    q2 = pl.run_online_loop(spark, src,
                            si.ratings(spark, SF001), sims, root, ck, si.RATING_MARKER,
                            qm.N_RECENT, qm.N_CAND, qm.TEST_THRESHOLD, {"availableNow": True})
    q2.awaitTermination()
    assert pl.ChangeLog(root, "StreamRecs").versions(spark)[-1] == newest
    assert _rows(pl.current_ratings(spark, root, si.ratings(spark, SF001))) == \
        _rows(QUERIES["t7_upsert_ratings"](spark, SF001))


RECS_KIND = "uid int, event_id long, recs array<struct<mid:int,score:double>>"


def test_change_log_merges_keep_reads(spark):
    root = scratch_path(spark, "t-log")
    log = pl.ChangeLog(root, "StreamRecs", fan=2)
    batches = [[(1, 10, [(5, 1.0)]), (2, 11, [])], [(1, 12, [(6, 2.0)])], [(3, 13, [(7, 0.5)]), (2, 14, [(8, 0.1)])]]
    for v, rows in enumerate(batches):
        log.write(spark.createDataFrame(rows, RECS_KIND), v, pl.newest_per_user)
    assert {r[0]: r[1] for r in _rows(pl.current_stream_recs(spark, root).select("uid", "event_id"))} == {1: 12, 2: 14, 3: 13}
    # merged rows keep their own version, so newest-wins still works
    assert sorted((r.uid, r.v) for r in log.read(spark).collect()) == [(1, 1), (2, 0), (2, 2), (3, 2)]
    assert [p[:3] for p in log.pieces(spark, 2)] == [[0, 1, 1], [2, 2, 0]]
    # batch 2 again (after a merge could have come): what it wrote is replaced
    log.write(spark.createDataFrame([(3, 15, [])], RECS_KIND), 2, pl.newest_per_user)
    assert {r[0]: r[1] for r in _rows(pl.current_stream_recs(spark, root).select("uid", "event_id"))} == {1: 12, 2: 11, 3: 15}
    assert sorted(r.v for r in log.read(spark, before=2).collect()) == [0, 1]


def test_change_log_stays_flat(spark):
    """Many batches: few pieces, two manifests, few files, each row written a
    few times; the batch at a merge retried leaves the same table."""
    import os
    root = scratch_path(spark, "t-flat")
    log = pl.ChangeLog(root, "rows", fan=3)
    one = spark.range(1).selectExpr("cast(id as int) as uid", "id as event_id").coalesce(1)
    written = []
    keep = log._write
    log._write = lambda df, a, b, t: written.append((a, b)) or keep(df, a, b, t)
    most = 0
    for v in range(60):
        rows = one.withColumn("event_id", F.lit(v).cast("long"))
        log.write(rows, v)
        if v in (26, 53):                      # several tiers merge here
            log.write(rows, v)
        most = max(most, len(log.pieces(spark, v)))
    assert sorted(r.event_id for r in log.read(spark).collect()) == list(range(60))
    assert most <= 2 * 4 + 1 and log.versions(spark) == [58, 59]
    folder = log.path.removeprefix("file:")
    assert len([n for n in os.listdir(folder) if n[0].isdigit()]) <= 2 * most + 8
    assert sum(b - a + 1 for a, b in written) <= 62 * 5


def test_recent_queue_with_initial_state(spark):
    """P7 dump as the initial state of the T3 queue: the first event of a
    user sees the dumped entries as its older ratings; the cap holds."""
    src = scratch_path(spark, "t-src")
    spark.createDataFrame([(100, 1, 7, 4.0, 1000), (101, 1, 8, 2.0, 1001), (102, 2, 9, 1.0, 1002)],
                          "event_id long, uid int, mid int, score double, ts long").write.parquet(src)
    init = spark.createDataFrame([(1, 500, 1, 3, 5.0), (1, 600, 2, 4, 3.0), (1, 400, 3, 5, 1.0)],
                                 "uid int, ts long, event_id long, mid int, score double")
    events = spark.readStream.schema("event_id long, uid int, mid int, score double, ts long").parquet(src)
    out, ck = scratch_path(spark, "t-out"), scratch_path(spark, "t-ck3")
    q = pl.write_stream(pl.recent_ratings_stream(events, cap=3, read=3, initial=init),
                        {"format": "parquet", "path": out}, ck, {"availableNow": True})
    q.awaitTermination()
    got = {}
    for r in spark.read.parquet(out).collect():
        got.setdefault(r.event_id, []).append((r.pos, r.r_mid))
    assert sorted(got[100]) == [(0, 7), (1, 4), (2, 3)]       # newest 3 incl. the dump
    assert sorted(got[101]) == [(0, 8), (1, 7), (2, 4)]
    assert sorted(got[102]) == [(0, 9)]


def test_tag_feed_stream_with_compaction_equals_batch(spark):
    """T8 fed one file per 3 days, compacting after every batch: the final
    documents equal the batch result."""
    from marquee.operators.documents import aggregate_tags
    from marquee.plans.queries_batch import TAG_FEED_START
    from marquee.plans.registry import QUERIES, load_all
    load_all()
    want = sorted(tuple(r) for r in QUERIES["t8_apply_new_tags"](spark, SF001).collect())
    te = si.tag_events(spark, SF001)
    old = te.filter(F.col("ts") < TAG_FEED_START)
    new = te.filter(F.col("ts") >= TAG_FEED_START)
    path = write_log(new, scratch_path(spark, "t-tags-src"), F.col("ts"), F.col("mid"), 3 * 86400)
    root, ck = scratch_path(spark, "t-tags"), scratch_path(spark, "t-tags-ck")
    stream = read_log(spark, path, qs.TAG_SCHEMA, ck)
    docs = aggregate_tags(old.select("uid", "mid", "tag", "ts"))
    q = pl.run_tag_feed(spark, stream, old, docs, root, ck, qs.AT_ONCE, fan=2)
    qs._finish(q)
    assert len(q.recentProgress) >= 3
    got = sorted(tuple(r) for r in pl.current_documents(spark, root, docs).select("mid", "tags").collect())
    assert got == want
    assert pl.current_tags(spark, root, old).count() == te.count()


def test_retried_batch_rewrites_not_duplicates(spark):
    """score_batch run twice with the same batch id (a retry) leaves one
    version per log and the same current tables."""
    root = scratch_path(spark, "t-retry")
    sims = spark.createDataFrame([(20, 11, 0.9), (20, 10, 0.7)], "mid int, sim_mid int, sim double")
    rows = [(2, 1, 11, 2.0, 200, "r", 0, 11, 2.0), (2, 1, 11, 2.0, 200, "r", 1, 10, 5.0),
            (2, 1, 11, 2.0, 200, "c", 0, 20, 0.9)]
    batch = spark.createDataFrame(rows, pl.LOOP_OUT)
    for _ in range(2):
        pl.score_batch(spark, batch, 0, sims, root, threshold=0.6)
    assert pl.ChangeLog(root, "StreamRecs").versions(spark) == [0]
    recs = pl.current_stream_recs(spark, root).collect()
    assert len(recs) == 1 and [(x.mid, round(x.score, 9)) for x in recs[0].recs] == [(20, round((1.8 + 3.5) / 2, 9))]
    assert pl.ChangeLog(root, "rating_events").read(spark).count() == 1


EVENT = "id long, k int, t long"


def _events(spark, lo, hi):
    return spark.range(lo, hi).select("id", (F.col("id") % 7).cast("int").alias("k"), F.col("id").alias("t"))


def test_log_source_batches_partitions_and_restart(spark):
    from pyspark.sql.types import _parse_datatype_string
    path, out, ck = (scratch_path(spark, n) for n in ("t-log-src", "t-log-out", "t-log-ck"))
    kind = _parse_datatype_string(EVENT)
    write_log(_events(spark, 0, 1000), path, F.col("t"), F.col("k"), 250, files=3)
    chunks = _listed(path)
    assert sorted(chunks) == [0, 1, 2, 3] and all(len(v) > 1 for v in chunks.values())
    seen = []

    def each(df, batch_id):
        seen.append((batch_id, df.rdd.getNumPartitions(), df.count()))
        df.write.mode("append").parquet(out)

    def go():
        q = read_log(spark, path, kind, ck).writeStream.option("checkpointLocation", ck).foreachBatch(each).start()
        q.processAllAvailable()
        q.stop()

    go()
    assert [n for _, _, n in seen] == [250] * 4 and all(p > 1 for _, p, _ in seen)
    go()                                                   # nothing new
    assert len(seen) == 4
    import os
    later = write_log(_events(spark, 1000, 1600), scratch_path(spark, "t-log-later"), F.col("t"), F.col("k"), 250, files=2)
    base, more = (p.removeprefix("file:") for p in (path, later))
    for d in os.listdir(more):
        if d.startswith("chunk="):
            os.symlink(os.path.join(more, d), os.path.join(base, d))
    go()                                                   # goes on behind its offsets
    ids = sorted(r.id for r in spark.read.schema(kind).parquet(out).collect())
    assert ids == list(range(1600))
    # a key's rows of a chunk are in one file
    for files in chunks.values():
        keys = [{r.k for r in spark.read.parquet(f).collect()} for f in files]
        assert sum(map(len, keys)) == len(set().union(*keys))


def test_log_reader_never_steps_back(spark):
    path = scratch_path(spark, "t-log-offsets")
    write_log(_events(spark, 0, 500), path, F.col("t"), F.col("k"), 100, files=2)
    new = LogReader(path, None, 2, scratch_path(spark, "t-no-ck"))
    assert new.initialOffset() == {"chunk": 0} and new.latestOffset() == {"chunk": 2} == new.latestOffset()
    assert {p.path.rsplit("/", 2)[-2] for p in new.partitions({"chunk": 0}, {"chunk": 2})} == {"chunk=0", "chunk=1"}
    assert new.latestOffset() == {"chunk": 4}
    restarted = LogReader(path, None, 2)
    assert restarted.latestOffset() == {"chunk": 5}        # not before what may be committed
    restarted.commit({"chunk": 5})
    assert restarted.latestOffset() == {"chunk": 5}
    empty = LogReader(scratch_path(spark, "t-none"), None, 1)
    assert empty.initialOffset() == empty.latestOffset() == {"chunk": 0}


def test_trigger_runs_timed_batches(spark):
    """A processing-time trigger, watched by a query listener."""
    import threading
    import time

    from pyspark.sql.streaming import StreamingQueryListener
    from pyspark.sql.types import _parse_datatype_string
    path, out, ck = (scratch_path(spark, n) for n in ("t-trig-src", "t-trig-out", "t-trig-ck"))
    write_log(_events(spark, 0, 300), path, F.col("t"), F.col("k"), 100, files=2)
    batches, enough = [], threading.Event()

    class Watch(StreamingQueryListener):
        def onQueryStarted(self, event):
            pass

        def onQueryProgress(self, event):
            if event.progress.numInputRows:
                batches.append((event.progress.batchId, event.progress.timestamp, event.progress.numInputRows))
            if len(batches) >= 3:
                enough.set()

        def onQueryIdle(self, event):
            pass

        def onQueryTerminated(self, event):
            pass

    watch = Watch()
    spark.streams.addListener(watch)
    try:
        q = pl.write_stream(read_log(spark, path, _parse_datatype_string(EVENT), ck), {"format": "parquet", "path": out}, ck)
        assert enough.wait(90)
        q.stop()
        time.sleep(0.5)
    finally:
        spark.streams.removeListener(watch)
    from datetime import datetime
    at = [datetime.fromisoformat(t.replace("Z", "+00:00")).timestamp() for _, t, _ in batches[:3]]
    assert [n for _, _, n in batches[:3]] == [100] * 3
    # batches start on the interval of two seconds, or later where one took longer
    assert all(b - a >= 1.0 for a, b in zip(at, at[1:])) and all(abs(x - 2 * round(x / 2)) < 1.0 for x in at[1:])


def test_events_carry_the_head_of_a_list_and_the_rest_is_found(spark):
    """T5: one row a movie goes to the state, however many movies are like it;
    an event whose head is all rated gets its candidates from the whole list."""
    sims = spark.createDataFrame([(1, 100 + i, 1.0 - i / 100) for i in range(30)] + [(100 + i, 1, 1.0 - i / 100) for i in range(30)],
                                 "mid int, sim_mid int, sim double")
    heads = {r.mid: r for r in pl.leading_sims(sims, 5).collect()}
    assert len(heads) == 31 and heads[1].cands == [100, 101, 102, 103, 104] and heads[1].more and not heads[100].more
    assert heads[1].csims == [1.0 - i / 100 for i in range(5)]
    rated = [1, *range(100, 107)]
    rows = [(7, 3, 1, 5.0, 200, "r", 0, 1, 5.0)] + [(7, 3, 1, 5.0, 200, "s", i, m, None) for i, m in enumerate(rated)]
    root = scratch_path(spark, "t-further")
    pl.score_batch(spark, spark.createDataFrame(rows, pl.LOOP_OUT), 0, sims, root, threshold=0.6, n_cand=4)
    assert [x.mid for x in pl.current_stream_recs(spark, root).first().recs] == [107, 108, 109, 110]
