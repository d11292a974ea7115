"""Tag text by chunks, with a movie that gets most tags."""

import random

from pyspark.sql import functions as F

from marquee.operators import maintenance as mt
from marquee.operators import tag_text as tt
from marquee.session import scratch_path
from marquee.streaming import pipeline as pl
from marquee.streaming.change_log import ChangeLog

SCHEMA = "event_id long, uid int, mid int, tag string, ts long"


def feed(n=20_000, seed=4):
    """Ties in ts, nulls, empty tags; movie 7 gets nine tenths of all."""
    r = random.Random(seed)
    rows = [(i, 1, 7 if r.random() < 0.9 else r.randrange(40), r.choice(["a", "bb", "", None, "é|😀"]), r.choice([None, *range(300)])) for i in range(n)]
    return rows + [(n + 1, 1, 99, None, 5), rows[0], rows[0]]


def text_of(rows):
    low = lambda x: (x is not None, x if x is not None else 0)
    out = {}
    for i, _, mid, tag, ts in sorted(rows, key=lambda r: (low(r[4]), r[0], r[3] is not None, r[3] or "")):
        out.setdefault(mid, []).extend([tag] if tag is not None else [])
    return {mid: "|".join(t) if t else None for mid, t in out.items()}


def test_chunks_of_a_hot_movie(spark):
    rows = feed()
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    chunks = tt.placed(tt.tag_chunks(df, size=500)).cache()
    hot = chunks.filter("mid = 7").collect()
    assert len(hot) > 30 and max(c.n_tags for c in hot) <= 500 and len({c.part for c in hot}) > 1
    whole = text_of(rows)
    for c in chunks.filter("text is not null").collect():
        assert whole[c.mid][c.start:c.start + len(c.text)] == c.text
    assert {r.mid: r.add for r in tt.joined(chunks).collect()} == whole
    logged = chunks.drop("start").withColumn("v", F.lit(3))
    less = tt.merged(logged, width=5_000)
    assert {r.mid: r.add for r in tt.joined(less, ("v", "part", "chunk")).collect()} == whole
    assert less.filter("mid = 7").count() < len(hot) and less.agg(F.sum("n_tags")).first()[0] == sum(r[3] is not None for r in rows)
    chunks.unpersist()
    assert tt.joined(tt.tag_chunks(df.limit(0))).count() == 0


def test_documents_extended_by_a_hot_movie(spark):
    rows = feed(3_000)
    docs = spark.createDataFrame([(7, "old", "x"), (99, "kept", "x"), (50, None, "x"), (1, None, "x")], "mid int, tags string, add string")
    got = {r.mid: r.tags for r in mt.extend_tags(docs.drop("add"), spark.createDataFrame(rows, SCHEMA)).collect()}
    whole = text_of(rows)
    assert got == {7: "old|" + whole[7], 99: "kept", 50: None, 1: whole[1]}


def test_feed_appends_chunks_only(spark):
    """Five batches: the log has chunks alone, and the documents are the
    base texts with all batches behind them, in order of the batches."""
    rows = [(i, 1, 7, f"t{i}", i) for i in range(400)] + [(900, 1, 8, "n", 399)]
    root = scratch_path(spark, "t-chunks")
    log = ChangeLog(root, "tag_chunks", 2)
    for v in range(5):
        part = spark.createDataFrame([r for r in rows if r[4] // 80 == v], SCHEMA)
        for _ in range(2 if v == 3 else 1):                    # a retried batch
            log.write(tt.tag_chunks(part, size=10), v, tt.merged)
    base = spark.createDataFrame([(7, "old", "t"), (9, "own", "u")], "mid int, tags string, title string")
    got = {r.mid: (r.tags, r.title) for r in pl.current_documents(spark, root, base).collect()}
    assert got == {7: ("old|" + "|".join(f"t{i}" for i in range(400)), "t"), 8: ("n", None), 9: ("own", "u")}
    assert log.read(spark).columns.count("text") == 1 and log.read(spark).agg(F.sum("n_tags")).first()[0] == len(rows)
