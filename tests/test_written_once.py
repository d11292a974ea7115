"""Parts of a plan that are read twice are made once."""

from pyspark.sql import functions as F

from marquee.operators import scoring as sc
from marquee.operators.blend import with_fallback
from marquee.sources import standin as si


def counted(df, folder):
    """``df`` that leaves a file in ``folder`` whenever it is made."""
    folder.mkdir()

    def run(batches):
        import uuid
        open(f"{folder}/{uuid.uuid4().hex}", "w").close()
        yield from batches
    return df.coalesce(1).mapInPandas(run, df.schema)


def test_recs_are_made_once(spark, tmp_path):
    recs = spark.createDataFrame([(1, 1, 7, 0.5), (1, 2, 8, 0.4), (None, 1, 9, 0.3)], "uid int, rank int, mid int, score double")
    users = spark.createDataFrame([(1, ["a"]), (2, ["a b"]), (3, [])], "uid int, prefGenres array<string>")
    top = spark.createDataFrame([("a", 1, 5, 4.0)], "genre string, rank int, mid int, avg double")
    made = tmp_path / "recs"
    rows = with_fallback(counted(recs, made), users, top, 10, seed=None).collect()
    assert sorted((r.uid or 0, r["rank"], r.mid, r.source) for r in rows) == [(0, 1, 9, "recs"), (1, 1, 7, "recs"), (1, 2, 8, "recs"), (2, 1, 5, "genre")]
    assert len(list(made.iterdir())) == 1


def test_the_seen_set_is_made_once(spark, tmp_path):
    events = spark.createDataFrame([(1, 1, 10, 5.0, 100), (2, 2, 10, 5.0, 100)], "event_id long, uid int, mid int, score double, ts long")
    sims = spark.createDataFrame([(10, 11, 0.9), (10, 12, 0.8), (10, 13, 0.7)], "mid int, sim_mid int, sim double")
    seen = spark.createDataFrame([(1, 10, 100, 1), (1, 11, 50, -1), (2, 10, 100, 2), (2, 12, 200, 9)], "uid int, mid int, f_ts long, f_id long")
    made = tmp_path / "seen"
    rows = sc.candidates(events, sims, counted(seen, made), 2).collect()
    assert sorted((r.event_id, r.cand_rank, r.cand) for r in rows) == [(1, 1, 12), (1, 2, 13), (2, 1, 11), (2, 2, 12)]
    assert len(list(made.iterdir())) == 1


def test_ratings_of_some_users(spark, tmp_path):
    """Other users' orders leave before the join; the rows are those of a
    semi-join behind it, with keys that repeat or are null."""
    li = [(1, 7, 10.0, 0), (1, 7, 10.0, 0), (2, 8, 20.0, 1), (3, None, None, None), (None, 9, 5.0, 2), (5, 9, 5.0, 2)]
    spark.createDataFrame(li, "l_orderkey long, l_partkey long, l_quantity double, l_shipdate long") \
        .withColumn("l_shipdate", F.timestamp_seconds("l_shipdate")).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, 4), (1, 4), (2, 5), (3, 6), (5, None), (None, 4)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    users = spark.createDataFrame([(4,), (4,), (6,), (None,)], "uid int")
    got = si.ratings(spark, str(tmp_path), users)
    want = si.ratings(spark, str(tmp_path)).join(users.distinct(), "uid", "left_semi")
    key = lambda rows: sorted(map(str, rows))
    assert got.schema == want.schema and len(got.collect()) == 5 and key(got.collect()) == key(want.select(*got.columns).collect())
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner") < plan.index("Join LeftSemi")
