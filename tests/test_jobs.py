"""The four jobs end to end on sf0.001 into named tables."""

from pyspark.sql import functions as F

from marquee.plans import jobs
from marquee.plans.registry import QUERIES, load_all
from marquee.session import scratch_path
from marquee.sources import standin as si
from marquee.sources import tables
from tests.conftest import SF001


def test_jobs_end_to_end(spark):
    load_all()
    out = scratch_path(spark, "t-jobs")
    jobs.load_job(spark, out, sf=SF001)
    jobs.statistics_job(spark, out)
    # GenresTopMovies equals the registered long-form query
    top = tables.load_table(spark, out, "GenresTopMovies")
    got = sorted((r.genre, i + 1, x.mid) for r in top.collect() for i, x in enumerate(r.recs))
    want = sorted((r.genre, r.rank, r.mid) for r in QUERIES["a5_genres_top_movies"](spark, SF001).collect())
    assert got == want
    monthly = tables.load_table(spark, out, "RateMoreMoviesRecently")
    assert "month" in monthly.columns and monthly.count() == QUERIES["a2_rate_more_movies_recently"](spark, SF001).count()
    docs = tables.load_table(spark, out, "documents")
    assert docs.count() == si.movies(spark, SF001).count()
    # the load job's index answers searches without the documents
    from marquee.operators import search as se
    from marquee.operators.text_index import open_index
    ix = open_index(spark, f"{out}/index")
    asked = docs.select(F.col("mid").alias("qid"), F.col("name").alias("text"))
    best = se.search(ix, asked, ("name",), 1)
    assert best.count() == docs.count() and ix.stats["name"][0] == docs.count()
    jobs.offline_job(spark, out, rank=8, iters=3, threshold=0.3, item_factors_sf=SF001)
    sims = tables.load_table(spark, out, "MovieSims")
    assert sims.count() == QUERIES["m5_item_similarity"](spark, SF001).count()
    lists = tables.load_table(spark, out, "UserRecs")
    assert lists.filter(F.size("recs") > 10).count() == 0 and lists.count() > 0
    # streaming job over a staged log source
    from marquee.plans import queries_stream as qs
    from marquee.sources.log_source import FORMAT, write_log
    ev = si.table(spark, SF001, "events").select(F.col("event_id").alias("offset"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("_t"))
    lines = si.log_lines(spark, SF001).join(ev, "offset")
    src_path = write_log(lines, scratch_path(spark, "t-jobs-src"), F.col("_t"), F.col("key"), qs.CHUNK_SECONDS)
    q = jobs.streaming_job(spark, out, {"format": FORMAT, "path": src_path}, scratch_path(spark, "t-jobs-ck"),
                           threshold=0.3, trigger=qs.AT_ONCE)
    qs._finish(q)
    from marquee.streaming import pipeline as pl
    assert pl.current_stream_recs(spark, f"{out}/stream").count() > 0
