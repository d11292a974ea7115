"""The four jobs of the reference as Spark plans over named tables.

    load        S1-S3 (or the stand-in views) -> movies, ratings, tags,
                users; A4 + J1 + P13 -> documents (S4, S6) and their stored
                search index (X1)
    statistics  A1, A2 (partitioned by month), A3, A5 -> result tables
    offline     M1 ALS -> UserRecs (M3) ; embeddings or ALS item factors
                -> MovieRecs (M5 + A7)
    streaming   the online loop (T1-T7) against MovieRecs and ratings

``python -m marquee.plans.jobs <job> --out ROOT [--sf DIR]``
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from marquee.operators import documents as docs_ops
from marquee.operators import model as mdl
from marquee.operators import similarity as sim
from marquee.operators import statistics as st
from marquee.operators.text_index import write_index
from marquee.schemas import RATINGS
from marquee.sources import files, standin, tables


# The document fields that searches read.
INDEX_FIELDS = ("name", "descri", "genres", "actors", "directors", "tags")


def load_job(spark: SparkSession, out: str, sf: str | None = None, movies_path: str | None = None,
             ratings_path: str | None = None, tags_path: str | None = None, mode: str = "strict") -> None:
    """Load the three sources (files, or the stand-in views of ``sf``) and
    write movies, ratings, tags, users and the search documents."""
    if movies_path:
        movies, _ = files.read_movies(spark, movies_path, mode)
        ratings, _ = files.read_ratings(spark, ratings_path, mode)
        tags, _ = files.read_tags(spark, tags_path, mode)
        ratings = ratings.withColumn("ts", files.normalise_seconds("ts"))
        tags = tags.withColumn("ts", files.normalise_seconds("ts"))
    else:
        movies, ratings, tags = standin.movies(spark, sf), standin.ratings(spark, sf), standin.tags(spark, sf)
        tables.save_table(standin.users(spark, sf), out, "users")
    tables.save_table(movies, out, "movies")
    tables.save_table(ratings, out, "ratings")
    tables.save_table(tags, out, "tags")
    m = tables.load_table(spark, out, "movies")
    t = tables.load_table(spark, out, "tags")
    tables.save_documents(docs_ops.movie_documents(m, t), out, "documents", key="mid")
    write_index(tables.load_table(spark, out, "documents"), "mid", INDEX_FIELDS, f"{out.rstrip('/')}/index")


def statistics_job(spark: SparkSession, out: str, k: int = 10) -> None:
    """Counts, monthly counts, averages and per-genre top lists."""
    ratings = tables.load_table(spark, out, "ratings", RATINGS).persist()
    try:
        tables.save_table(st.rate_more_movies(ratings), out, "RateMoreMovies")
        tables.save_table(st.rate_more_movies_recently(ratings), out, "RateMoreMoviesRecently",
                          partition_by=["month"])
        tables.save_table(st.average_movies_score(ratings), out, "AverageMoviesScore")
    finally:
        ratings.unpersist()
    avgs = tables.load_table(spark, out, "AverageMoviesScore")
    movies = tables.load_table(spark, out, "movies")
    tables.save_table(st.genres_top_movies(movies, avgs, k), out, "GenresTopMovies")


def offline_job(spark: SparkSession, out: str, k: int = 10, threshold: float = 0.6,
                rank: int = 50, iters: int = 5, reg: float = 0.01,
                item_factors_sf: str | None = None) -> None:
    """ALS user lists and the item similarity lists.

    ``item_factors_sf`` takes item factors from the embeddings table of a
    test folder instead of the trained model (the stand-in of section 7.3).
    """
    ratings = tables.load_table(spark, out, "ratings", RATINGS)
    movies = tables.load_table(spark, out, "movies")
    model = mdl.train_als(ratings, rank, iters, reg)
    recs = mdl.user_recommendations(model, movies, k)
    user_lists = recs.groupBy("uid").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "mid", "score"))),
                    lambda x: F.struct(x["mid"].alias("mid"), x["score"].alias("score"))).alias("recs"))
    tables.save_table(user_lists, out, "UserRecs")
    factors = standin.item_factors(spark, item_factors_sf) if item_factors_sf else mdl.item_factors(model)
    sims = sim.item_similarity(factors, threshold)
    tables.save_table(sims, out, "MovieSims")            # long form, read by the stream
    tables.save_table(sim.similar_lists(tables.load_table(spark, out, "MovieSims")), out, "MovieRecs")


def streaming_job(spark: SparkSession, out: str, source_opts: dict, checkpoint: str,
                  marker: str = standin.RATING_MARKER, threshold: float = 0.6, trigger: dict | None = None):
    """Start the online loop; returns the StreamingQuery."""
    from marquee.streaming.pipeline import run_online_loop
    sims = tables.load_table(spark, out, "MovieSims")
    ratings = tables.load_table(spark, out, "ratings", RATINGS)
    return run_online_loop(spark, files_source(spark, {**source_opts, "checkpoint": checkpoint}), ratings, sims,
                           f"{out.rstrip('/')}/stream", checkpoint, marker, threshold=threshold,
                           trigger=trigger)


def files_source(spark, opts):
    from marquee.streaming.pipeline import rating_stream
    return rating_stream(spark, opts)


def main(argv=None):
    ap = argparse.ArgumentParser(prog="marquee.plans.jobs")
    ap.add_argument("job", choices=["load", "statistics", "offline", "streaming"])
    ap.add_argument("--out", required=True, help="root folder of the named tables")
    ap.add_argument("--sf", help="test-table folder for the stand-in views")
    ap.add_argument("--movies"), ap.add_argument("--ratings"), ap.add_argument("--tags")
    ap.add_argument("--mode", default="strict", choices=["strict", "quarantine"])
    ap.add_argument("--threshold", type=float, default=0.6)
    ap.add_argument("--source", help="stream source folder (parquet log lines)")
    ap.add_argument("--checkpoint", help="stream checkpoint folder")
    ap.add_argument("--master")
    a = ap.parse_args(argv)
    from marquee.session import get_session
    spark = get_session(a.master)
    if a.job == "load":
        load_job(spark, a.out, a.sf, a.movies, a.ratings, a.tags, a.mode)
    elif a.job == "statistics":
        statistics_job(spark, a.out)
    elif a.job == "offline":
        offline_job(spark, a.out, threshold=a.threshold, item_factors_sf=a.sf)
    else:
        q = streaming_job(spark, a.out, {"format": "parquet", "path": a.source}, a.checkpoint,
                          threshold=a.threshold)
        q.awaitTermination()


if __name__ == "__main__":
    main()
