"""Rating statistics and the serving top-n reads (A1-A3, A5, A9, A10,
J2, W1, L1-L4, L8, P18, P19).

Aggregates are hash aggregates with map-side partial aggregation, so a hot
movie or user costs one partial row per map task, not one row per rating.
Per-group top-k is ``row_number() <= k`` over a window: Spark plans a
partial ``WindowGroupLimit`` *before* the shuffle, so each map task ships at
most k rows per group even when one genre holds most of the catalogue.
Global top-n reads are ``orderBy().limit()`` (TakeOrderedAndProject: a
per-partition top-n and one small merge).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.columns import explode_genres, month_bucket, sort_recs, top_recs
from marquee.schemas import RECS


def rate_more_movies(ratings: DataFrame) -> DataFrame:
    """A1: number of (non-null) scores per movie -> (mid, count)."""
    return ratings.groupBy("mid").agg(F.count("score").alias("count"))


def rate_more_movies_recently(ratings: DataFrame) -> DataFrame:
    """A2: number of scores per (month, movie) -> (mid, month, count)."""
    return (ratings.select("mid", "score", month_bucket("ts").alias("month"))
            .groupBy("month", "mid").agg(F.count("score").alias("count"))
            .select("mid", "month", "count"))


def average_movies_score(ratings: DataFrame) -> DataFrame:
    """A3: mean score per movie -> (mid, avg)."""
    return ratings.groupBy("mid").agg(F.avg("score").alias("avg"))


def ranked_genres(movies: DataFrame, averages: DataFrame, k: int = 10) -> DataFrame:
    """J2 + W1: top ``k`` movies per genre by average, ties by mid ->
    (genre, rank, mid, avg).  Long form, one row per listed movie."""
    g = explode_genres(movies.select("mid", "genres"))
    joined = averages.select("mid", "avg").join(g, "mid")
    w = Window.partitionBy("genre").orderBy(F.col("avg").desc(), F.col("mid").asc())
    return (joined.withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= k)
            .select("genre", F.col("rank").cast("int").alias("rank"), "mid", "avg"))


def genres_top_movies(movies: DataFrame, averages: DataFrame, k: int = 10) -> DataFrame:
    """A5 (+P18): (genre, recs ARRAY<STRUCT<mid, score>>), best first.

    The list is built from at most k rows per genre, so the grouped
    ``collect_list`` is bounded by k whatever the data size.
    """
    ranked = ranked_genres(movies, averages, k)
    return (ranked.groupBy("genre")
            .agg(sort_recs(F.collect_list(F.struct(F.col("mid").cast("int").alias("mid"),
                                                    F.col("avg").cast("double").alias("score"))))
                 .cast(RECS).alias("recs")))


def pivot_top_genres(ranked: DataFrame, n: int = 10) -> DataFrame:
    """Ranks as columns -> (genre, mid_1, avg_1, ..., mid_n, avg_n).

    The pivot values are given, so no extra job runs to discover them.
    """
    p = (ranked.filter(F.col("rank") <= n).groupBy("genre")
         .pivot("rank", list(range(1, n + 1)))
         .agg(F.first("mid").alias("mid"), F.first("avg").alias("avg")))
    cols = ["genre"]
    for i in range(1, n + 1):
        p = p.withColumnRenamed(f"{i}_mid", f"mid_{i}").withColumnRenamed(f"{i}_avg", f"avg_{i}")
        cols += [f"mid_{i}", f"avg_{i}"]
    return p.select(*cols)


def histogram_bin(score) -> F.Column:
    """Half-star bin = round-half-up(score / 0.5), 0..10."""
    s = F.col(score) if isinstance(score, str) else score
    return F.floor(s / 0.5 + 0.5).cast("int")


def rating_histogram(ratings: DataFrame, dense: bool = False) -> DataFrame:
    """A10: per-user counts of ratings by half-star bin.

    Long form (uid, bin, count), or with ``dense=True`` one row per user
    with an 11-slot array ``stat`` (one aggregate, no join with a bin list).
    """
    b = ratings.filter(F.col("score").isNotNull()).select("uid", histogram_bin("score").alias("bin"))
    if dense:
        return b.groupBy("uid").agg(
            F.array(*[F.count_if(F.col("bin") == i) for i in range(11)]).alias("stat"))
    return b.groupBy("uid", "bin").agg(F.count(F.lit(1)).alias("count"))


def top_rated_count(rate_more: DataFrame, n: int = 10) -> DataFrame:
    """L2: the ``n`` most-rated movies -> (rank, mid, count)."""
    w = Window.orderBy(F.col("count").desc(), F.col("mid").asc())
    top = rate_more.orderBy(F.col("count").desc(), F.col("mid").asc()).limit(n)
    return top.select(F.row_number().over(w).cast("int").alias("rank"), "mid", "count")


def hot_movies(rate_more_recently: DataFrame, n: int = 10) -> DataFrame:
    """L3: latest month first, then most ratings -> (rank, mid, month, count)."""
    order = [F.col("month").desc(), F.col("count").desc(), F.col("mid").asc()]
    top = rate_more_recently.orderBy(*order).limit(n)
    return top.select(F.row_number().over(Window.orderBy(*order)).cast("int").alias("rank"),
                      "mid", "month", "count")


def new_movies(movies: DataFrame, n: int = 10, as_text: bool = False) -> DataFrame:
    """L4: newest ``n`` movies by issue date -> (rank, mid, issue).

    R10: ``issue`` is parsed as ``MMMM d, yyyy`` (unparsable -> last);
    ``as_text=True`` sorts the raw text instead, as the reference does.
    """
    key = F.col("issue") if as_text else F.try_to_date(F.col("issue"), "MMMM d, yyyy")
    order = [key.desc_nulls_last(), F.col("mid").asc()]
    top = movies.select("mid", "issue").orderBy(*order).limit(n)
    key2 = F.col("issue") if as_text else F.try_to_date(F.col("issue"), "MMMM d, yyyy")
    return top.select(F.row_number().over(Window.orderBy(key2.desc_nulls_last(), F.col("mid").asc()))
                      .cast("int").alias("rank"), "mid", "issue")


def genre_lookup(top: DataFrame, requests: DataFrame, n: int = 10) -> DataFrame:
    """Best ``n`` of each requested genre.

    ``top`` is GenresTopMovies (genre, recs); ``requests`` has a ``genre``
    column (plus any request key).  A genre without a list gives an empty
    list.  Returns requests + ``recs``.
    """
    j = requests.join(top.select("genre", "recs"), "genre", "left")
    return j.withColumn("recs", top_recs("recs", n))
