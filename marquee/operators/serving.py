"""Serving reads in set-based form.

Each reference call answers one user or movie; here a ``requests``
DataFrame carries many keys and one join answers them all.  The request
table is joined like any other table: Spark broadcasts it when its measured
size is small and shuffles it otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.columns import top_recs


def movies_by_ids(movies: DataFrame, ranked: DataFrame, key: str = "req") -> DataFrame:
    """Restrict movies to a ranked id list, keeping the rank and
    duplicates (R9).  ``ranked`` has (key, rank, mid, ...)."""
    return ranked.join(movies, "mid")


def enrich(movies: DataFrame, averages: DataFrame) -> DataFrame:
    """Every movie with its average score; no average -> 0.0."""
    return (movies.join(averages.select("mid", "avg"), "mid", "left")
            .withColumn("score", F.coalesce(F.col("avg"), F.lit(0.0))).drop("avg"))


def latest_rating(ratings: DataFrame) -> DataFrame:
    """One rating per (uid, mid): the latest by ts, then the higher score."""
    w = Window.partitionBy("uid", "mid").orderBy(F.col("ts").desc(), F.col("score").desc())
    return ratings.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def my_rated_movies(ratings: DataFrame, movies: DataFrame, averages: DataFrame,
                    requests: DataFrame) -> DataFrame:
    """Movies each requested user rated, with the user's own score
    replacing the average -> (uid, mid, name, score)."""
    mine = latest_rating(ratings.join(requests.select("uid").distinct(), "uid", "left_semi"))
    j = (mine.select("uid", "mid", F.col("score").alias("own"))
         .join(movies.select("mid", "name"), "mid")
         .join(averages.select("mid", "avg"), "mid", "left"))
    return j.select("uid", "mid", "name", F.coalesce("own", "avg", F.lit(0.0)).alias("score"))


def lookup_ratings(ratings: DataFrame, requests: DataFrame) -> DataFrame:
    """Ratings of the requested keys; ``requests`` has uid, or uid and
    mid."""
    keys = [c for c in ("uid", "mid") if c in requests.columns]
    return ratings.join(requests.select(*keys).distinct(), keys, "left_semi")


def rating_exists(ratings: DataFrame, requests: DataFrame) -> DataFrame:
    """P14 (exists): requests + ``exists`` flag, one output row per request."""
    keys = [c for c in ("uid", "mid") if c in requests.columns]
    present = ratings.select(*keys).distinct().withColumn("exists", F.lit(True))
    return (requests.join(present, keys, "left")
            .withColumn("exists", F.coalesce("exists", F.lit(False))))


def lookup_tags(tags: DataFrame, requests: DataFrame) -> DataFrame:
    """Tags of requested movies, or of requested (uid, mid)."""
    keys = [c for c in ("uid", "mid") if c in requests.columns]
    return tags.join(requests.select(*keys).distinct(), keys, "left_semi")


def best_of_lists(lists: DataFrame, requests: DataFrame, key: str, n: int) -> DataFrame:
    """For each request key, the best ``n`` recs of its stored list;
    a key without a list gets an empty one.  -> requests + recs."""
    return (requests.join(lists.select(key, "recs"), key, "left")
            .withColumn("recs", top_recs("recs", n)))


def explode_recs(df: DataFrame, keys: list[str]) -> DataFrame:
    """Nested lists -> long rows (keys..., rank, mid, score); rank from 1."""
    return (df.select(*keys, F.posexplode("recs").alias("pos", "r"))
            .select(*keys, (F.col("pos") + 1).cast("int").alias("rank"),
                    F.col("r.mid").alias("mid"), F.col("r.score").alias("score")))


def lookup_users(users: DataFrame, requests: DataFrame) -> DataFrame:
    """K3: users by ``username`` or by ``uid``."""
    key = "username" if "username" in requests.columns else "uid"
    return users.join(requests.select(key).distinct(), key, "left_semi")


def exists_keys(table: DataFrame, requests: DataFrame, key: str) -> DataFrame:
    """K3: requests + ``exists`` flag for a movie or user key."""
    present = table.select(key).distinct().withColumn("exists", F.lit(True))
    return requests.join(present, key, "left").withColumn("exists", F.coalesce("exists", F.lit(False)))
