"""Stand-in views over the driver's test tables.

The reference reads movie, rating and tag files that are not shipped; the
rules below derive tables of the same shape from the driver's tables so
that every operator runs over whole test tables (nothing is sampled or
capped).  All rules are plain column expressions, so Catalyst prunes the
unused columns of each source scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The preference-genre choices given to stand-in users, by
# c_custkey modulo 6 (the six p_type values of the part table).
PREF_GENRES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")

# Fixed value: the marker that tags rating lines in the service log.
RATING_MARKER = "movie_rating:"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ratings(spark: SparkSession, sf_dir: str, of: DataFrame | None = None) -> DataFrame:
    """ratings(uid, mid, score, ts): one row per line item of an order.
    ``of``: those of the users in its column ``uid`` alone; other users'
    orders leave before they meet their line items.

    score is the quantity on a half-star scale 0.0-5.0, ts the ship date in
    epoch seconds.  Every line item has its order, so the inner join keeps
    all line items; it is a plain equi-join left to Catalyst/AQE.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    od = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("int").alias("uid"))
    if of is not None:
        od = od.join(of.select("uid").distinct(), "uid", "left_semi")
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .select("uid",
                    F.col("l_partkey").cast("int").alias("mid"),
                    (F.floor(F.col("l_quantity") / 5 + 0.5) / F.lit(2.0)).cast("double").alias("score"),
                    F.unix_seconds(F.col("l_shipdate").cast("timestamp")).alias("ts")))


def issue_date(partkey_col):
    return F.date_add(F.lit("1995-01-01").cast("date"), (partkey_col % 2400).cast("int"))


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """movies(mid, name, descri, timelong, issue, shoot, language, genres,
    actors, directors) from the part table."""
    p = table(spark, sf_dir, "part")
    d = issue_date(F.col("p_partkey"))
    return p.select(
        F.col("p_partkey").cast("int").alias("mid"),
        F.col("p_name").alias("name"),
        F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("descri"),
        F.concat(F.col("p_size").cast("string"), F.lit(" minutes")).alias("timelong"),
        F.date_format(d, "MMMM d, yyyy").alias("issue"),
        F.date_format(d, "yyyy").alias("shoot"),
        F.lit("English").alias("language"),
        F.concat_ws("|", F.col("p_type"), F.split(F.col("p_name"), " ").getItem(0)).alias("genres"),
        F.regexp_replace(F.col("p_name"), " ", "|").alias("actors"),
        F.col("p_brand").alias("directors"),
    )


def _event_mid():
    return F.get_json_object(F.col("props"), "$.k").cast("int")


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tags(uid, mid, tag, ts): every event is a tag of movie props.k."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").cast("int").alias("uid"), _event_mid().alias("mid"),
                    F.col("event_type").alias("tag"),
                    F.unix_seconds(F.col("ts").cast("timestamp")).alias("ts"))


def tag_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags with their event id, for ordered tag feeds."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", F.col("user_id").cast("int").alias("uid"), _event_mid().alias("mid"),
                    F.col("event_type").alias("tag"),
                    F.unix_seconds(F.col("ts").cast("timestamp")).alias("ts"))


def rating_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rating_events(event_id, uid, mid, score, ts): purchases are ratings."""
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    return e.select(
        "event_id", F.col("user_id").cast("int").alias("uid"), _event_mid().alias("mid"),
        F.least(F.lit(5.0), F.floor(F.col("value") / 20 + 0.5) / F.lit(2.0)).cast("double").alias("score"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("ts"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw service log lines (key, value): purchases carry the rating
    marker followed by ``uid|mid|score|ts``, other events are noise."""
    e = table(spark, sf_dir, "events")
    score = F.least(F.lit(5.0), F.floor(F.col("value") / 20 + 0.5) / F.lit(2.0))
    msg = F.concat_ws("|", F.col("user_id").cast("string"), _event_mid().cast("string"),
                      score.cast("string"),
                      F.unix_seconds(F.col("ts").cast("timestamp")).cast("string"))
    value = F.when(F.col("event_type") == "purchase",
                   F.concat(F.lit("INFO web "), F.lit(RATING_MARKER), msg, F.lit(" ")))\
        .otherwise(F.concat(F.lit("INFO web "), F.col("event_type"), F.lit(" "), F.col("props")))
    return e.select(F.col("event_id").alias("offset"), F.col("user_id").cast("string").alias("key"),
                    value.alias("value"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """users(uid, username, first, ts, prefGenres) from the customer table."""
    c = table(spark, sf_dir, "customer")
    genres = F.array(*[F.lit(g) for g in PREF_GENRES])
    return c.select(F.col("c_custkey").cast("int").alias("uid"), F.col("c_name").alias("username"),
                    F.lit(True).alias("first"), F.lit(0).cast("bigint").alias("ts"),
                    F.array(F.element_at(genres, (F.pmod(F.col("c_custkey"), F.lit(6)) + 1).cast("int")))
                    .alias("prefGenres"))


def item_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item factors (mid, features) from the embeddings table, in double."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").cast("int").alias("mid"),
                    F.transform("embedding", lambda x: x.cast("double")).alias("features"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search documents (doc_id, text): whole texts, every document."""
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search requests (qid, text): each benchmark passage is one query."""
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), "text")
