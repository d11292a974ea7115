"""Registered queries: readers and named tables (S1-S6), SQL functions.

The source files are written from the test tables, with some malformed lines
among them, and read back by the readers under test.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.operators import documents as docs_ops
from marquee.operators import statistics as st
from marquee.plans.queries_batch import r6
from marquee.plans.registry import ORACLE, register
from marquee.plans.sqlviews import with_views
from marquee.schemas import MOVIES, RATINGS
from marquee.session import scratch_path
from marquee.sources import files, tables
from marquee.sources import standin as si


def _written(df, line, name: str) -> str:
    path = scratch_path(df.sparkSession, name)
    df.select(line.alias("value")).write.text(path)
    return path


def _with_bad(good, bad):
    """Good rows, and bad lines in ``line``, as one table."""
    return good.withColumn("line", F.lit(None).cast("string")).unionByName(bad, allowMissingColumns=True)


@register("s1_read_movies", with_views("movies") + """
SELECT mid, name, descri, timelong, issue, shoot, language, genres, actors, directors, NULL AS line FROM movies
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'x' || mid || '^broken' FROM movies WHERE mid % 97 = 0""")
def s1_read_movies(spark, sf):
    """The catalogue from ``^``-separated text, blanks around fields."""
    movies = si.movies(spark, sf)
    line = F.concat_ws("^", *[F.concat(F.lit(" "), F.col(f.name).cast("string"), F.lit(" ")) for f in MOVIES.fields])
    lines = movies.select(F.explode(F.when(F.col("mid") % 97 == 0, F.array(line, F.concat(F.lit("x"), "mid", F.lit("^broken")))).otherwise(F.array(line))).alias("l"))
    return _with_bad(*files.read_movies(spark, _written(lines, F.col("l"), "movies-text"), "quarantine"))


@register("s2_read_ratings", with_views("ratings") + """
SELECT uid, mid, score, ts, NULL AS line FROM ratings
UNION ALL SELECT NULL, NULL, NULL, NULL, uid || ',none,' || ts FROM ratings WHERE uid % 97 = 0""")
def s2_read_ratings(spark, sf):
    """The ratings from comma-separated text."""
    line = F.concat_ws(",", "uid", "mid", "score", "ts")
    lines = si.ratings(spark, sf).select(F.explode(F.when(F.col("uid") % 97 == 0, F.array(line, F.concat_ws(",", "uid", F.lit("none"), "ts")))
                                                   .otherwise(F.array(line))).alias("l"))
    return _with_bad(*files.read_ratings(spark, _written(lines, F.col("l"), "ratings-text"), "quarantine"))


@register("s3_read_tags", with_views("tags") + """
SELECT uid, mid, tag, ts, NULL AS line FROM tags
UNION ALL SELECT NULL, NULL, NULL, NULL, concat_ws(',', uid, mid, 'a', 'b', ts) FROM tags WHERE uid % 97 = 0""")
def s3_read_tags(spark, sf):
    """S3: the tags from comma-separated text; a comma within a tag makes a
    bad line."""
    line = F.concat_ws(",", "uid", "mid", "tag", "ts")
    lines = si.tags(spark, sf).select(F.explode(F.when(F.col("uid") % 97 == 0, F.array(line, F.concat_ws(",", "uid", "mid", F.lit("a"), F.lit("b"), "ts")))
                                                .otherwise(F.array(line))).alias("l"))
    return _with_bad(*files.read_tags(spark, _written(lines, F.col("l"), "tags-text"), "quarantine"))


@register("s4_named_tables", ORACLE["a2_rate_more_movies_recently"])
def s4_named_tables(spark, sf):
    """S4 + S5: the monthly counts, computed from a saved ratings table,
    saved by month and loaded again."""
    root = scratch_path(spark, "named")
    tables.save_table(si.ratings(spark, sf), root, "ratings")
    ratings = tables.load_table(spark, root, "ratings", RATINGS)
    counts = st.rate_more_movies_recently(ratings)
    tables.save_table(counts, root, "RateMoreMoviesRecently", partition_by=["month"])
    return tables.load_table(spark, root, "RateMoreMoviesRecently", counts.schema).select("mid", "month", "count")


@register("s6_document_set", ORACLE["j1_movie_documents"])
def s6_document_set(spark, sf):
    """The search documents, each written twice (an older one first);
    the newer one by version stays."""
    root = scratch_path(spark, "docset")
    docs = docs_ops.movie_documents(si.movies(spark, sf), si.tags(spark, sf))
    old = docs.withColumn("name", F.lit("old")).withColumn("version", F.lit(1))
    tables.save_documents(old.unionByName(docs.withColumn("version", F.lit(2))), root, "documents", "mid", ["version"])
    return tables.load_table(spark, root, "documents").drop("version")


@register("f1_sql_functions", with_views("ratings") + """,
m AS (SELECT mid, CAST(strftime(make_timestamp(ts * 1000000), '%Y%m') AS BIGINT) AS month, score FROM ratings),
b AS (SELECT mid, avg(score) AS avg, count(*) AS n FROM ratings GROUP BY mid HAVING count(*) >= 20)
SELECT m.month, m.mid, count(m.score) AS n, round(log2(greatest(count(m.score), 1)), 6) AS weight, round(any_value(b.avg), 6) AS avg
FROM m LEFT JOIN b ON b.mid = m.mid GROUP BY m.month, m.mid""")
def f1_sql_functions(spark, sf):
    """2.12: functions called by name in SQL, scalar and table."""
    from marquee.functions.sql import register_functions
    register_functions(spark, si.ratings(spark, sf))
    return spark.sql("""
        WITH m AS (SELECT change_date(ts) AS month, mid, count(score) AS n FROM ratings GROUP BY change_date(ts), mid)
        SELECT m.month, m.mid, m.n, round(star_log2(m.n), 6) AS weight, round(b.avg, 6) AS avg
        FROM m LEFT JOIN best_rated(20) b ON b.mid = m.mid""")


@register("f2_month_table_function", with_views("ratings") + """
SELECT mid, count(score) AS n, count(score) / 2 AS half FROM ratings
WHERE strftime(make_timestamp(ts * 1000000), '%Y%m') = '199501' GROUP BY mid""")
def f2_month_table_function(spark, sf):
    """2.12: one month's counts from a table function."""
    from marquee.functions.sql import register_functions
    register_functions(spark, si.ratings(spark, sf))
    return spark.sql("SELECT mid, n, n / 2 AS half FROM month_counts(199501)")
