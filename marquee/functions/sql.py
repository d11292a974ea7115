"""Functions that SQL texts can call (2.12), defined in SQL: no Python runs.

* ``change_date(ts)``         -- month of epoch seconds as yyyyMM;
* ``star_log2(n)``            -- log2(max(n, 1)), the count term of a score;
* ``month_counts(m)``         -- table: (mid, n) of a month's ratings;
* ``best_rated(least)``       -- table: (mid, avg, n) of movies with at least
  that many ratings.

The table functions read the temporary view ``ratings``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCALAR = {
    "change_date(ts BIGINT) RETURNS BIGINT": "CAST(date_format(timestamp_seconds(ts), 'yyyyMM') AS BIGINT)",
    "star_log2(n BIGINT) RETURNS DOUBLE": "log2(greatest(n, 1))",
}
TABLE = {
    "month_counts(m BIGINT) RETURNS TABLE (mid INT, n BIGINT)":
        "SELECT mid, count(score) FROM ratings WHERE change_date(ts) = month_counts.m GROUP BY mid",
    "best_rated(least BIGINT) RETURNS TABLE (mid INT, avg DOUBLE, n BIGINT)":
        "SELECT mid, avg(score), count(*) FROM ratings GROUP BY mid HAVING count(*) >= best_rated.least",
}


def register_functions(spark: SparkSession, ratings: DataFrame | None = None) -> None:
    """Create the functions in the session; those on tables need
    ``ratings`` (uid, mid, score, ts)."""
    for head, body in SCALAR.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    if ratings is not None:
        ratings.createOrReplaceTempView("ratings")
        for head, body in TABLE.items():
            spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
