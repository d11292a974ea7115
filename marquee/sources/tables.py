"""Named result tables.

The reference keeps its results in a document store; here each named table
is a Parquet dataset under one root folder.  Tables that are read by key
(per-user and per-movie lists) can be written bucketed/sorted by that key so
that later joins on the key are co-located.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The table names the writers and readers agree on.
TABLE_NAMES = ("movies", "ratings", "tags", "users", "RateMoreMovies",
               "RateMoreMoviesRecently", "AverageMoviesScore",
               "GenresTopMovies", "UserRecs", "MovieRecs", "StreamRecs")


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def save_table(df: DataFrame, root: str, name: str,
               partition_by: list[str] | None = None) -> str:
    """Overwrite a named result table.

    ``partition_by`` lays the table out by a low-cardinality column (for
    example the month of the monthly counts) so readers prune folders.
    """
    path = table_path(root, name)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def load_table(spark: SparkSession, root: str, name: str,
               schema: T.StructType | None = None, view: str | None = None) -> DataFrame:
    """Read a named table with an explicit schema, optionally as a view."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(table_path(root, name))
    if view:
        df.createOrReplaceTempView(view)
    return df


def dedupe_by_key(df: DataFrame, key: str = "mid", order_cols=None) -> DataFrame:
    """Keep one row per key: with ``order_cols`` the last row by that order,
    else any row (a hash aggregate, map-side combined)."""
    if order_cols:
        w = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in order_cols])
        return (df.withColumn("_rn", F.row_number().over(w))
                .filter("_rn = 1").drop("_rn"))
    return df.dropDuplicates([key])


def save_documents(df: DataFrame, root: str, name: str = "documents",
                   key: str = "mid", order_cols=None) -> str:
    """Replace a search-document set whose document id is ``key``.

    Writing the same id twice keeps one document (the later one by
    ``order_cols`` when given), and the whole set is replaced.
    """
    return save_table(dedupe_by_key(df, key, order_cols), root, name)
