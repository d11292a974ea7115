"""Delimited-text readers for the three source files.

All three use the CSV data source with an explicit schema, so reads are
split across executors, columns are pruned and no inference pass runs.
Bad lines are handled by ``mode``:

* ``"strict"``     -- fail the job on the first malformed line (FAILFAST);
* ``"quarantine"`` -- keep good rows, return malformed lines separately.  The
  text is parsed once: one job writes good and bad lines to two folders of
  one scratch table, and each result reads its own folder only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.schemas import MOVIES, RATINGS, TAGS
from marquee.session import scratch_path

_CORRUPT = "_corrupt_record"


def _reader(spark: SparkSession, sep: str, quote: str | None):
    reader = (spark.read.option("sep", sep).option("header", "false")
              .option("ignoreLeadingWhiteSpace", "false")
              .option("ignoreTrailingWhiteSpace", "false"))
    return reader if quote is None else reader.option("quote", quote)


def _read_strict(spark: SparkSession, path: str, schema: T.StructType, sep: str, quote: str | None = None) -> DataFrame:
    return _reader(spark, sep, quote).schema(schema).option("mode", "FAILFAST").csv(path)


def _read_split(spark: SparkSession, path: str, schema: T.StructType, sep: str, quote: str | None = None,
                refused: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad lines); ``refused`` marks parsed rows that are bad all
    the same, whose line is put together again from the fields."""
    wide = T.StructType(schema.fields + [T.StructField(_CORRUPT, T.StringType())])
    raw = (_reader(spark, sep, quote).schema(wide).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", _CORRUPT).csv(path))
    whole = F.concat_ws(sep, *[F.coalesce(F.col(f.name).cast("string"), F.lit("")) for f in schema.fields])
    bad = F.col(_CORRUPT).isNotNull() | (F.coalesce(refused, F.lit(True)) if refused is not None else F.lit(False))
    rows = raw.select(*schema.fieldNames(), F.when(bad, F.coalesce(F.col(_CORRUPT), whole)).alias("line"), bad.cast("int").alias("bad"))
    out = scratch_path(spark, "quarantine")
    rows.write.partitionBy("bad").parquet(out)
    back = spark.read.schema(rows.schema).parquet(out)
    return back.filter("bad = 0").select(*schema.fieldNames()), back.filter("bad = 1").select("line")


def _read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str, mode: str, quote: str | None = None,
                    refused: Column | None = None):
    if mode == "strict":
        return _read_strict(spark, path, schema, sep, quote), None
    if mode == "quarantine":
        return _read_split(spark, path, schema, sep, quote, refused)
    raise ValueError(f"unknown mode {mode!r}")


def read_movies(spark: SparkSession, path: str, mode: str = "strict"):
    """``^``-separated catalogue, ten fields, every field trimmed.

    Text fields are read as strings and trimmed; ``mid`` is trimmed before
    its integer cast, as the loader does; in quarantine mode a line whose id
    is not an integer joins the malformed lines.  Returns ``(movies,
    bad_lines)``; ``bad_lines`` is ``None`` in strict mode.
    """
    text_schema = T.StructType([T.StructField(f.name, T.StringType()) for f in MOVIES.fields])
    no_id = F.expr("try_cast(trim(mid) as int) is null")
    df, bad = _read_delimited(spark, path, text_schema, "^", mode, "", no_id)
    return df.select(F.trim(F.col("mid")).cast("int").alias("mid"), *[F.trim(F.col(f.name)).alias(f.name) for f in MOVIES.fields[1:]]), bad


def read_ratings(spark: SparkSession, path: str, mode: str = "strict"):
    """``uid,mid,score,timestamp`` comma-separated, epoch seconds."""
    return _read_delimited(spark, path, RATINGS, ",", mode)


def read_tags(spark: SparkSession, path: str, mode: str = "strict"):
    """S3: ``uid,mid,tag,timestamp`` comma-separated."""
    return _read_delimited(spark, path, TAGS, ",", mode)


def normalise_seconds(col):
    """Time values above 1e11 are milliseconds; bring them to seconds."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c > F.lit(100_000_000_000), F.floor(c / 1000)).otherwise(c).cast("bigint")
