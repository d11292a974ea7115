"""Explicit schemas for every table the engine reads or writes."""

from pyspark.sql import types as T

# The names, order and types of the columns of the data model
# that files and tables are exchanged in.

MOVIE_TEXT_FIELDS = ("name", "descri", "timelong", "issue", "shoot",
                     "language", "genres", "actors", "directors")

MOVIES = T.StructType(
    [T.StructField("mid", T.IntegerType())]
    + [T.StructField(f, T.StringType()) for f in MOVIE_TEXT_FIELDS])

RATINGS = T.StructType([
    T.StructField("uid", T.IntegerType()),
    T.StructField("mid", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("ts", T.LongType()),
])

TAGS = T.StructType([
    T.StructField("uid", T.IntegerType()),
    T.StructField("mid", T.IntegerType()),
    T.StructField("tag", T.StringType()),
    T.StructField("ts", T.LongType()),
])

USERS = T.StructType([
    T.StructField("uid", T.IntegerType()),
    T.StructField("username", T.StringType()),
    T.StructField("first", T.BooleanType()),
    T.StructField("ts", T.LongType()),
    T.StructField("prefGenres", T.ArrayType(T.StringType())),
])

REC = T.StructType([
    T.StructField("mid", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
])
RECS = T.ArrayType(REC)

RATING_EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("uid", T.IntegerType()),
    T.StructField("mid", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("ts", T.LongType()),
])

# Columns of a search document, in the fixed order of the load job.
DOCUMENT_COLUMNS = ("mid",) + MOVIE_TEXT_FIELDS + ("tags",)
