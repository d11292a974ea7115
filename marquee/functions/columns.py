"""Scalar column functions.

Every function returns a Column (or a DataFrame built only from column
expressions), so all of them stay inside whole-stage code generation; none
is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.schemas import RECS


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- P1 / P12: the rating log line -------------------------------------------------

def extract_rating_log(df: DataFrame, marker: str, value: str = "value") -> DataFrame:
    """Keep lines containing ``marker``; the new value is the text
    between the first marker and the next one (or the end), trimmed.
    Lines that end at the marker give an empty message and are dropped."""
    v = _c(value)
    msg = F.trim(F.split_part(v, F.lit(marker), F.lit(2)))
    return (df.filter(v.contains(marker))
            .withColumn(value, msg)
            .filter(F.length(F.col(value)) > 0))


def format_rating_log(uid, mid, score, ts, marker: str) -> Column:
    """``marker`` + ``uid|mid|score|ts`` (ts in epoch seconds)."""
    return F.concat(F.lit(marker), F.concat_ws("|", _c(uid).cast("string"), _c(mid).cast("string"),
                                               _c(score).cast("string"), _c(ts).cast("string")))


# --- P2: message parsing ----------------------------------------------------------

def parse_rating_message(df: DataFrame, value: str = "value", keep_bad: bool = False) -> DataFrame:
    """Parse ``uid|mid|score|timestamp``.

    Fields are cast with ``try_cast``; rows with a missing or malformed
    field get ``bad = true``.  ``keep_bad=False`` drops them (the side
    output is ``df.filter('bad')`` with ``keep_bad=True``).
    """
    parts = F.split(_c(value), r"\|")
    fields = [F.trim(F.try_element_at(parts, F.lit(i))) for i in range(1, 5)]
    out = df.select(
        "*",
        fields[0].try_cast("int").alias("uid"),
        fields[1].try_cast("int").alias("mid"),
        fields[2].try_cast("double").alias("score"),
        fields[3].try_cast("bigint").alias("ts"),
        (F.size(parts) != 4).alias("_arity_bad"))
    bad = (F.col("_arity_bad") | F.col("uid").isNull() | F.col("mid").isNull()
           | F.col("score").isNull() | F.col("ts").isNull())
    out = out.withColumn("bad", bad).drop("_arity_bad")
    return out if keep_bad else out.filter(~F.col("bad")).drop("bad")


# --- P3: month bucket ----------------------------------------------------------------

def month_bucket(ts) -> Column:
    """Epoch seconds -> yyyyMM as a long, in the session zone (UTC)."""
    return F.date_format(F.timestamp_seconds(_c(ts)), "yyyyMM").cast("bigint")


# --- P4: genres -------------------------------------------------------------------------

def explode_genres(movies: DataFrame, genres: str = "genres") -> DataFrame:
    """One row per (mid, genre); null genres give no row."""
    return movies.select("mid", F.explode(F.split(F.col(genres), r"\|")).alias("genre"))


# --- P5 / P6: math ------------------------------------------------------------------------

def log2(col) -> Column:
    """P5: base-2 logarithm."""
    return F.log2(_c(col))


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def norm2(a) -> Column:
    return F.sqrt(F.aggregate(F.transform(_c(a), lambda x: x * x), F.lit(0.0), lambda acc, v: acc + v))


def cosine(a, b) -> Column:
    """Cosine similarity; a zero vector gives NULL instead of NaN."""
    return F.try_divide(dot(a, b), norm2(a) * norm2(b))


# --- P7: recent-queue dumps ---------------------------------------------------------------

def load_recent_queue(df: DataFrame, entries: str = "entries", sep: str = ":") -> DataFrame:
    """A dumped queue (uid, entries ARRAY<STRING>) -> rows
    (uid, pos, mid, score); position 0 is the newest entry.  Entries that do
    not parse are dropped."""
    e = df.select("uid", F.posexplode(entries).alias("pos", "entry"))
    parts = F.split(F.col("entry"), "\\" + sep if sep in "|.^$*+?()[]{}\\" else sep)
    return (e.select("uid", F.col("pos").cast("int").alias("pos"),
                     F.trim(F.try_element_at(parts, F.lit(1))).try_cast("int").alias("mid"),
                     F.trim(F.try_element_at(parts, F.lit(2))).try_cast("double").alias("score"))
            .filter(F.col("mid").isNotNull() & F.col("score").isNotNull()))


# --- P8 / P9: rec lists ---------------------------------------------------------------------

def sort_recs(recs) -> Column:
    """Order a rec list by score desc, then mid asc (R11); scores equal to
    9 decimals are ties."""
    def key(x):
        return F.round(x["score"], 9)
    return F.array_sort(_c(recs), lambda l, r: F.when(key(l) > key(r), -1)
                        .when(key(l) < key(r), 1)
                        .when(l["mid"] < r["mid"], -1)
                        .when(l["mid"] > r["mid"], 1).otherwise(0))


def encode_recs(recs) -> Column:
    """``mid:score|mid:score`` text form of a rec list."""
    return F.array_join(F.transform(_c(recs), lambda r: F.concat_ws(":", r["mid"].cast("string"),
                                                                     r["score"].cast("string"))), "|")


def decode_recs(text) -> Column:
    """Inverse of P8: text -> ARRAY<STRUCT<mid, score>>; '' -> empty list."""
    items = F.filter(F.split(_c(text), r"\|"), lambda s: F.length(s) > 0)
    return F.transform(items, lambda s: F.struct(
        F.split(s, ":").getItem(0).cast("int").alias("mid"),
        F.split(s, ":").getItem(1).cast("double").alias("score"))).cast(RECS)


def top_recs(recs, n: int) -> Column:
    """The best ``n`` recs of a list; a missing list gives an empty one."""
    safe = F.coalesce(_c(recs), F.array().cast(RECS))
    return F.slice(sort_recs(safe), 1, n)


# --- P10 / P11: users --------------------------------------------------------------------------

def uid_from_username(name) -> Column:
    """P10: the 32-bit string hash ``h = 31*h + c`` (wrapping), per UTF-16
    code unit, as used to derive a user id from the user name."""
    units = F.regexp_extract_all(F.hex(F.encode(_c(name), "UTF-16BE")), F.lit("[0-9A-F]{4}"), F.lit(0))
    codes = F.transform(units, lambda u: F.conv(u, 16, 10).cast("bigint"))
    h = F.aggregate(codes, F.lit(0).cast("bigint"),
                    lambda acc, c: F.pmod(acc * 31 + c, F.lit(4294967296)))
    return F.when(h >= F.lit(2147483648), h - F.lit(4294967296)).otherwise(h).cast("int")


def parse_prefs(text) -> Column:
    """Preference genres given as ``a,b,c``."""
    return F.split(_c(text), ",")


def pref_key(genre) -> Column:
    """The genre label used for the fallback lookup: text before the
    first space."""
    return F.split_part(_c(genre), F.lit(" "), F.lit(1))
