"""Set-based table maintenance.

Each function turns a batch of single-row writes of the reference into one
join over the whole table; the caller writes the result to a new version
folder (Spark cannot overwrite a path it is reading).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators import tag_text


def delete_keys(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """K1: drop every row whose key is in ``keys``."""
    return df.join(keys.select(*on).distinct(), on, "left_anti")


def apply_preferences(users: DataFrame, updates: DataFrame) -> DataFrame:
    """K2: append new preference genres (uid, genres ARRAY) to each user's
    list and clear the ``first`` flag of updated users.  Several updates of
    one user are appended in (ts, order) order."""
    u = updates
    if "ts" in u.columns:
        w_order = F.struct("ts", *([c for c in ("seq",) if c in u.columns]))
        agg = u.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct(w_order.alias("o"), "genres"))).alias("l"))
        add = agg.select("uid", F.flatten(F.transform("l", lambda x: x["genres"])).alias("new"))
    else:
        add = u.groupBy("uid").agg(F.flatten(F.collect_list("genres")).alias("new"))
    j = users.join(add, "uid", "left")
    return j.select(
        "uid", "username",
        F.when(F.col("new").isNotNull(), F.lit(False)).otherwise(F.col("first")).alias("first"),
        "ts",
        F.when(F.col("new").isNotNull(), F.concat(F.coalesce("prefGenres", F.array().cast("array<string>")), "new"))
        .otherwise(F.col("prefGenres")).alias("prefGenres"))


def upsert_ratings(base: DataFrame, updates: DataFrame) -> DataFrame:
    """Apply rating events (uid, mid, score, ts, event_id) to the
    ratings table.  A pair not yet rated is inserted with its first event's
    time; a re-rating overwrites the score of every stored row of the pair
    and keeps the stored time (R13).  The last event by (ts, event_id)
    gives the new score."""
    first = F.min(F.struct("ts", "event_id"))
    last = F.max(F.struct("ts", "event_id", "score"))
    upd = (updates.groupBy("uid", "mid").agg(first.alias("f"), last.alias("l"))
           .select("uid", "mid", F.col("f.ts").alias("new_ts"), F.col("l.score").alias("new_score")))
    j = base.select("uid", "mid", "score", "ts").join(upd, ["uid", "mid"], "full_outer")
    return j.select("uid", "mid",
                    F.when(F.col("new_score").isNotNull(), F.col("new_score"))
                    .otherwise(F.col("score")).alias("score"),
                    F.coalesce("ts", "new_ts").alias("ts"))


def extend_tags(docs: DataFrame, updates: DataFrame) -> DataFrame:
    """Extend each document's ``tags`` text with ``|tag`` per new tag of
    ``updates`` (uid, mid, tag, ts, event_id), in (ts, event_id) order,
    without dedupe; documents without updates are returned unchanged."""
    add = tag_text.joined(tag_text.tag_chunks(updates))
    return docs.join(add, "mid", "left").withColumn("tags", tag_text.extended(F.col("tags"), F.col("add"))).drop("add")


def apply_new_tags(tags: DataFrame, docs: DataFrame, updates: DataFrame):
    """Append tag rows and extend each tagged document's ``tags`` text
    with ``|tag`` per new tag, in (ts, event_id) order, without dedupe.
    Returns (new_tags, new_docs)."""
    new_tags = tags.unionByName(updates.select(*tags.columns))
    return new_tags, extend_tags(docs, updates)
