"""Registered batch queries: statistics, loading, serving joins, upkeep."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.operators import statistics as st
from marquee.plans.registry import register
from marquee.plans.sqlviews import with_views
from marquee.sources import standin as si


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# ---------------------------------------------------------------- statistics

@register("a1_rate_more_movies", with_views("ratings") + """
SELECT mid, count(score) AS "count" FROM ratings GROUP BY mid""")
def a1_rate_more_movies(spark, sf):
    return st.rate_more_movies(si.ratings(spark, sf))


@register("a2_rate_more_movies_recently", with_views("ratings") + """
SELECT mid, CAST(strftime(make_timestamp(ts * 1000000), '%Y%m') AS BIGINT) AS month,
       count(score) AS "count"
FROM ratings GROUP BY ALL""")
def a2_rate_more_movies_recently(spark, sf):
    return st.rate_more_movies_recently(si.ratings(spark, sf))


@register("a3_average_movies_score", with_views("averages") + """
SELECT mid, round(avg, 6) AS avg FROM averages""")
def a3_average_movies_score(spark, sf):
    return st.average_movies_score(si.ratings(spark, sf)).withColumn("avg", r6("avg"))


@register("a5_genres_top_movies", with_views("ranked_genres") + """
SELECT genre, rank, mid, round(avg, 6) AS avg FROM ranked_genres""")
def a5_genres_top_movies(spark, sf):
    avgs = st.average_movies_score(si.ratings(spark, sf))
    return st.ranked_genres(si.movies(spark, sf), avgs, 10).withColumn("avg", r6("avg"))


def _pivot_sql(n=10):
    cols = ",\n       ".join(
        f"max(CASE WHEN rank = {i} THEN mid END) AS mid_{i}, "
        f"round(max(CASE WHEN rank = {i} THEN avg END), 6) AS avg_{i}" for i in range(1, n + 1))
    return with_views("ranked_genres") + f"SELECT genre,\n       {cols}\nFROM ranked_genres GROUP BY genre"


@register("a9_pivot_top_genres", _pivot_sql())
def a9_pivot_top_genres(spark, sf):
    avgs = st.average_movies_score(si.ratings(spark, sf))
    p = st.pivot_top_genres(st.ranked_genres(si.movies(spark, sf), avgs, 10), 10)
    return p.select(*[r6(c).alias(c) if c.startswith("avg_") else F.col(c) for c in p.columns])


@register("a10_rating_histogram", with_views("ratings") + """
SELECT uid, CAST(floor(score / 0.5 + 0.5) AS INTEGER) AS bin, count(*) AS "count"
FROM ratings WHERE score IS NOT NULL GROUP BY ALL""")
def a10_rating_histogram(spark, sf):
    return st.rating_histogram(si.ratings(spark, sf))


@register("l2_top_rated_count", with_views("ratings") + """
SELECT CAST(row_number() OVER (ORDER BY "count" DESC, mid) AS INTEGER) AS rank, mid, "count"
FROM (SELECT mid, count(score) AS "count" FROM ratings GROUP BY mid)
ORDER BY "count" DESC, mid LIMIT 10""")
def l2_top_rated_count(spark, sf):
    return st.top_rated_count(st.rate_more_movies(si.ratings(spark, sf)), 10)


@register("l3_hot_movies", with_views("ratings") + """
SELECT CAST(row_number() OVER (ORDER BY month DESC, "count" DESC, mid) AS INTEGER) AS rank,
       mid, month, "count"
FROM (SELECT mid, CAST(strftime(make_timestamp(ts * 1000000), '%Y%m') AS BIGINT) AS month,
             count(score) AS "count" FROM ratings GROUP BY ALL)
ORDER BY month DESC, "count" DESC, mid LIMIT 10""")
def l3_hot_movies(spark, sf):
    return st.hot_movies(st.rate_more_movies_recently(si.ratings(spark, sf)), 10)


@register("l4_new_movies", with_views("movies") + """
SELECT CAST(row_number() OVER (ORDER BY issue_date DESC, mid) AS INTEGER) AS rank, mid, issue
FROM movies ORDER BY issue_date DESC, mid LIMIT 10""")
def l4_new_movies(spark, sf):
    return st.new_movies(si.movies(spark, sf), 10)


@register("l8_top_genre", with_views("ranked_genres", "users") + """
SELECT r.genre, g.rank, g.mid, round(g.avg, 6) AS score
FROM (SELECT DISTINCT split_part(unnest(prefGenres), ' ', 1) AS genre FROM users) r
JOIN ranked_genres g ON g.genre = r.genre WHERE g.rank <= 5""")
def l8_top_genre(spark, sf):
    from marquee.functions.columns import pref_key
    avgs = st.average_movies_score(si.ratings(spark, sf))
    top = st.genres_top_movies(si.movies(spark, sf), avgs, 10)
    req = (si.users(spark, sf).select(F.explode("prefGenres").alias("g"))
           .select(pref_key("g").alias("genre")).distinct())
    out = st.genre_lookup(top, req, 5)
    return (out.select("genre", F.posexplode("recs").alias("pos", "r"))
            .select("genre", (F.col("pos") + 1).cast("int").alias("rank"),
                    F.col("r.mid").alias("mid"), r6("r.score").alias("score")))


# ------------------------------------------------------- load and documents

@register("a4_aggregate_tags", with_views("tags") + """
SELECT mid, nullif(string_agg(DISTINCT tag, '|' ORDER BY tag), '') AS tags FROM tags GROUP BY mid""")
def a4_aggregate_tags(spark, sf):
    from marquee.operators.documents import aggregate_tags
    return aggregate_tags(si.tags(spark, sf))


@register("j1_movie_documents", with_views("movies", "tags") + """
SELECT m.mid, m.name, m.descri, m.timelong, m.issue, m.shoot, m.language, m.genres, m.actors,
       m.directors, t.tags
FROM movies m LEFT JOIN (SELECT mid, nullif(string_agg(DISTINCT tag, '|' ORDER BY tag), '') AS tags
                         FROM tags GROUP BY mid) t ON m.mid = t.mid""")
def j1_movie_documents(spark, sf):
    from marquee.operators.documents import movie_documents
    return movie_documents(si.movies(spark, sf), si.tags(spark, sf))


# ------------------------------------------------------------ serving joins

@register("j8_movie_enrichment", with_views("movies", "averages") + """
SELECT m.mid, m.name, m.genres, m.issue, round(coalesce(a.avg, 0.0), 6) AS score
FROM movies m LEFT JOIN averages a ON m.mid = a.mid""")
def j8_movie_enrichment(spark, sf):
    from marquee.operators.serving import enrich
    m = si.movies(spark, sf).select("mid", "name", "genres", "issue")
    return enrich(m, st.average_movies_score(si.ratings(spark, sf))).withColumn("score", r6("score"))


@register("j9_my_rated_movies", with_views("movies", "averages", "rating_events") + """
SELECT x.uid, x.mid, m.name, round(coalesce(x.score, a.avg, 0.0), 6) AS score
FROM (SELECT uid, mid, score FROM ratings
      WHERE uid IN (SELECT uid FROM rating_events)
      QUALIFY row_number() OVER (PARTITION BY uid, mid ORDER BY ts DESC, score DESC) = 1) x
JOIN movies m ON m.mid = x.mid LEFT JOIN averages a ON a.mid = x.mid""")
def j9_my_rated_movies(spark, sf):
    from marquee.operators.serving import my_rated_movies
    r = si.ratings(spark, sf)
    out = my_rated_movies(r, si.movies(spark, sf), st.average_movies_score(r),
                          si.rating_events(spark, sf).select("uid"))
    return out.withColumn("score", r6("score"))


@register("p14_lookup_ratings", with_views("ratings", "rating_events") + """
SELECT e.event_id, e.uid, e.mid,
       EXISTS (SELECT 1 FROM ratings r WHERE r.uid = e.uid AND r.mid = e.mid) AS "exists"
FROM rating_events e""")
def p14_lookup_ratings(spark, sf):
    from marquee.operators.serving import rating_exists
    ev = si.rating_events(spark, sf).select("event_id", "uid", "mid")
    return rating_exists(si.ratings(spark, sf), ev)


@register("p15_lookup_tags", with_views("tags", "rating_events") + """
SELECT t.uid, t.mid, t.tag, t.ts FROM tags t
WHERE EXISTS (SELECT 1 FROM rating_events e WHERE e.uid = t.uid AND e.mid = t.mid)""")
def p15_lookup_tags(spark, sf):
    from marquee.operators.serving import lookup_tags
    return lookup_tags(si.tags(spark, sf), si.rating_events(spark, sf).select("uid", "mid"))


@register("k3_lookup_users", with_views("users") + """
SELECT u.uid, u.username, u.first FROM users u
WHERE u.username IN (SELECT 'Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') FROM events)""")
def k3_lookup_users(spark, sf):
    from marquee.operators.serving import lookup_users
    req = si.table(spark, sf, "events").select(
        F.concat(F.lit("Customer#"), F.lpad(F.col("user_id").cast("string"), 9, "0")).alias("username"))
    return lookup_users(si.users(spark, sf), req).select("uid", "username", "first")


@register("p10_uid_from_username", """
SELECT CAST(c_custkey AS INTEGER) AS uid, c_name AS username,
       CAST(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END AS INTEGER) AS name_hash
FROM (SELECT c_custkey, c_name,
             list_reduce(list_transform(string_split(c_name, ''), lambda ch: CAST(unicode(ch) AS BIGINT)),
                         lambda acc, ch: (acc * 31 + ch) % 4294967296, CAST(0 AS BIGINT)) AS h
      FROM customer)""")
def p10_uid_from_username(spark, sf):
    from marquee.functions.columns import uid_from_username
    return si.users(spark, sf).select("uid", "username", uid_from_username("username").alias("name_hash"))


# ------------------------------------------------------------------ upkeep

@register("k1_delete_keys", with_views("ratings", "rating_events") + """
SELECT * FROM ratings r
WHERE NOT EXISTS (SELECT 1 FROM rating_events e WHERE e.uid = r.uid AND e.mid = r.mid)""")
def k1_delete_keys(spark, sf):
    from marquee.operators.maintenance import delete_keys
    return delete_keys(si.ratings(spark, sf), si.rating_events(spark, sf), ["uid", "mid"])


def _pref_updates(spark, sf):
    e = si.table(spark, sf, "events").filter(F.col("event_type") == "signup")
    genres = F.array(*[F.lit(g) for g in si.PREF_GENRES])
    k = F.get_json_object("props", "$.k").cast("int")
    return e.select(F.col("user_id").cast("int").alias("uid"),
                    F.array(F.element_at(genres, (F.pmod(k, F.lit(6)) + 1).cast("int"))).alias("genres"),
                    F.unix_seconds(F.col("ts").cast("timestamp")).alias("ts"), F.col("event_id").alias("seq"))


@register("k2_apply_preferences", with_views("users") + """
, upd AS (
  SELECT CAST(user_id AS INTEGER) AS uid, event_id AS seq, CAST(floor(epoch(ts)) AS BIGINT) AS ts,
         (['ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD'])[CAST(json_extract_string(props, '$.k') AS INTEGER) % 6 + 1] AS g
  FROM events WHERE event_type = 'signup'),
add AS (SELECT uid, list(g ORDER BY ts, seq) AS new FROM upd GROUP BY uid)
SELECT u.uid, u.username, CASE WHEN a.new IS NULL THEN u.first ELSE FALSE END AS first,
       array_to_string(CASE WHEN a.new IS NULL THEN u.prefGenres ELSE list_concat(u.prefGenres, a.new) END, ',') AS prefs
FROM users u LEFT JOIN add a ON u.uid = a.uid""")
def k2_apply_preferences(spark, sf):
    from marquee.operators.maintenance import apply_preferences
    out = apply_preferences(si.users(spark, sf), _pref_updates(spark, sf))
    return out.select("uid", "username", "first", F.array_join("prefGenres", ",").alias("prefs"))


@register("t7_upsert_ratings", with_views("ratings", "rating_events") + """
, upd AS (
  SELECT uid, mid,
         min(ts) AS new_ts,
         arg_max(score, ts * 1000000000 + event_id) AS new_score
  FROM rating_events GROUP BY uid, mid)
SELECT coalesce(r.uid, u.uid) AS uid, coalesce(r.mid, u.mid) AS mid,
       CASE WHEN u.new_score IS NOT NULL THEN u.new_score ELSE r.score END AS score,
       coalesce(r.ts, u.new_ts) AS ts
FROM ratings r FULL OUTER JOIN upd u ON r.uid = u.uid AND r.mid = u.mid""")
def t7_upsert_ratings(spark, sf):
    from marquee.operators.maintenance import upsert_ratings
    return upsert_ratings(si.ratings(spark, sf), si.rating_events(spark, sf))


# Fixed value: tags on or after this time arrive as the tag feed of T8.
TAG_FEED_START = 1705708800   # 2024-01-20 00:00:00 UTC


@register("t8_apply_new_tags", with_views("tags") + f"""
, base AS (SELECT mid, nullif(string_agg(DISTINCT tag, '|' ORDER BY tag), '') AS tags
           FROM tags WHERE ts < {TAG_FEED_START} GROUP BY mid),
add AS (SELECT mid, string_agg(tag, '|' ORDER BY ts, event_id, tag) AS add
        FROM tags WHERE ts >= {TAG_FEED_START} GROUP BY mid)
SELECT coalesce(b.mid, a.mid) AS mid,
       CASE WHEN a.add IS NULL THEN b.tags WHEN b.tags IS NULL THEN a.add ELSE b.tags || '|' || a.add END AS tags
FROM base b FULL OUTER JOIN add a ON a.mid = b.mid""")
def t8_apply_new_tags(spark, sf):
    from marquee.operators.documents import aggregate_tags
    from marquee.operators.maintenance import apply_new_tags
    te = si.tag_events(spark, sf)
    old = te.filter(F.col("ts") < TAG_FEED_START)
    new = te.filter(F.col("ts") >= TAG_FEED_START)
    docs = aggregate_tags(old.select("uid", "mid", "tag", "ts"))
    # movies first tagged by the feed get a document row too
    docs = docs.unionByName(new.select("mid").distinct().join(docs, "mid", "left_anti")
                            .withColumn("tags", F.lit(None).cast("string")))
    _, new_docs = apply_new_tags(old, docs, new)
    return new_docs


# ------------------------------------------------------ log lines, messages

@register("p2_parse_rating_message", with_views("rating_events") + """
SELECT event_id AS "offset", uid, mid, score, ts FROM rating_events""")
def p2_parse_rating_message(spark, sf):
    from marquee.functions.columns import extract_rating_log, parse_rating_message
    lines = extract_rating_log(si.log_lines(spark, sf), si.RATING_MARKER)
    return parse_rating_message(lines).select("offset", "uid", "mid", "score", "ts")


@register("p7_load_recent_queue", with_views("rating_events") + """
SELECT uid, CAST(pos AS INTEGER) AS pos, mid, score FROM (
  SELECT uid, mid, score, row_number() OVER (PARTITION BY uid ORDER BY ts DESC, event_id DESC) - 1 AS pos
  FROM rating_events) WHERE pos < 40""")
def p7_load_recent_queue(spark, sf):
    """W2 queue (cap 40) dumped as 'mid:score' text lists and loaded back."""
    from marquee.functions.columns import load_recent_queue
    from marquee.operators.scoring import recent_queue
    q = recent_queue(si.rating_events(spark, sf), 40)
    dump = q.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("pos", F.concat_ws(
        ":", F.col("mid").cast("string"), F.col("score").cast("string")).alias("e")))).alias("l"))
    dump = dump.select("uid", F.transform("l", lambda x: x["e"]).alias("entries"))
    return load_recent_queue(dump, "entries", ":")


@register("p9_top_recs", with_views("ranked_genres") + """
SELECT genre, rank, mid, round(avg, 6) AS score FROM ranked_genres WHERE rank <= 3""")
def p9_top_recs(spark, sf):
    """Genre lists encoded as text (P8), decoded and cut to the best 3."""
    from marquee.functions.columns import decode_recs, encode_recs, top_recs
    avgs = st.average_movies_score(si.ratings(spark, sf))
    top = st.genres_top_movies(si.movies(spark, sf), avgs, 10)
    enc = top.select("genre", encode_recs("recs").alias("text"))
    dec = enc.select("genre", top_recs(decode_recs("text"), 3).alias("recs"))
    return (dec.select("genre", F.posexplode("recs").alias("pos", "r"))
            .select("genre", (F.col("pos") + 1).cast("int").alias("rank"),
                    F.col("r.mid").alias("mid"), r6("r.score").alias("score")))


@register("p12_format_rating_log", with_views("rating_events") + """
SELECT event_id, 'movie_rating:' || CAST(uid AS VARCHAR) || '|' || CAST(mid AS VARCHAR) || '|'
       || CAST(score AS VARCHAR) || '|' || CAST(ts AS VARCHAR) AS line
FROM rating_events""")
def p12_format_rating_log(spark, sf):
    from marquee.functions.columns import format_rating_log
    ev = si.rating_events(spark, sf)
    return ev.select("event_id", format_rating_log("uid", "mid", "score", "ts", si.RATING_MARKER).alias("line"))


@register("k3_exists_keys", with_views("movies", "tags") + """
SELECT r.mid, EXISTS (SELECT 1 FROM movies m WHERE m.mid = r.mid) AS "exists"
FROM (SELECT DISTINCT mid FROM tags) r""")
def k3_exists_keys(spark, sf):
    from marquee.operators.serving import exists_keys
    req = si.tags(spark, sf).select("mid").distinct()
    return exists_keys(si.movies(spark, sf), req, "mid")
