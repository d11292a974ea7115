"""Registered queries: content search (X1-X4) and the blend."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from marquee.operators import search as se
from marquee.operators.text_index import built_index
from marquee.plans.registry import register
from marquee.plans.sqlviews import with_views
from marquee.sources import standin as si

MOVIE_FIELDS = ("name", "descri", "genres", "actors", "directors", "tags")
SEARCH_FIELDS = ("name", "descri")


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# ------------------------------------------------------------- SQL helpers

TOK = r"list_filter(regexp_split_to_array(lower({c}), '[^\p{{L}}\p{{N}}]+'), lambda t: length(t) > 0)"


def _index_sql(docs_cte: str, fields: tuple[str, ...]) -> str:
    """CTEs postings/dl/tdf/fs/w over ``docs(doc, <fields>)``."""
    toks = " UNION ALL ".join(
        f"SELECT '{f}' AS field, doc, unnest({TOK.format(c=f)}) AS term FROM docs" for f in fields)
    return f""", docs AS ({docs_cte}),
toks AS ({toks}),
postings AS (SELECT field, term, doc, count(*) AS tf FROM toks GROUP BY ALL),
dl AS (SELECT field, doc, sum(tf) AS dl FROM postings GROUP BY ALL),
tdf AS (SELECT field, term, count(*) AS df FROM postings GROUP BY ALL),
fs AS (SELECT field, count(*) AS n_docs, avg(dl) AS avgdl FROM dl GROUP BY field),
w AS (SELECT p.field, p.term, p.doc,
             ln(1 + (fs.n_docs - t.df + 0.5) / (t.df + 0.5)) * p.tf
               / (p.tf + {se.K1}e0 * ({1 - se.B}e0 + {se.B}e0 * d.dl / fs.avgdl)) AS w
      FROM postings p JOIN dl d ON d.field = p.field AND d.doc = p.doc
      JOIN tdf t ON t.field = p.field AND t.term = p.term JOIN fs ON fs.field = p.field)"""


def _search_sql(queries_cte: str, fields: tuple[str, ...], n: int) -> str:
    flist = ", ".join(f"'{f}'" for f in fields)
    return f""", qs AS ({queries_cte}),
q AS (SELECT qid, term, count(*) AS qtf FROM (SELECT qid, unnest({TOK.format(c='text')}) AS term FROM qs) GROUP BY ALL),
pf AS (SELECT q.qid, w.field, w.doc, sum(q.qtf * w.w) AS s FROM q JOIN w ON w.term = q.term
       WHERE w.field IN ({flist}) GROUP BY ALL),
best AS (SELECT qid, doc, max(s) AS score FROM pf GROUP BY ALL)
SELECT qid, CAST(rank AS INTEGER) AS rank, doc, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, doc) AS rank FROM best)
WHERE rank <= {n}"""


def _mlt_sql(anchors_cte: str, n: int) -> str:
    """CTE mlt(anchor, rank, doc, score); needs the index CTEs."""
    return f""", anchors AS ({anchors_cte}),
topf AS (SELECT t.term, t.field AS top_field, t.df,
                ln(1 + (fs.n_docs - t.df + 0.5) / (t.df + 0.5)) AS idf
         FROM tdf t JOIN fs ON fs.field = t.field
         QUALIFY row_number() OVER (PARTITION BY t.term ORDER BY t.df DESC, t.field) = 1),
a AS (SELECT doc AS anchor, term, sum(tf) AS tf_all FROM postings
      WHERE doc IN (SELECT anchor FROM anchors) GROUP BY ALL),
sel AS (SELECT a.anchor, f.top_field AS field, a.term
        FROM a JOIN topf f ON f.term = a.term
        WHERE a.tf_all >= {se.MLT_MIN_TERM_FREQ} AND f.df >= {se.MLT_MIN_DOC_FREQ}
        QUALIFY row_number() OVER (PARTITION BY a.anchor ORDER BY round(a.tf_all * f.idf, 9) DESC, a.term)
                <= {se.MLT_MAX_QUERY_TERMS}),
hits AS (SELECT s.anchor, w.doc, sum(w.w) AS score FROM sel s
         JOIN w ON w.field = s.field AND w.term = s.term
         WHERE w.doc <> s.anchor GROUP BY ALL),
mlt AS (SELECT anchor, CAST(rank AS INTEGER) AS rank, doc, score FROM (
          SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY round(score, 9) DESC, doc) AS rank FROM hits)
        WHERE rank <= {n})"""


_MOVIE_DOCS_SQL = """SELECT m.mid AS doc, m.name, m.descri, m.genres, m.actors, m.directors, t.tags
FROM movies m LEFT JOIN (SELECT mid, nullif(string_agg(DISTINCT tag, '|' ORDER BY tag), '') AS tags
                         FROM tags GROUP BY mid) t ON m.mid = t.mid"""


def _movie_docs(spark, sf):
    from marquee.operators.documents import movie_documents
    return movie_documents(si.movies(spark, sf), si.tags(spark, sf))


# ------------------------------------------------------------------ queries

@register("x1_build_postings", "WITH " + _index_sql("SELECT doc_id AS doc, text FROM documents", ("text",))[2:]
          + """
SELECT field, term, doc, tf FROM postings""")
def x1_build_postings(spark, sf):
    ix = built_index(si.documents(spark, sf), "doc_id", ("text",))
    return ix.postings.select("field", "term", "doc", "tf")


@register("x2_search", "WITH " + _index_sql("SELECT doc_id AS doc, text FROM documents", ("text",))[2:]
          + _search_sql("SELECT item_id AS qid, text FROM benchmark", ("text",), 100))
def x2_search(spark, sf):
    """Every benchmark passage searched (whole text) over every document."""
    ix = built_index(si.documents(spark, sf), "doc_id", ("text",))
    return se.search(ix, si.benchmark_queries(spark, sf), ("text",), 100).withColumn("score", r6("score"))


@register("x2_movie_search", with_views("movies", "tags")
          + _index_sql(_MOVIE_DOCS_SQL, SEARCH_FIELDS)
          + _search_sql("SELECT DISTINCT name AS qid, name AS text FROM movies", SEARCH_FIELDS, 100))
def x2_movie_search(spark, sf):
    """Multi-field search over name and descri, best field wins; every
    distinct movie title is a query."""
    docs = _movie_docs(spark, sf).withColumnRenamed("mid", "doc")
    ix = built_index(docs, "doc", SEARCH_FIELDS)
    q = si.movies(spark, sf).select(F.col("name").alias("qid"), F.col("name").alias("text")).distinct()
    return se.search(ix, q, SEARCH_FIELDS, 100).withColumn("score", r6("score"))


@register("x3_more_like_this", with_views("movies", "tags")
          + _index_sql(_MOVIE_DOCS_SQL, MOVIE_FIELDS)
          + _mlt_sql("SELECT mid AS anchor FROM movies", 10) + """
SELECT anchor, rank, doc, round(score, 6) AS score FROM mlt""")
def x3_more_like_this(spark, sf):
    """More-like-this for every movie over all six text fields."""
    docs = _movie_docs(spark, sf).withColumnRenamed("mid", "doc")
    ix = built_index(docs, "doc", MOVIE_FIELDS)
    anchors = si.movies(spark, sf).select(F.col("mid").alias("anchor"))
    return se.more_like_this(ix, anchors, 10).withColumn("score", r6("score"))


def _fuzzy_queries_spark(spark, sf):
    vocab = (si.movies(spark, sf).select(F.explode(se.tokens("genres")).alias("t")).distinct())
    return (vocab.select(F.explode(F.array("t", F.expr("substr(t, 2)"), F.concat("t", F.lit("s"))))
                         .alias("text")).distinct().select(F.col("text").alias("qid"), "text"))


@register("x4_fuzzy_genre", with_views("movies") + f"""
, vocab_docs AS (SELECT DISTINCT mid AS doc, unnest({TOK.format(c='genres')}) AS token FROM movies),
vocab AS (SELECT DISTINCT token FROM vocab_docs),
qs AS (SELECT DISTINCT q AS qid, q FROM (SELECT unnest([token, substr(token, 2), token || 's']) AS q FROM vocab)),
m AS (SELECT qs.qid, qs.q, v.token, levenshtein(qs.q, v.token) AS dist FROM qs, vocab v
      WHERE levenshtein(qs.q, v.token) <= CASE WHEN length(qs.q) <= 2 THEN 0 WHEN length(qs.q) <= 5 THEN 1 ELSE 2 END),
scored AS (SELECT m.qid, d.doc, max(1.0 - m.dist / length(m.q)) AS score
           FROM m JOIN vocab_docs d ON d.token = m.token GROUP BY ALL)
SELECT qid, CAST(rank AS INTEGER) AS rank, doc, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, doc) AS rank FROM scored)
WHERE rank <= 100""")
def x4_fuzzy_genre(spark, sf):
    """Typo-tolerant genre search; the queries are every genre token, the
    token without its first letter and the token with an added letter."""
    return se.fuzzy_genre(si.movies(spark, sf), _fuzzy_queries_spark(spark, sf), 100) \
        .withColumn("score", r6("score"))


# -------------------------------------------------------------------- blend

def _hybrid_parts(spark, sf):
    from marquee.operators import scoring as sc
    from marquee.plans.queries_model import N_CAND, N_RECENT, TEST_THRESHOLD, _sims, rated
    ev = si.rating_events(spark, sf)
    w = Window.partitionBy("uid").orderBy(F.col("ts").desc(), F.col("event_id").desc())
    req = (ev.withColumn("_r", F.row_number().over(w)).filter("_r = 1")
           .select("uid", F.col("mid").alias("anchor_mid")))
    sims = _sims(spark, sf, reused=True, of=rated(spark, sf))
    similar = sims.select(F.col("mid").alias("anchor"), F.col("sim_mid").alias("mid"), F.col("sim").alias("score"))
    docs = _movie_docs(spark, sf).withColumnRenamed("mid", "doc")
    ix = built_index(docs, "doc", MOVIE_FIELDS)
    content = (se.more_like_this(ix, req.select(F.col("anchor_mid").alias("anchor")).distinct(), 10)
               .select("anchor", F.col("doc").alias("mid"), "score"))
    scores = sc.score_events(ev, si.ratings(spark, sf, ev), sims, N_RECENT, N_CAND, TEST_THRESHOLD)
    latest = sc.latest_recs(ev, scores)
    stream = (latest.select("uid", F.explode("recs").alias("r"))
              .select("uid", F.col("r.mid").alias("mid"), F.col("r.score").alias("score")))
    return req, similar, content, stream


def _hybrid_sql(extra_views=()):
    from marquee.plans.queries_model import SCORING_CTES, SCORING_VIEWS
    return (with_views(*SCORING_VIEWS, "movies", "tags", *extra_views) + ", " + SCORING_CTES
            + _index_sql(_MOVIE_DOCS_SQL, MOVIE_FIELDS)
            + """, req AS (SELECT uid, mid AS anchor_mid FROM rating_events
               QUALIFY row_number() OVER (PARTITION BY uid ORDER BY ts DESC, event_id DESC) = 1)"""
            + _mlt_sql("SELECT DISTINCT anchor_mid AS anchor FROM req", 10) + """,
last AS (SELECT uid, event_id FROM rating_events
         QUALIFY row_number() OVER (PARTITION BY uid ORDER BY ts DESC, event_id DESC) = 1),
stream AS (SELECT l.uid, s.mid, s.score FROM last l JOIN scores s ON s.event_id = l.event_id),
cap_sim AS (SELECT mid AS anchor, sim_mid AS mid, sim AS score FROM sims
            QUALIFY row_number() OVER (PARTITION BY mid ORDER BY round(sim, 9) DESC, sim_mid) <= 10),
cap_stream AS (SELECT * FROM stream QUALIFY row_number() OVER (PARTITION BY uid ORDER BY round(score, 9) DESC, mid) <= 10),
parts AS (
  SELECT r.uid, s.mid, s.score * 0.3 AS score FROM req r JOIN cap_sim s ON s.anchor = r.anchor_mid
  UNION ALL SELECT r.uid, c.doc AS mid, c.score * 0.3 AS score FROM req r JOIN mlt c ON c.anchor = r.anchor_mid
  UNION ALL SELECT r.uid, t.mid, t.score * 0.4 AS score FROM req r JOIN cap_stream t ON t.uid = r.uid),
hybrid AS (SELECT uid, CAST(rank AS INTEGER) AS rank, mid, score FROM (
  SELECT *, row_number() OVER (PARTITION BY uid ORDER BY round(score, 9) DESC, mid) AS rank FROM parts) WHERE rank <= 10)
""")


def _hybrid(spark, sf):
    from marquee.operators.blend import hybrid
    req, similar, content, stream = _hybrid_parts(spark, sf)
    return hybrid(similar, content, stream, req, 10)


@register("u1_hybrid", _hybrid_sql() + "SELECT uid, rank, mid, round(score, 6) AS score FROM hybrid")
def u1_hybrid(spark, sf):
    """Blend for every user with a rating event, anchored on the user's
    latest rated movie (R7)."""
    return _hybrid(spark, sf).withColumn("score", r6("score"))


@register("u2_with_fallback", _hybrid_sql(("ranked_genres", "users")) + """, fb AS (
  SELECT u.uid, g.rank, g.mid, g.avg AS score, 'genre' AS source
  FROM users u JOIN ranked_genres g
    ON g.genre = split_part(u.prefGenres[CAST(u.uid % len(u.prefGenres) AS INTEGER) + 1], ' ', 1)
  WHERE u.uid NOT IN (SELECT uid FROM hybrid) AND len(u.prefGenres) > 0)
SELECT uid, rank, mid, round(score, 6) AS score, 'recs' AS source FROM hybrid
UNION ALL SELECT uid, rank, mid, round(score, 6) AS score, source FROM fb""")
def u2_with_fallback(spark, sf):
    """Every user: hybrid recs when there are any, else the top list of a
    preference genre chosen by ``uid mod size`` (seed=None)."""
    from marquee.operators import statistics as st
    from marquee.operators.blend import with_fallback
    avgs = st.average_movies_score(si.ratings(spark, sf))
    top = st.ranked_genres(si.movies(spark, sf), avgs, 10)
    out = with_fallback(_hybrid(spark, sf), si.users(spark, sf), top, 10, seed=None)
    return out.withColumn("score", r6("score"))


def _fallback_sql(extra=()):
    return _hybrid_sql(("ranked_genres", "users", "averages") + tuple(extra)) + """, fb AS (
  SELECT u.uid, g.rank, g.mid, g.avg AS score, 'genre' AS source
  FROM users u JOIN ranked_genres g
    ON g.genre = split_part(u.prefGenres[CAST(u.uid % len(u.prefGenres) AS INTEGER) + 1], ' ', 1)
  WHERE u.uid NOT IN (SELECT uid FROM hybrid) AND len(u.prefGenres) > 0),
guess AS (SELECT uid, rank, mid, score, 'recs' AS source FROM hybrid
          UNION ALL SELECT uid, rank, mid, score, source FROM fb)
"""


@register("j7_guess_movies", _fallback_sql() + """
SELECT g.uid, g.rank, g.source, g.mid, m.name, round(coalesce(a.avg, 0.0), 6) AS avg_score
FROM guess g JOIN movies m ON m.mid = g.mid LEFT JOIN averages a ON a.mid = g.mid""")
def j7_guess_movies(spark, sf):
    """The guess flow end to end: hybrid (U1) -> fallback (U2) -> movies by
    id keeping rank and duplicates (J7) -> average score, 0.0 if none (J8)."""
    from marquee.operators import statistics as st
    from marquee.operators.blend import with_fallback
    from marquee.operators.serving import enrich, movies_by_ids
    avgs = st.average_movies_score(si.ratings(spark, sf))
    top = st.ranked_genres(si.movies(spark, sf), avgs, 10)
    recs = with_fallback(_hybrid(spark, sf), si.users(spark, sf), top, 10, seed=None)
    movies = enrich(si.movies(spark, sf).select("mid", "name"), avgs)
    out = movies_by_ids(movies, recs.select("uid", "rank", "source", "mid"))
    return out.select("uid", "rank", "source", "mid", "name", r6("score").alias("avg_score"))


@register("l6_wish_movies")
def l6_wish_movies(spark, sf):
    """The wish flow: ALS user lists, best 10 (L6) -> fallback for users
    without a list (U2) -> movies with average score (J7, J8).  Rows only
    (the factorisation is iterative)."""
    from marquee.operators import statistics as st
    from marquee.operators.blend import with_fallback
    from marquee.operators.model import train_als, user_recommendations
    from marquee.operators.serving import enrich, movies_by_ids
    ratings = si.ratings(spark, sf)
    recs = user_recommendations(train_als(ratings, n_ratings=si.table(spark, sf, "lineitem").count()), si.movies(spark, sf), 10)
    avgs = st.average_movies_score(ratings)
    top = st.ranked_genres(si.movies(spark, sf), avgs, 10)
    out = with_fallback(recs, si.users(spark, sf), top, 10, seed=42)
    movies = enrich(si.movies(spark, sf).select("mid", "name"), avgs)
    return movies_by_ids(movies, out.select("uid", "rank", "source", "mid"))


def _wish_sql():
    from marquee.plans.queries_model import _FIXED_SQL, FIXED_TOP_SQL
    return with_views("movies", "ratings", "ranked_genres", "users", "averages") + ", " + _FIXED_SQL + ", " + FIXED_TOP_SQL + """, fb AS (
  SELECT u.uid, g.rank, g.mid, 'genre' AS source
  FROM users u JOIN ranked_genres g
    ON g.genre = split_part(u.prefGenres[CAST(u.uid % len(u.prefGenres) AS INTEGER) + 1], ' ', 1)
  WHERE u.uid NOT IN (SELECT uid FROM fixed) AND len(u.prefGenres) > 0),
wish AS (SELECT f.uid, f.rank, f.mid, 'recs' AS source FROM fixed f JOIN users u ON u.uid = f.uid
         UNION ALL SELECT uid, rank, mid, source FROM fb)
SELECT w.uid, w.rank, w.source, w.mid, m.name, round(coalesce(a.avg, 0.0), 6) AS avg_score
FROM wish w JOIN movies m ON m.mid = w.mid LEFT JOIN averages a ON a.mid = w.mid"""


@register("l6_wish_from_factors", _wish_sql())
def l6_wish_from_factors(spark, sf):
    """The wish flow (L6, U2, J7, J8) on fixed factors: users' lists, best
    10, a preference genre's list for users without one, with movies and
    average scores."""
    from marquee.operators import statistics as st
    from marquee.operators.blend import with_fallback
    from marquee.operators.serving import enrich, movies_by_ids
    from marquee.plans.queries_model import fixed_top
    avgs = st.average_movies_score(si.ratings(spark, sf))
    top = st.ranked_genres(si.movies(spark, sf), avgs, 10)
    users = si.users(spark, sf)
    recs = fixed_top(spark, sf).join(users.select("uid"), "uid", "left_semi")
    out = with_fallback(recs, users, top, 10, seed=None)
    movies = enrich(si.movies(spark, sf).select("mid", "name"), avgs)
    return movies_by_ids(movies, out.select("uid", "rank", "source", "mid")) \
        .select("uid", "rank", "source", "mid", "name", r6("score").alias("avg_score"))


@register("l7_stream_recs_top", _hybrid_sql() + """
SELECT uid, CAST(rank AS INTEGER) AS rank, mid, round(score, 6) AS score FROM (
  SELECT uid, mid, score, row_number() OVER (PARTITION BY uid ORDER BY round(score, 9) DESC, mid) AS rank
  FROM stream) WHERE rank <= 5""")
def l7_stream_recs_top(spark, sf):
    """Best 5 of each user's streaming list (L7 over the T5 table)."""
    from marquee.operators import scoring as sc
    from marquee.operators.serving import best_of_lists, explode_recs
    from marquee.plans.queries_model import _score_events
    ev = si.rating_events(spark, sf)
    lists = sc.latest_recs(ev, _score_events(spark, sf))
    out = explode_recs(best_of_lists(lists.select("uid", "recs"), ev.select("uid").distinct(), "uid", 5), ["uid"])
    return out.withColumn("score", r6("score"))
