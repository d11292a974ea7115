"""Content search over the stored index of ``text_index``.

* X2 ``search``         -- BM25 over chosen fields, best field wins, top n;
* X3 ``more_like_this`` -- an anchor's most distinctive terms, scored with
  BM25 against all documents, anchor excluded, top n;
* X4 ``fuzzy_genre``    -- typo-tolerant genre match, top n;
* X5                    -- every result is (query key, rank, doc, score).

Scoring follows the published BM25 (k1 = 1.2, b = 0.75,
idf = ln(1 + (N - df + 0.5) / (df + 0.5))).  Texts are tokenised whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.operators.text_index import B, K1, Index, idf, rank_key, scored_top, tokens, top_n  # noqa: F401

# The more-like-this defaults of the public search-engine
# documentation.
MLT_MAX_QUERY_TERMS = 25
MLT_MIN_TERM_FREQ = 2
MLT_MIN_DOC_FREQ = 5
FUZZY_ROWS = 100_000      # movies whose genre tokens one task takes


def search(ix: Index, queries: DataFrame, fields: tuple[str, ...], n: int = 100) -> DataFrame:
    """BM25 of each query (qid, text) over each field; the best field's
    score wins -> (qid, rank, doc, score).  A query token repeated k times
    counts k times."""
    q = (queries.select("qid", F.explode(tokens("text")).alias("term"))
         .groupBy("qid", "term").agg(F.count(F.lit(1)).cast("double").alias("qw")))
    asked = q.withColumn("field", F.explode(F.array(*[F.lit(f) for f in fields])))
    return scored_top(ix, asked, n, best_field=True)


def more_like_this(ix: Index, anchors: DataFrame, n: int = 10,
                   max_query_terms: int = MLT_MAX_QUERY_TERMS,
                   min_term_freq: int = MLT_MIN_TERM_FREQ,
                   min_doc_freq: int = MLT_MIN_DOC_FREQ) -> DataFrame:
    """For each anchor doc (column ``anchor``), pick its terms with
    total tf >= min_term_freq over the indexed fields and df >= min_doc_freq
    (df: the field where the term is most common), rank them by tf x idf,
    keep the best ``max_query_terms``, and score every other document by
    the BM25 sum of those terms in their field -> (anchor, rank, doc, score).
    """
    order = F.struct((-F.col("df")).alias("less"), "field")
    top_field = ix.terms.groupBy("term").agg(F.min(order).alias("t")) \
        .select("term", F.col("t.field").alias("field"), (-F.col("t.less")).alias("df")).filter(F.col("df") >= min_doc_freq)
    top_field = top_field.withColumn("idf", idf(ix.of_field(0), F.col("df")))
    own = anchors.select(F.col("anchor").cast("long").alias("doc"), ix.shard_of(F.col("anchor")).alias("shard"))
    here = ix.blocks.join(own.select("shard").distinct(), "shard", "left_semi") \
        .select("term", F.explode(F.arrays_zip("docs", "tfs")).alias("p")).select("term", F.col("p.docs").alias("doc"), F.col("p.tfs").alias("tf"))
    a = here.join(own.select("doc"), "doc", "left_semi").groupBy(F.col("doc").alias("anchor"), "term").agg(F.sum("tf").alias("tf_all"))
    sel = a.filter(F.col("tf_all") >= min_term_freq).join(top_field, "term").withColumn("sel", F.col("tf_all") * F.col("idf"))
    wsel = Window.partitionBy("anchor").orderBy(rank_key("sel").desc(), F.col("term").asc())
    terms = sel.withColumn("_r", F.row_number().over(wsel)).filter(F.col("_r") <= max_query_terms)
    asked = terms.select(F.col("anchor").alias("qid"), "field", "term", F.lit(1.0).alias("qw"))
    kind = anchors.schema["anchor"].dataType
    return scored_top(ix, asked, n, exclude_self=True).select(F.col("qid").cast(kind).alias("anchor"), "rank", "doc", "score")


# ------------------------------------------------------------------ fuzzy

def allowed_edits(q: Column) -> Column:
    """Edits allowed by query length: <=2 -> 0, 3-5 -> 1, >5 -> 2."""
    ln = F.length(q)
    return F.when(ln <= 2, 0).when(ln <= 5, 1).otherwise(2)


def _deletes1(arr: Column) -> Column:
    """Every string of ``arr`` plus each one-character deletion of it."""
    return F.array_distinct(F.flatten(F.transform(arr, lambda s: F.concat(
        F.array(s),
        F.transform(F.sequence(F.lit(1), F.greatest(F.length(s), F.lit(1))),
                    lambda i: F.concat(F.substr(s, F.lit(1), i - 1), F.substr(s, i + 1)))))))


def delete_variants(term: Column, max_edits: Column | int) -> Column:
    """All strings obtained by deleting up to ``max_edits`` (0-2)
    characters.  Two strings within edit distance d share a variant
    obtained with at most d deletions from each (symmetric deletes), so an
    equi-join on variants finds every candidate pair exactly."""
    me = F.lit(max_edits) if isinstance(max_edits, int) else max_edits
    v0 = F.array(term)
    v1 = _deletes1(v0)
    v2 = _deletes1(v1)
    return F.when(me <= 0, v0).when(me == 1, v1).otherwise(v2)


def fuzzy_genre(movies: DataFrame, queries: DataFrame, n: int = 100) -> DataFrame:
    """Movies whose genre tokens are within the allowed edit distance
    of the query text (qid, text) -> (qid, rank, doc, score) where
    score = max over matching tokens of 1 - distance / length(query)."""
    texts = movies.select(F.col("mid").alias("doc"), "genres")
    tasks = max(1, -(-texts.count() // FUZZY_ROWS))
    vocab_docs = texts.repartition(tasks, "doc").select("doc", F.explode(tokens("genres")).alias("token")).distinct()
    vocab = vocab_docs.select("token").distinct()
    vv = vocab.select("token", F.explode(delete_variants(F.col("token"), 2)).alias("v"))
    q = queries.select("qid", F.lower(F.trim(F.col("text"))).alias("q"))
    qv = q.select("qid", "q", F.explode(delete_variants(F.col("q"), allowed_edits(F.col("q")))).alias("v"))
    match = (qv.join(vv, "v").select("qid", "q", "token").distinct()
             .withColumn("dist", F.levenshtein("q", "token"))
             .filter(F.col("dist") <= allowed_edits(F.col("q"))))
    # a token gives all its movies the same score, so none after its n smallest
    # ids can be among a query's n best
    w = Window.partitionBy("token").orderBy(F.col("doc").asc())
    leading = vocab_docs.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n).drop("_r")
    scored = (match.join(leading, "token")
              .groupBy("qid", "doc")
              .agg(F.max(F.lit(1.0) - F.col("dist") / F.length("q")).alias("score")))
    return top_n(scored, "qid", n)
