"""Search: BM25 against a direct computation, symmetric-delete candidates,
blocked sparse top-n against brute force."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marquee.operators import search as se
from marquee.operators.text_index import built_index

DOCS = [(1, "red apple pie", "fruit"), (2, "green apple", "fruit fruit"), (3, "blue car", "car"),
        (4, "apple apple apple", "")]


def lev(a, b):
    d = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        prev, d[0] = d[0], i
        for j, cb in enumerate(b, 1):
            prev, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, prev + (ca != cb))
    return d[-1]


def bm25(docs, field_idx, q):
    toks = {d[0]: d[field_idx].lower().split() for d in docs}
    toks = {k: v for k, v in toks.items() if v}
    n = len(toks)
    avg = sum(len(v) for v in toks.values()) / n
    out = {}
    for doc, t in toks.items():
        s = 0.0
        for term in q.lower().split():
            tf = t.count(term)
            if not tf:
                continue
            df = sum(1 for v in toks.values() if term in v)
            idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
            s += idf * tf / (tf + 1.2 * (0.25 + 0.75 * len(t) / avg))
        if s > 0:
            out[doc] = s
    return out


def test_bm25_best_field(spark):
    docs = spark.createDataFrame(DOCS, "doc long, name string, descri string")
    ix = built_index(docs, "doc", ("name", "descri"))
    q = spark.createDataFrame([(1, "apple fruit")], "qid long, text string")
    got = {r.doc: r.score for r in se.search(ix, q, ("name", "descri"), 10).collect()}
    a, b = bm25(DOCS, 1, "apple fruit"), bm25(DOCS, 2, "apple fruit")
    want = {d: max(a.get(d, 0), b.get(d, 0)) for d in set(a) | set(b)}
    assert set(got) == set(want) and all(abs(got[d] - want[d]) < 1e-9 for d in want)


def test_more_like_this_excludes_anchor(spark):
    docs = spark.createDataFrame([(i, "apple pie " * (1 + i % 2), "x") for i in range(8)],
                                 "doc long, name string, descri string")
    ix = built_index(docs, "doc", ("name",))
    out = se.more_like_this(ix, spark.createDataFrame([(0,), (1,)], "anchor long"), 3,
                            min_term_freq=1, min_doc_freq=1).collect()
    assert out and all(r.doc != r.anchor for r in out)
    assert max(r.rank for r in out) <= 3


@settings(max_examples=30, deadline=None)
@given(st.text(alphabet="abcde", min_size=0, max_size=7), st.text(alphabet="abcde", min_size=0, max_size=7))
def test_symmetric_delete_finds_all_close_pairs(spark, a, b):
    d = lev(a, b)
    if d > 2:
        return
    r = spark.createDataFrame([(a, b)], "a string, b string").select(
        F.array_intersect(se.delete_variants(F.col("a"), d), se.delete_variants(F.col("b"), 2)).alias("x")).first()
    assert len(r.x) > 0


def test_fuzzy_genre(spark):
    movies = spark.createDataFrame([(1, "Action|Drama"), (2, "Comedy"), (3, "Actoin")], "mid int, genres string")
    q = spark.createDataFrame([("q1", "action"), ("q2", "dram"), ("q3", "zz")], "qid string, text string")
    got = sorted((r.qid, r.doc) for r in se.fuzzy_genre(movies, q, 100).collect())
    # 'actoin' is two edits from 'action' (no transpositions): allowed for 6 letters
    assert got == [("q1", 1), ("q1", 3), ("q2", 1)]


def _corpus(n=300, seed=4):
    import random
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(40)]
    rows = []
    for d in range(n):
        k = min(39, int(rnd.expovariate(0.1)))
        rows.append((d, "every " * rnd.randint(1, 3) + " ".join(rnd.choice(vocab[:k + 1]) for _ in range(rnd.randint(1, 30))), f"title w{d % 7}" if d % 5 else None))
    return rows


def _expected(rows, queries, n):
    docs = [(d, a or "", b or "") for d, a, b in rows]
    out = {}
    for qid, text in queries:
        parts = [bm25(docs, i, text) for i in (1, 2)]
        scores = {d: max(p.get(d, 0) for p in parts) for d in set(parts[0]) | set(parts[1])}
        out[qid] = [d for _, d in sorted((-round(s, 9), d) for d, s in scores.items())][:n]
    return out


def test_stored_index_equals_brute_force_with_and_without_bounds(spark):
    from marquee.operators import text_index as ti
    rows = _corpus()
    queries = [(i, f"w{i} every w{i % 5} w{i % 3}") for i in range(20)] + [(77, "nothing here"), (78, ""), (79, None)]
    docs = spark.createDataFrame(rows, "doc long, name string, descri string")
    built = built_index(docs, "doc", ("name", "descri"), shard_docs=20, bucket_tokens=200)
    ix = ti.open_index(spark, built.path)
    assert ix.shards >= 15 and ix.buckets > 1 and ix.stats == built.stats
    blocks = ix.blocks.filter("term = 'every'")
    assert blocks.count() == ix.shards                       # a hot term is a block per shard
    assert {r.df for r in ix.terms.filter("term = 'every'").collect()} == {300}
    want = _expected(rows, [q for q in queries if q[1]], 5)
    asked = spark.createDataFrame(queries, "qid long, text string") \
        .select("qid", F.explode(se.tokens("text")).alias("term")).groupBy("qid", "term").agg(F.count("*").cast("double").alias("qw")) \
        .withColumn("field", F.explode(F.array(F.lit("name"), F.lit("descri"))))
    for prune in (10**9, 1):
        got = {}
        for r in ti.scored_top(ix, asked, 5, best_field=True, prune_shards=prune).collect():
            got.setdefault(r.qid, []).append((r["rank"], r.doc))
        assert {q: [d for _, d in sorted(v)] for q, v in got.items()} == {q: v for q, v in want.items() if v}
    visits = ti._visits(ix, ti.weighted(ix, asked))
    assert 0 < visits.count() <= 20 * ix.shards
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0      # nothing stays cached


def test_search_reads_only_its_buckets(spark):
    from marquee.operators import text_index as ti
    docs = spark.createDataFrame(_corpus(), "doc long, name string, descri string")
    ix = built_index(docs, "doc", ("name",), shard_docs=50, bucket_tokens=100)
    asked = ti.weighted(ix, spark.createDataFrame([(1, "name", "w1", 1.0)], "qid long, field string, term string, qw double"))
    files = {f.split("bucket=")[1].split("/")[0] for f in ti._of_terms(ix, asked).inputFiles() if "bucket=" in f}
    plan = ti._of_terms(ix, asked)._jdf.queryExecution().executedPlan().toString()
    assert ix.buckets > 5 and "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1][:60] and files


def test_products_dense_and_by_term_agree():
    import numpy as np
    from marquee.operators import text_index as ti
    rng = np.random.default_rng(2)
    for nq, nd, terms, per in ((30, 50, 6, 4), (5, 400, 900, 3)):
        q = {(int(a), int(t)) for a in range(nq) for t in rng.integers(0, terms, per)}
        d = {(int(a), int(t)) for a in range(nd) for t in rng.integers(0, terms, per)}
        q_at, q_t = map(np.array, zip(*sorted(q)))
        d_at, d_t = map(np.array, zip(*sorted(d)))
        q_w, d_w = rng.random(len(q_at)), rng.random(len(d_at))
        want = np.zeros((nq, nd))
        for i, (a, t) in enumerate(zip(q_at, q_t)):
            for j, (b, u) in enumerate(zip(d_at, d_t)):
                if t == u:
                    want[a, b] += q_w[i] * d_w[j]
        assert np.allclose(ti.products(q_at, q_t, q_w, d_at, d_t, d_w, nq, nd), want)


def test_empty_index(spark):
    docs = spark.createDataFrame([], "doc long, name string")
    ix = built_index(docs, "doc", ("name",))
    q = spark.createDataFrame([(1, "apple")], "qid long, text string")
    assert ix.postings.count() == 0 and se.search(ix, q, ("name",), 10).count() == 0


def test_fuzzy_genre_reads_a_tokens_leading_movies_only(spark):
    """A token's movies tie, so its n smallest ids are enough; a movie with
    two tokens keeps the better one's score."""
    genres = {i: "drama" if i % 3 else "dramas|crime" if i % 2 else "crime" for i in range(1, 400)}
    movies = spark.createDataFrame(list(genres.items()), "mid int, genres string")
    q = spark.createDataFrame([(t, t) for t in ("drama", "dramas", "crim", "cramas")], "qid string, text string")
    out = se.fuzzy_genre(movies, q, 7)
    got = {(r.qid, r["rank"]): (r.doc, round(r.score, 9)) for r in out.collect()}
    for (t,) in q.select("text").collect():
        edits = 1 if len(t) <= 5 else 2
        score = {m: max((1 - lev(t, x) / len(t) for x in g.split("|") if lev(t, x) <= edits), default=None) for m, g in genres.items()}
        want = sorted((-round(s, 9), m) for m, s in score.items() if s is not None)[:7]
        assert [got.get((t, i + 1)) for i in range(7)] == [(m, -s) for s, m in want]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit [token" in plan


def test_queries_and_shards_meet_in_cells(spark, monkeypatch):
    """shards are moved once per group of queries, not once per pair."""
    from marquee.operators import text_index as ti
    rows = _corpus()
    docs = spark.createDataFrame(rows, "doc long, name string, descri string")
    ix = built_index(docs, "doc", ("name", "descri"), shard_docs=20, bucket_tokens=200)
    for name, value in (("GROUP_QUERIES", 8), ("QUERIES_AT_ONCE", 5), ("DOCS_AT_ONCE", 7), ("ROWS_OUT", 50)):
        monkeypatch.setattr(ti, name, value)
    queries = [(d, f"{a} {b or ''}") for d, a, b in rows]
    want = _expected(rows, queries, 6)
    q = spark.createDataFrame(queries, "qid long, text string")
    terms = q.select("qid", F.explode(se.tokens("text")).alias("term")).groupBy("qid", "term").agg(F.count("*").cast("double").alias("qw")) \
        .withColumn("field", F.explode(F.array(F.lit("name"), F.lit("descri"))))
    cells = []
    monkeypatch.setattr(ti, "_dealt", lambda held, met, n, order, dealt=ti._dealt: (cells.append((n, met.count())), dealt(held, met, n, order))[1])
    got = {}
    for r in ti.scored_top(ix, terms, 6, best_field=True).collect():
        got.setdefault(r.qid, []).append((r["rank"], r.doc))
    assert {q: [d for _, d in sorted(v)] for q, v in got.items()} == {q: v for q, v in want.items() if v}
    (n, moved), = cells
    assert 1 < n <= 2 * 4 * spark.sparkContext.defaultParallelism
    groups = -(-len(queries) // 8)
    assert moved < groups * 2 * ix.shards / 3
    alone = {r.qid: r.doc for r in ti.scored_top(ix, terms, 1, exclude_self=True).collect()}
    assert alone and all(q != d for q, d in alone.items())


def test_index_counts_repeated_and_null_ids(spark):
    """terms are counted per document, rows that share an id are one."""
    docs = spark.createDataFrame([(5, "a b a"), (5, "a b a"), (None, "B c"), (2, "é a"), (3, ""), (4, None)], "doc long, name string")
    ix = built_index(docs, "doc", ("name",))
    got = sorted(((r.term, -1 if r.doc is None else r.doc, r.tf, r.dl) for r in ix.postings.collect()))
    assert got == [("a", 2, 1, 2), ("a", 5, 4, 3), ("b", -1, 1, 2), ("b", 5, 2, 3), ("c", -1, 1, 2), ("é", 2, 1, 2)]
    plan = ix.blocks._jdf.queryExecution().executedPlan().toString()
    assert "Scan parquet" in plan and {(r.term, r.df) for r in ix.terms.collect()} == {("a", 2), ("b", 2), ("c", 1), ("é", 1)}


def test_index_files_do_not_grow_with_shards_times_buckets(spark):
    """a bucket's file holds the blocks of many shards."""
    docs = spark.createDataFrame(_corpus(), "doc long, name string, descri string")
    ix = built_index(docs, "doc", ("name",), shard_docs=4, bucket_tokens=200)
    assert ix.shards > 64 and ix.buckets > 8
    assert len(ix.blocks.inputFiles()) <= ix.buckets


def test_documents_without_a_needed_term_are_not_scored(monkeypatch):
    """once n documents have all of a query's terms, later shards are
    read only where the two rarest of them are; ties go to smaller ids."""
    from types import SimpleNamespace

    import numpy as np

    from marquee.operators import text_index as ti
    rng = np.random.default_rng(3)
    nq, nd, n = 300, 200, 5
    words = lambda m: np.stack([rng.integers(0, 10, m), 10 + rng.integers(0, 8, m), 18 + rng.integers(0, 4, m)], axis=1)
    weight = 1.0 + np.arange(22)[::-1] / 7
    asked = words(nq)
    pack = SimpleNamespace(qids=list(range(nq)), at=np.repeat(np.arange(nq), 3).tobytes(), q_tids=asked.ravel().astype(np.int64).tobytes(),
                           q_ws=weight[asked.ravel()].tobytes(), only=np.full(nq, -1).tobytes(), least=np.zeros(nq).tobytes())
    dense, true = [], ti._summed
    monkeypatch.setattr(ti, "_summed", lambda *a: dense.append(a[-2] * a[-1]) or true(*a))
    for table in (4_000_000, 60):                        # weights in a table, and looked up
        monkeypatch.setattr(ti, "CELLS", table)
        a, score = ti._Asked([pack]), {}
        ids = rng.permutation(20 * nd).reshape(20, nd)
        for shard, own in enumerate(np.sort(ids, axis=1)):
            has = words(nd)
            tf = rng.choice([0.5, 0.6], (nd, 3))
            order = np.lexsort((np.repeat(np.arange(nd), 3), has.ravel()))
            tids, size = np.unique(has.ravel(), return_counts=True)
            r = SimpleNamespace(shard=shard, d_tids=tids.tobytes(), sizes=size.tobytes(), ids=own.tobytes(),
                                d_at=np.repeat(np.arange(nd), 3)[order].astype(np.int32).tobytes(), ws=tf.ravel()[order].tobytes())
            dense.clear()
            a.meet(r, n, True)
            a.settle(n)
            for d in range(nd):
                for q, s in enumerate(((asked == has[d]) * tf[d] * weight[asked]).sum(axis=1).tolist()):
                    if s > 0 and own[d] != q:
                        score.setdefault(q, []).append((-round(s, 9), int(own[d])))
        assert sum(dense) < nq * nd / 4                      # of the last shard
        found = {}
        for q, doc, s in zip(*(c.tolist() for c in a.found)):
            found.setdefault(q, []).append((-round(s, 9), doc))
        assert found == {q: sorted(rows)[:n] for q, rows in score.items()}
