"""Driver contract and a sample of oracle comparisons on sf0.001."""

import duckdb
import pytest

import __spark_entry__ as ent
from tests.conftest import SF001

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def test_entry_runs(spark):
    df = ent.entry(spark)
    assert df.columns == ["genre", "rank", "mid", "avg"] and df.count() > 0


def test_every_query_has_oracle_or_is_known_non_sql():
    qs, sql = ent.queries(), ent.oracle_sql()
    assert set(sql) <= set(qs)
    own = {q for q in set(qs) - set(sql) if not q.startswith("op") and q != "pipeline"}
    assert own == {"m3_user_recommendations", "m2_predict_pairs", "l6_wish_movies"}


def _norm(v):
    return f"{v:.6f}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", ["a5_genres_top_movies", "t4_score_events", "x2_search",
                                  "x4_fuzzy_genre", "t7_upsert_ratings", "u2_with_fallback"])
def test_oracle_sf0001(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    df = ent.queries()[name](spark, SF001)
    rel = con.sql(ent.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    order = sorted(df.columns)
    s = sorted("|".join(_norm(r[c]) for c in order) for r in df.collect())
    idx = {c: i for i, c in enumerate(rel.columns)}
    d = sorted("|".join(_norm(r[idx[c]]) for c in order) for r in rel.fetchall())
    assert s == d
