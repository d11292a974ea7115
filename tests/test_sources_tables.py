"""Readers (S1-S3, R14), sinks (S4-S6), maintenance."""

import pytest

from marquee.operators import maintenance as mt
from marquee.sources import files, tables


def test_read_movies_trims_and_quarantines(spark, tmp_out):
    p = f"{tmp_out}/movies.txt"
    with open(p, "w") as f:
        f.write("1^Paper Harbour (2031)^ ^97 minutes^May 4, 2033^2031^English ^Mystery|Romance ^Ada Quill ^Bo Marsh\n")
        f.write("x^bad id^^^^^^^^\n")
    good, bad = files.read_movies(spark, p, mode="quarantine")
    row = good.first()
    assert good.count() == 1 and row.mid == 1 and row.language == "English" and row.genres == "Mystery|Romance"
    assert row.descri == ""
    assert bad.count() == 1


def test_read_ratings_strict_and_quarantine(spark, tmp_out):
    p = f"{tmp_out}/ratings.csv"
    with open(p, "w") as f:
        f.write("4,52,3.5,1300000007\n1,x,2.5,1\n")
    good, bad = files.read_ratings(spark, p, mode="quarantine")
    assert good.count() == 1 and bad.count() == 1
    strict, _ = files.read_ratings(spark, p, mode="strict")
    with pytest.raises(Exception):
        strict.collect()


def test_tags_comma_inside_is_bad_line(spark, tmp_out):
    p = f"{tmp_out}/tags.csv"
    with open(p, "w") as f:
        f.write("8,412,slow second act,1300000123\n8,412,a,b,1\n")
    good, bad = files.read_tags(spark, p, mode="quarantine")
    assert good.count() == 1 and bad.count() == 1


def test_save_load_and_documents(spark, tmp_out):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], "mid int, name string, v int")
    tables.save_documents(df, tmp_out, "docs", key="mid", order_cols=["v"])
    back = {r.mid: r.name for r in tables.load_table(spark, tmp_out, "docs").collect()}
    assert back == {1: "b", 2: "c"}


def test_millisecond_times_normalised(spark):
    df = spark.createDataFrame([(1437000123,), (1437000123000,)], "t long")
    assert [r.s for r in df.select(files.normalise_seconds("t").alias("s")).collect()] == [1437000123] * 2


def test_upsert_ratings_keeps_old_time(spark):
    base = spark.createDataFrame([(1, 1, 3.0, 10)], "uid int, mid int, score double, ts long")
    upd = spark.createDataFrame([(1, 1, 5.0, 20, 7), (1, 2, 1.0, 30, 8), (1, 2, 2.0, 40, 9)],
                                "uid int, mid int, score double, ts long, event_id long")
    got = sorted(tuple(r) for r in mt.upsert_ratings(base, upd).collect())
    assert got == [(1, 1, 5.0, 10), (1, 2, 2.0, 30)]
    again = sorted(tuple(r) for r in mt.upsert_ratings(mt.upsert_ratings(base, upd), upd).collect())
    assert again == got                                   # idempotent


def test_apply_preferences_and_delete(spark):
    users = spark.createDataFrame([(1, "u1", True, 0, ["A"]), (2, "u2", True, 0, [])],
                                  "uid int, username string, first boolean, ts long, prefGenres array<string>")
    upd = spark.createDataFrame([(1, ["B", "C"])], "uid int, genres array<string>")
    got = {r.uid: (r.first, r.prefGenres) for r in mt.apply_preferences(users, upd).collect()}
    assert got == {1: (False, ["A", "B", "C"]), 2: (True, [])}
    assert mt.delete_keys(users, upd, ["uid"]).count() == 1


def test_apply_new_tags_no_dedupe(spark):
    tags = spark.createDataFrame([(1, 5, "x", 1)], "uid int, mid int, tag string, ts long")
    docs = spark.createDataFrame([(5, "x"), (6, None)], "mid int, tags string")
    upd = spark.createDataFrame([(2, 5, "y", 3, 2), (2, 5, "x", 2, 1), (3, 6, "z", 1, 3)],
                                "uid int, mid int, tag string, ts long, event_id long")
    new_tags, new_docs = mt.apply_new_tags(tags, docs, upd)
    assert new_tags.count() == 4
    assert {r.mid: r.tags for r in new_docs.collect()} == {5: "x|x|y", 6: "z"}
