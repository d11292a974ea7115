"""Scalar functions P1-P12 on hand-made rows (rules R3, R4, R6, R13, R14)."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marquee.functions import columns as c


def java_hash(s: str) -> int:
    h = 0
    raw = s.encode("utf-16-be")
    for i in range(0, len(raw), 2):
        h = (31 * h + (raw[i] << 8 | raw[i + 1])) & 0xFFFFFFFF
    return h - (1 << 32) if h >= (1 << 31) else h


def test_extract_rating_log(spark):
    df = spark.createDataFrame(
        [(1, "INFO x movie_rating:4|52|3.5|1300000007 "), (2, "noise"),
         (3, "a movie_rating: 2|3|4.0|5 movie_rating:junk"), (4, "only movie_rating:")],
        "offset long, value string")
    out = {r.offset: r.value for r in c.extract_rating_log(df, "movie_rating:").collect()}
    assert out == {1: "4|52|3.5|1300000007", 3: "2|3|4.0|5"}


def test_parse_rating_message_quarantine(spark):
    df = spark.createDataFrame([("4|52|3.5|1300000007",), ("x|1|2|3",), ("1|2|3",), ("",)], "value string")
    rows = c.parse_rating_message(df, keep_bad=True).orderBy("value").collect()
    good = [r for r in rows if not r.bad]
    assert [(r.uid, r.mid, r.score, r.ts) for r in good] == [(4, 52, 3.5, 1300000007)]
    assert sum(r.bad for r in rows) == 3
    assert c.parse_rating_message(df).count() == 1


def test_month_bucket_fixed_case(spark):
    df = spark.createDataFrame([(1437000123,), (1435708799,), (1435708800,)], "ts long")
    got = [r.m for r in df.select(c.month_bucket("ts").alias("m")).collect()]
    assert got == [201507, 201506, 201507]     # month boundary in UTC


def test_explode_genres(spark):
    m = spark.createDataFrame([(1, "Action|Drama"), (2, None), (3, "Drama|Drama")], "mid int, genres string")
    got = sorted((r.mid, r.genre) for r in c.explode_genres(m).collect())
    assert got == [(1, "Action"), (1, "Drama"), (3, "Drama"), (3, "Drama")]


def test_cosine_zero_vector_is_null(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>")
    got = [r.s for r in df.select(c.cosine("a", "b").alias("s")).collect()]
    assert abs(got[0] - 2 ** -0.5) < 1e-12 and got[1] is None


def test_recent_queue_dump(spark):
    df = spark.createDataFrame([(1, ["52:3.5", "7:4.0", "bad"])], "uid int, entries array<string>")
    got = [(r.pos, r.mid, r.score) for r in c.load_recent_queue(df).orderBy("pos").collect()]
    assert got == [(0, 52, 3.5), (1, 7, 4.0)]


def test_recs_text_round_trip_and_top(spark):
    df = spark.createDataFrame([(1, "5:0.5|3:0.9|4:0.9"), (2, ""), (3, None)], "k int, t string")
    out = df.select("k", c.top_recs(c.decode_recs("t"), 2).alias("r")).orderBy("k").collect()
    assert [(x.mid, x.score) for x in out[0].r] == [(3, 0.9), (4, 0.9)]
    assert out[1].r == [] and out[2].r == []
    enc = df.select(c.encode_recs(c.decode_recs("t")).alias("e")).collect()
    assert enc[0].e == "5:0.5|3:0.9|4:0.9" and enc[1].e == ""


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(min_codepoint=32, max_codepoint=0x1FFFF,
                                                blacklist_categories=("Cs",)), max_size=12),
                min_size=1, max_size=5))
def test_uid_from_username_matches_java_hash(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = [r.h for r in df.select(c.uid_from_username("name").alias("h")).collect()]
    assert got == [java_hash(n) for n in names]


def test_prefs(spark):
    df = spark.createDataFrame([("Action Movies,Drama",)], "p string")
    r = df.select(c.parse_prefs("p").alias("l"), c.pref_key(F.lit("Action Movies")).alias("k")).first()
    assert r.l == ["Action Movies", "Drama"] and r.k == "Action"


def test_format_rating_log(spark):
    df = spark.createDataFrame([(4, 52, 3.5, 1300000007)], "u int, m int, s double, t long")
    v = df.select(c.format_rating_log("u", "m", "s", "t", "movie_rating:").alias("v")).first().v
    assert v == "movie_rating:4|52|3.5|1300000007"
