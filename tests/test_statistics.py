"""Statistics and serving top-n on tiny tables."""

from marquee.operators import statistics as st


def ratings(spark, rows):
    return spark.createDataFrame(rows, "uid int, mid int, score double, ts long")


def test_counts_ignore_null_scores(spark):
    r = ratings(spark, [(1, 1, 4.0, 0), (2, 1, None, 0), (1, 2, 3.0, 0)])
    got = {x.mid: x["count"] for x in st.rate_more_movies(r).collect()}
    assert got == {1: 1, 2: 1}


def test_monthly_counts(spark):
    r = ratings(spark, [(1, 1, 4.0, 1421000000), (2, 1, 3.0, 1421000000), (1, 1, 2.0, 1420070399)])
    got = sorted((x.mid, x.month, x["count"]) for x in st.rate_more_movies_recently(r).collect())
    assert got == [(1, 201412, 1), (1, 201501, 2)]


def test_genre_top_ties_by_mid(spark):
    movies = spark.createDataFrame([(1, "A|B"), (2, "A"), (3, "A"), (4, None)], "mid int, genres string")
    avgs = spark.createDataFrame([(1, 4.0), (2, 5.0), (3, 4.0), (4, 5.0)], "mid int, avg double")
    ranked = sorted((x.genre, x.rank, x.mid) for x in st.ranked_genres(movies, avgs, 2).collect())
    assert ranked == [("A", 1, 2), ("A", 2, 1), ("B", 1, 1)]
    lists = {x.genre: [(y.mid, y.score) for y in x.recs] for x in st.genres_top_movies(movies, avgs, 2).collect()}
    assert lists == {"A": [(2, 5.0), (1, 4.0)], "B": [(1, 4.0)]}


def test_pivot(spark):
    ranked = spark.createDataFrame([("A", 1, 2, 5.0), ("A", 2, 1, 4.0)], "genre string, rank int, mid int, avg double")
    row = st.pivot_top_genres(ranked, 3).first()
    assert (row.mid_1, row.avg_1, row.mid_2, row.mid_3) == (2, 5.0, 1, None)


def test_histogram_eleven_bins(spark):
    r = ratings(spark, [(1, 1, 0.0, 0), (1, 2, 5.0, 0), (1, 3, 4.7, 0), (1, 4, 2.25, 0)])
    dense = st.rating_histogram(r, dense=True).first().stat
    assert len(dense) == 11 and dense[0] == 1 and dense[10] == 1 and dense[9] == 1 and dense[5] == 1


def test_new_movies_parse_dates(spark):
    m = spark.createDataFrame([(1, "September 1, 2000"), (2, "April 2, 2001"), (3, "garbage")],
                              "mid int, issue string")
    assert [x.mid for x in st.new_movies(m, 3).orderBy("rank").collect()] == [2, 1, 3]
    # text order (the reference): byte order, lowercase after uppercase
    assert [x.mid for x in st.new_movies(m, 3, as_text=True).orderBy("rank").collect()] == [3, 1, 2]


def test_hot_movies_latest_month_first(spark):
    t = spark.createDataFrame([(1, 201501, 1), (2, 201412, 9), (3, 201501, 5)], "mid int, month long, count long")
    assert [x.mid for x in st.hot_movies(t, 2).orderBy("rank").collect()] == [3, 1]
