"""The stand-in views written in DuckDB SQL, for the oracle queries.

They mirror ``marquee.sources.standin`` rule for rule; each oracle query
starts with ``WITH`` + the views it needs.
"""

VIEWS = {
    "ratings": """ratings AS (
  SELECT CAST(o_custkey AS INTEGER) AS uid, CAST(l_partkey AS INTEGER) AS mid,
         floor(l_quantity / 5 + 0.5) / 2.0 AS score,
         CAST(epoch(l_shipdate) AS BIGINT) AS ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    "movies": """movies AS (
  SELECT CAST(p_partkey AS INTEGER) AS mid, p_name AS name,
         concat_ws(' ', p_name, p_brand, p_type) AS descri,
         CAST(p_size AS VARCHAR) || ' minutes' AS timelong,
         strftime(DATE '1995-01-01' + CAST(p_partkey % 2400 AS INTEGER), '%B %-d, %Y') AS issue,
         strftime(DATE '1995-01-01' + CAST(p_partkey % 2400 AS INTEGER), '%Y') AS shoot,
         'English' AS language,
         concat_ws('|', p_type, string_split(p_name, ' ')[1]) AS genres,
         replace(p_name, ' ', '|') AS actors,
         p_brand AS directors,
         DATE '1995-01-01' + CAST(p_partkey % 2400 AS INTEGER) AS issue_date
  FROM part)""",
    "tags": """tags AS (
  SELECT event_id, CAST(user_id AS INTEGER) AS uid,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS mid,
         event_type AS tag, CAST(floor(epoch(ts)) AS BIGINT) AS ts
  FROM events)""",
    "rating_events": """rating_events AS (
  SELECT event_id, CAST(user_id AS INTEGER) AS uid,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS mid,
         least(5.0, floor(value / 20 + 0.5) / 2.0) AS score,
         CAST(floor(epoch(ts)) AS BIGINT) AS ts
  FROM events WHERE event_type = 'purchase')""",
    "users": """users AS (
  SELECT CAST(c_custkey AS INTEGER) AS uid, c_name AS username, TRUE AS first,
         CAST(0 AS BIGINT) AS ts,
         [(['ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD'])[CAST(c_custkey % 6 AS INTEGER) + 1]] AS prefGenres
  FROM customer)""",
    "averages": """averages AS (SELECT mid, avg(score) AS avg FROM ratings GROUP BY mid)""",
    "genre_rows": """genre_rows AS (
  SELECT mid, unnest(string_split(genres, '|')) AS genre FROM movies)""",
    "ranked_genres": """ranked_genres AS (
  SELECT genre, rank, mid, avg FROM (
    SELECT g.genre, a.mid, a.avg,
           CAST(row_number() OVER (PARTITION BY g.genre ORDER BY a.avg DESC, a.mid ASC) AS INTEGER) AS rank
    FROM averages a JOIN genre_rows g ON a.mid = g.mid) WHERE rank <= 10)""",
    "factors": """factors AS (
  SELECT CAST(vec_id AS INTEGER) AS mid, CAST(embedding AS DOUBLE[]) AS features FROM embeddings)""",
}

# Views that other views read, so ``with_views`` can pull them in.
DEPENDS = {
    "averages": ["ratings"],
    "genre_rows": ["movies"],
    "ranked_genres": ["averages", "genre_rows"],
}


def with_views(*names: str) -> str:
    order: list[str] = []

    def add(n):
        for d in DEPENDS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)
    for n in names:
        add(n)
    return "WITH " + ",\n".join(VIEWS[n] for n in order) + "\n"
