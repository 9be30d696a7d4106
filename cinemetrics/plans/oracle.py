"""Independent SQL (DuckDB dialect) for every query with a relational definition.

Every statement starts with the fixture CTE, which defines ratings / movies /
movie_genres / my_movies from the star-schema tables exactly as the Spark adapter does.
The pair and kNN statements are the brute-force forms of the reference's rules: all
user pairs with ``a.movie_id < b.movie_id`` and one own movie, and every own movie as a
candidate (-1.0 when it has no pair) -- not the pruned forms the Spark side uses.
"""

from __future__ import annotations

FIXTURE_CTE = """
WITH ratings AS (
  SELECT o_custkey AS user_id, l_suppkey AS movie_id,
         CASE WHEN (o_custkey + l_suppkey) % 13 = 0 THEN CAST(0 AS DOUBLE)
              ELSE CAST((SUM(CAST(l_quantity AS BIGINT)) % 10 + 1) AS DOUBLE) * 0.5 END AS rating,
         MAX(date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE))) * 86400
           + (o_custkey * 31 + l_suppkey * 17) % 86400 AS ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY o_custkey, l_suppkey
),
part_ratings AS (
  SELECT o_custkey AS user_id, l_partkey AS movie_id,
         CASE WHEN (o_custkey + l_partkey) % 13 = 0 THEN CAST(0 AS DOUBLE)
              ELSE CAST((SUM(CAST(l_quantity AS BIGINT)) % 10 + 1) AS DOUBLE) * 0.5 END AS rating,
         MAX(date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE))) * 86400
           + (o_custkey * 31 + l_partkey * 17) % 86400 AS ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY o_custkey, l_partkey
),
movies AS (
  SELECT s_suppkey AS movie_id,
         CASE WHEN s_suppkey % 5 = 1 THEN s_name || ', The'
              WHEN s_suppkey % 7 = 2 THEN 'The "' || s_name || '"' ELSE s_name END AS title,
         CASE WHEN s_suppkey % 11 = 4 THEN ''
              ELSE concat_ws('|', r_name, n_name, CASE WHEN s_acctbal >= 5000 THEN 'HIGH_BALANCE' END) END AS genres
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
part_movies AS (
  SELECT p_partkey AS movie_id,
         CASE WHEN p_partkey % 5 = 1 THEN p_name || ', The'
              WHEN p_partkey % 7 = 2 THEN 'The "' || p_name || '"' ELSE p_name END AS title
  FROM part
),
movie_genres AS (
  SELECT movie_id, title, genre
  FROM (SELECT movie_id, title, unnest(string_split(genres, '|')) AS genre FROM movies)
  WHERE genre <> ''
),
person AS (
  SELECT user_id FROM part_ratings GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 1
),
my_movies AS (
  SELECT movie_id, rating AS my_rating FROM part_ratings WHERE user_id = (SELECT user_id FROM person)
),
genre_ratings AS (
  SELECT g.genre, r.user_id, r.movie_id, r.rating FROM ratings r JOIN movie_genres g ON g.movie_id = r.movie_id
),
genre_user AS (
  SELECT genre, user_id, count(*) AS rating_count, avg(rating) AS avg_rating
  FROM genre_ratings GROUP BY genre, user_id
),
genre_top_users AS (
  SELECT * FROM (
    SELECT genre, user_id, rating_count, avg_rating,
           CAST(row_number() OVER (PARTITION BY genre ORDER BY rating_count DESC, user_id) AS INTEGER) AS "rank"
    FROM genre_user) WHERE "rank" <= 5
),
user_stats AS (
  SELECT user_id, count(*) AS total_ratings, avg(rating) AS dataset_avg_rating FROM ratings GROUP BY user_id
),
part_user_stats AS (
  SELECT user_id, avg(rating) AS dataset_avg_rating FROM part_ratings GROUP BY user_id
),
unrated AS (
  SELECT movie_id, title FROM part_movies WHERE movie_id NOT IN (SELECT movie_id FROM my_movies)
),
pairs AS (
  SELECT a.user_id,
         CASE WHEN ma.movie_id IS NOT NULL THEN a.movie_id ELSE b.movie_id END AS own_id,
         CASE WHEN ma.movie_id IS NULL THEN a.movie_id ELSE b.movie_id END AS pred_id,
         CASE WHEN ma.movie_id IS NOT NULL THEN a.rating ELSE b.rating END AS own_rating,
         CASE WHEN ma.movie_id IS NULL THEN a.rating ELSE b.rating END AS pred_rating
  FROM part_ratings a
  JOIN part_ratings b ON a.user_id = b.user_id AND a.movie_id < b.movie_id
  LEFT JOIN my_movies ma ON ma.movie_id = a.movie_id
  LEFT JOIN my_movies mb ON mb.movie_id = b.movie_id
  WHERE ma.movie_id IS NOT NULL OR mb.movie_id IS NOT NULL
),
sims AS (
  SELECT own_id, pred_id, count(*) AS co_raters,
         round(CASE WHEN sqrt(sum(dx * dx)) * sqrt(sum(dy * dy)) <> 0
                    THEN sum(dx * dy) / (sqrt(sum(dx * dx)) * sqrt(sum(dy * dy))) END, 9) AS similarity
  FROM (SELECT p.own_id, p.pred_id, p.own_rating - u.dataset_avg_rating AS dx,
               p.pred_rating - u.dataset_avg_rating AS dy
        FROM pairs p JOIN part_user_stats u ON u.user_id = p.user_id)
  GROUP BY own_id, pred_id
),
candidates AS (
  SELECT p.pred_id, m.movie_id AS own_id, m.my_rating,
         CASE WHEN s.pred_id IS NULL THEN CAST(-1 AS DOUBLE) ELSE s.similarity END AS sim,
         (s.pred_id IS NOT NULL AND s.similarity IS NULL) AS undefined
  FROM (SELECT DISTINCT pred_id FROM sims) p
  CROSS JOIN my_movies m
  LEFT JOIN sims s ON s.pred_id = p.pred_id AND s.own_id = m.movie_id
),
knn AS (
  SELECT pred_id AS movie_id,
         CASE WHEN bool_or(undefined) OR sum(abs(sim)) = 0 THEN CAST(-1000 AS DOUBLE)
              ELSE round(sum(sim * my_rating) / sum(abs(sim)), 6) END AS prediction
  FROM (SELECT *, row_number() OVER (PARTITION BY pred_id ORDER BY undefined DESC, sim DESC NULLS LAST, own_id) AS rn
        FROM candidates)
  WHERE rn <= 10
  GROUP BY pred_id
),
split AS (
  SELECT *, CASE WHEN ts % 10 < 6 THEN 'training' WHEN ts % 10 <= 8 THEN 'validation' ELSE 'test' END AS split
  FROM ratings
),
part_split AS (
  SELECT *, CASE WHEN ts % 10 < 6 THEN 'training' WHEN ts % 10 <= 8 THEN 'validation' ELSE 'test' END AS split
  FROM part_ratings
),
training AS (
  SELECT user_id, movie_id, rating FROM part_split WHERE split = 'training'
  UNION ALL
  SELECT CAST(-1 AS BIGINT) AS user_id, movie_id, my_rating AS rating FROM my_movies
),
genre_avg AS (
  SELECT genre, avg(rating) AS avg_rating, count(*) AS rating_count FROM genre_ratings GROUP BY genre
)
"""

_GENRE_MOVIE_COUNTS = """
SELECT g.genre, g.movie_id, g.title, c.rating_count
FROM (SELECT movie_id, count(*) AS rating_count FROM ratings GROUP BY movie_id) c
JOIN movie_genres g ON g.movie_id = c.movie_id
"""

_PROFILE = """
SELECT t.genre, t."rank", t.user_id, t.rating_count AS genre_ratings, t.avg_rating AS genre_avg_rating,
       u.total_ratings, u.dataset_avg_rating
FROM genre_top_users t JOIN user_stats u ON u.user_id = t.user_id
"""

_POPULAR = """
SELECT s.movie_id, m.title, s.num_nonzeros, s.norm_l1 / s.num_nonzeros AS mean_rating
FROM (SELECT movie_id, count(*) FILTER (WHERE rating <> 0) AS num_nonzeros, sum(abs(rating)) AS norm_l1
      FROM ratings GROUP BY movie_id) s
JOIN movies m ON m.movie_id = s.movie_id
WHERE s.num_nonzeros >= {}"""

_COLUMN_STATS = """
SELECT movie_id, count(*) FILTER (WHERE rating <> 0) AS num_nonzeros, sum(abs(rating)) AS norm_l1
FROM ratings GROUP BY movie_id"""

_PAGES = """
SELECT genre, (n - 1) // {0} AS page, count(*) AS n_movies, string_agg(movie_id, ',' ORDER BY n) AS movies
FROM (SELECT *, row_number() OVER (PARTITION BY genre ORDER BY rating_count DESC, movie_id) AS n FROM (""" + _GENRE_MOVIE_COUNTS + """))
GROUP BY genre, (n - 1) // {0}"""


def _solved(side: str, given: str, factors: str) -> str:
    """Rank-2 factors of one side from those of the other: normal equations and Cramer's rule."""
    return f"""
SELECT {side}, (c * p - b * q) / (a * c - b * b) AS f1, (a * q - b * p) / (a * c - b * b) AS f2
FROM (SELECT t.{side}, sum(f1 * f1) + 0.1::DOUBLE * count(*) AS a, sum(f1 * f2) AS b, sum(f2 * f2) + 0.1::DOUBLE * count(*) AS c,
             sum(rating * f1) AS p, sum(rating * f2) AS q
      FROM training t JOIN {factors} y ON y.{given} = t.{given} GROUP BY t.{side})"""


_START = """(
SELECT DISTINCT movie_id, ((movie_id % 997 * 31 + 7) % 997 + 1) / 998::DOUBLE AS f1,
       ((movie_id % 997 * 53 + 11) % 997 + 1) / 998::DOUBLE AS f2 FROM training)"""
_USER_FACTORS = _solved("user_id", "movie_id", _START)
_ROUNDED = "SELECT {}, round(f1, 6) AS f1, round(f2, 6) AS f2 FROM ({})"

_BODIES: dict[str, str] = {
    "ratings_scan": "SELECT user_id, movie_id, rating, ts FROM ratings",
    "movies_scan": """
        SELECT movie_id, title, genres,
               CAST(len(list_filter(string_split(genres, '|'), lambda x: x <> '')) AS INTEGER) AS n_genres
        FROM movies""",
    "my_movies_scan": "SELECT movie_id, my_rating FROM my_movies",
    "ratings_tolerant_parse": "SELECT movie_id, rating FROM ratings WHERE (user_id + movie_id) % 17 <> 0",
    "ratings_rejected": """
        SELECT user_id, movie_id, 'n/a' AS rating, ts, 'rating does not parse' AS reason
        FROM ratings WHERE (user_id + movie_id) % 17 = 0""",
    "ratings_parse_counts": """
        SELECT count(*) FILTER (WHERE (user_id + movie_id) % 17 <> 0) AS n_accepted,
               count(*) FILTER (WHERE (user_id + movie_id) % 17 = 0) AS n_rejected
        FROM ratings""",
    "rating_map_projection": "SELECT movie_id, user_id, rating FROM ratings",
    "sink_roundtrip": "SELECT genre, avg_rating, rating_count FROM genre_avg",
    "movie_genres": "SELECT movie_id, genre FROM movie_genres",
    "genre_ratings": "SELECT genre, user_id, movie_id, rating FROM genre_ratings",
    "movie_rating_count": "SELECT movie_id, count(*) AS rating_count FROM ratings GROUP BY movie_id",
    "user_rating_count": "SELECT user_id, count(*) AS rating_count FROM ratings GROUP BY user_id",
    "user_avg_rating": "SELECT user_id, avg(rating) AS avg_rating FROM ratings GROUP BY user_id",
    "genre_avg_rating": "SELECT genre, avg_rating, rating_count FROM genre_avg",
    "genre_user_count": "SELECT genre, user_id, rating_count FROM genre_user",
    "genre_avg_rating_stream": "SELECT genre, avg_rating, rating_count FROM genre_avg",
    "dataset_counts": """
        SELECT count(*) AS n_ratings, count(DISTINCT user_id) AS n_users, count(DISTINCT movie_id) AS n_movies
        FROM ratings""",
    "genre_top5_movies": f"""
        SELECT genre, "rank", movie_id, title, rating_count FROM (
          SELECT *, CAST(row_number() OVER (PARTITION BY genre ORDER BY rating_count DESC, movie_id) AS INTEGER) AS "rank"
          FROM ({_GENRE_MOVIE_COUNTS}))
        WHERE "rank" <= 5""",
    "genre_movie_list": _GENRE_MOVIE_COUNTS,
    "genre_movie_pages": _PAGES.format(1000),
    "genre_movie_pages_short": _PAGES.format(3),
    "genre_top5_users": 'SELECT genre, "rank", user_id, rating_count FROM genre_top_users',
    "genre_top5_users_total": f'SELECT genre, "rank", user_id, total_ratings FROM ({_PROFILE})',
    "genre_top5_users_genre_avg": f'SELECT genre, "rank", user_id, genre_avg_rating FROM ({_PROFILE})',
    "genre_top5_users_dataset_avg": f'SELECT genre, "rank", user_id, dataset_avg_rating FROM ({_PROFILE})',
    "genre_top5_profile": _PROFILE,
    "map_sort_by_value": """
        SELECT genre, "rank" AS position, user_id, rating_count FROM genre_top_users""",
    "matrix_shape": "SELECT count(DISTINCT user_id) AS num_rows, max(movie_id) + 1 AS num_cols FROM ratings",
    "movie_column_stats": _COLUMN_STATS,
    "movie_column_stats_blocked": _COLUMN_STATS,
    "popular_movies": _POPULAR.format(300),
    "popular_movies_dense": _POPULAR.format(480),
    "unrated_movies": "SELECT movie_id, title FROM unrated",
    "co_rated_pairs": "SELECT user_id, own_id, pred_id, own_rating, pred_rating FROM pairs",
    "adjusted_cosine": "SELECT own_id, pred_id, co_raters, similarity FROM sims",
    "knn_predictions": """
        SELECT k.movie_id, u.title, k.prediction FROM knn k LEFT JOIN unrated u ON u.movie_id = k.movie_id""",
    "top50_predicted": """
        SELECT k.movie_id, u.title, k.prediction FROM knn k JOIN unrated u ON u.movie_id = k.movie_id
        ORDER BY k.prediction DESC, k.movie_id LIMIT 50""",
    "top50_predicted_with_own": """
        SELECT k.movie_id, u.title, k.prediction FROM knn k LEFT JOIN unrated u ON u.movie_id = k.movie_id
        ORDER BY k.prediction DESC, k.movie_id LIMIT 50""",
    "split_counts": "SELECT split, count(*) AS n FROM split GROUP BY split",
    "als_half_step": _ROUNDED.format("user_id", _USER_FACTORS),
    "als_half_step_movies": _ROUNDED.format("movie_id", _solved("movie_id", "user_id", f"({_USER_FACTORS})")),
    "als_training_set": "SELECT user_id, movie_id, rating FROM training",
    "als_scorable_counts": """
        SELECT split, count(*) AS n_split,
               count(*) FILTER (WHERE user_id IN (SELECT user_id FROM training)
                                  AND movie_id IN (SELECT movie_id FROM training)) AS n_scorable
        FROM part_split WHERE split <> 'training' GROUP BY split""",
    "user_mean_error": """
        SELECT split, n_split, n_predicted, round(sse, 6) AS sse, round(sse / n_predicted, 6) AS mse,
               round(sqrt(sse / n_predicted), 6) AS rmse, round(sse / n_split, 6) AS mse_ref
        FROM (SELECT s.split, count(*) AS n_split, count(u.user_id) AS n_predicted,
                     sum((s.rating - u.m) * (s.rating - u.m)) AS sse
              FROM part_split s LEFT JOIN (SELECT user_id, avg(rating) AS m FROM training GROUP BY user_id) u
                ON u.user_id = s.user_id
              WHERE s.split <> 'training' GROUP BY s.split)""",
}


def oracle_sql() -> dict[str, str]:
    """Key -> complete DuckDB statement (fixture CTE + body)."""
    return {k: FIXTURE_CTE + body for k, body in _BODIES.items()}
