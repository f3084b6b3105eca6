"""The registered queries as plain SQL, for an independent check of their results."""

from __future__ import annotations

from tastegraph.functions.columns import GENRES
from tastegraph.operators.encode import NUMERIC_FEATURES
from tastegraph.operators.walks import METAPATHS

_words = "[" + ", ".join(f"'{g}'" for g in GENRES) + "]"
_n = len(GENRES)

RATINGS = """ratings AS (
  SELECT "userId", "movieId", rating, timestamp FROM (
    SELECT o_custkey AS "userId", l_partkey AS "movieId",
           CAST(0.5 + 0.5 * (CAST(l_quantity AS INT) % 10) AS DOUBLE) AS rating,
           CAST(epoch(o_orderdate) AS BIGINT) AS timestamp,
           row_number() OVER (PARTITION BY o_custkey, l_partkey ORDER BY o_orderdate DESC, l_quantity DESC) AS rn
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey) WHERE rn = 1)"""

MOVIES = f"""movies AS (
  SELECT p_partkey AS "movieId",
         CASE WHEN p_partkey % 50 = 49 THEN p_name
              ELSE p_name || ' (' || CAST(1960 + p_partkey % 60 AS VARCHAR) || ')' END AS title,
         array_to_string(list_slice([{_words}[p_size % {_n} + 1],
                                     {_words}[CAST(floor(p_retailprice) AS BIGINT) % {_n} + 1],
                                     {_words}[p_partkey % {_n} + 1]], 1, 1 + p_partkey % 3), '|') AS genres
  FROM part)"""

RECORDS = """records AS (
  SELECT CAST("movieId" AS VARCHAR) AS movie_id, CAST("userId" AS VARCHAR) AS user_id, rating AS user_rating,
         CAST("userId" % 2 AS INT) AS user_gender, CAST(c_nationkey AS VARCHAR) AS user_zip_code,
         c_mktsegment AS user_occupation_text, CAST(10 * ("userId" % 6) AS INT) AS bucketized_user_age
  FROM ratings JOIN customer ON "userId" = c_custkey)"""

YEAR = """CASE WHEN length(trim(title)) >= 6
  THEN coalesce(TRY_CAST(substr(trim(title), length(trim(title)) - 4, 4) AS INT), 1990) ELSE 1990 END"""

PROFILE = f"""profile AS (
  SELECT "movieId", {YEAR} AS "releaseYear", string_split(genres, '|') AS gl FROM movies)"""


def _r(x: str, digits: int = 2) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(28,10)), {digits}) AS DOUBLE)"


def _with(*ctes: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(ctes) + "\n"


def _movie_rolling(history: int) -> str:
    return f"""movie_rolling AS (
  SELECT "movieId", "userId", rating, timestamp, CASE WHEN rating >= 3.5 THEN 1 ELSE 0 END AS label,
         count(*) OVER w AS "movieRatingCount",
         coalesce({_r('avg(rating) OVER w')}, 0.0) AS "movieAvgRating",
         coalesce({_r('stddev_samp(rating) OVER w')}, 0.0) AS "movieRatingStddev"
  FROM ratings
  WINDOW w AS (PARTITION BY "movieId" ORDER BY timestamp, "userId" ROWS BETWEEN {history} PRECEDING AND 1 PRECEDING))"""


def _pivot(source: str, value: str, name: str) -> str:
    """The first five values of each row's list as columns."""
    columns = ", ".join(f"""max(CASE WHEN place = {i} THEN {value} END) AS "{name}{i}" """ for i in range(1, 6))
    return f"""(SELECT "userId", k, {columns} FROM {source} WHERE place <= 5 GROUP BY "userId", k)"""


def _user_rolling(source: str, history: int, extra: str) -> str:
    listed = lambda name: ", ".join(f'"{name}{i}"' for i in range(1, 6))
    return f"""joined AS MATERIALIZED (
  SELECT s.*, "releaseYear", gl[1] AS "movieGenre1", gl[2] AS "movieGenre2", gl[3] AS "movieGenre3", gl,
         row_number() OVER (PARTITION BY "userId" ORDER BY timestamp, "movieId") AS k
  FROM {source} s LEFT JOIN profile USING ("movieId")),
seen AS MATERIALIZED (
  SELECT * EXCLUDE (gl),
         count(*) OVER w AS "userRatingCount",
         CAST(floor(avg("releaseYear") OVER w) AS INT) AS "userAvgReleaseYear",
         {_r('stddev_samp("releaseYear") OVER w')} AS "userReleaseYearStddev",
         {_r('avg(rating) OVER w')} AS "userAvgRating",
         {_r('stddev_samp(rating) OVER w')} AS "userRatingStddev"
  FROM joined
  WINDOW w AS (PARTITION BY "userId" ORDER BY k ROWS BETWEEN {history} PRECEDING AND 1 PRECEDING)),
liked AS MATERIALIZED (
  SELECT s."userId", s.k, l.k AS seat, l."movieId" AS m, l.gl FROM joined s
  JOIN joined l ON l."userId" = s."userId" AND l.k BETWEEN s.k - {history} AND s.k - 1 WHERE l.label = 1),
last_liked AS (SELECT "userId", k, m, row_number() OVER (PARTITION BY "userId", k ORDER BY seat DESC) AS place FROM liked),
tagged AS (SELECT "userId", k, seat * 10 + i AS seat, gl[i] AS g FROM liked, (VALUES (1), (2), (3)) AS t(i) WHERE gl[i] IS NOT NULL),
counted AS (SELECT "userId", k, g, count(*) AS n, min(seat) AS f FROM tagged GROUP BY "userId", k, g),
favoured AS (SELECT "userId", k, g, row_number() OVER (PARTITION BY "userId", k ORDER BY n DESC, f) AS place FROM counted),
fer AS (
  SELECT seen."movieId", seen."userId", rating, timestamp, label, {extra}
         "releaseYear", "movieGenre1", "movieGenre2", "movieGenre3", {listed('userRatedMovie')},
         "userRatingCount", "userAvgReleaseYear", "userReleaseYearStddev", "userAvgRating", "userRatingStddev", {listed('userGenre')}
  FROM seen LEFT JOIN {_pivot('last_liked', 'm', 'userRatedMovie')} USING ("userId", k)
  LEFT JOIN {_pivot('favoured', 'g', 'userGenre')} USING ("userId", k) WHERE "userRatingCount" > 1)"""


def _fer(history: int = 100) -> tuple[str, ...]:
    movie_columns = '"movieRatingCount", "movieAvgRating", "movieRatingStddev",'
    return RATINGS, MOVIES, PROFILE, _movie_rolling(history), _user_rolling("movie_rolling", history, movie_columns)


def _unit(*keys: str, seed: int = 42) -> str:
    return f"(CAST('0x' || substr(md5(concat_ws(':', '{seed}', {', '.join(keys)})), 1, 8) AS BIGINT) / 4294967296.0)"


def _draw(*parts: str) -> str:
    return f"CAST('0x' || substr(md5(concat_ws(':', {', '.join(parts)})), 1, 15) AS BIGINT)"


PAIRS = """consecutive AS (
  SELECT "userId", src, "movieId" AS dst FROM (
    SELECT "userId", "movieId", lag("movieId") OVER (PARTITION BY "userId" ORDER BY timestamp, "movieId") AS src
    FROM ratings WHERE rating >= 3.5) WHERE src IS NOT NULL),
edges AS (SELECT src, dst, count(*) AS cnt FROM consecutive GROUP BY src, dst)"""

NORMS = """norms AS (SELECT "movieId", sum(rating * rating) AS "itemNorm" FROM ratings GROUP BY "movieId")"""


def _cosines(min_cos: float, source: str = "ratings") -> str:
    return f"""item_norm AS (SELECT "movieId", sum(rating * rating) AS n FROM {source} GROUP BY "movieId"),
pair_sums AS (
  SELECT a."movieId" AS "movieIdHead", b."movieId" AS "movieIdTail", sum(a.rating * b.rating) AS product
  FROM {source} a JOIN {source} b ON a."userId" = b."userId" AND a."movieId" < b."movieId" GROUP BY ALL),
cosines AS (
  SELECT "movieIdHead", "movieIdTail", product, product / (sqrt(h.n) * sqrt(t.n)) AS cos
  FROM pair_sums JOIN item_norm h ON h."movieId" = "movieIdHead" JOIN item_norm t ON t."movieId" = "movieIdTail"
  WHERE round(product / (sqrt(h.n) * sqrt(t.n)), 6) >= {min_cos}),
both_ways AS (
  SELECT "movieIdHead" AS "movieId", "movieIdTail", cos FROM cosines
  UNION ALL SELECT "movieIdTail", "movieIdHead", cos FROM cosines)"""


TYPED = """item_rows AS (
  SELECT 'movieId:' || src AS src, 'item' AS src_type, 'movieId:' || dst AS dst, 'item' AS dst_type FROM consecutive)"""

META = """user_rows AS (
  SELECT 'userId:' || "userId" AS src, 'user' AS src_type, 'movieId:' || "movieId" AS dst, 'item' AS dst_type
  FROM ratings WHERE rating >= 3.5),
genre_rows AS (
  SELECT 'movieId:' || "movieId" AS src, 'item' AS src_type, 'genre:' || unnest(string_split(genres, '|')) AS dst,
         'genre' AS dst_type
  FROM movies WHERE "movieId" IN (SELECT "movieId" FROM ratings)),
graph_rows AS (
  SELECT * FROM item_rows UNION ALL SELECT * FROM user_rows UNION ALL SELECT * FROM genre_rows
  UNION ALL SELECT dst, dst_type, src, src_type FROM user_rows
  UNION ALL SELECT dst, dst_type, src, src_type FROM genre_rows),
meta AS (SELECT src, src_type, dst, dst_type, count(*) AS cnt FROM graph_rows GROUP BY ALL)"""


def _walks(source: str, paths: list[tuple[str, int]], seed: int = 42) -> str:
    listed = ", ".join(f"({i}, '{path}', {n})" for i, (path, n) in enumerate(paths))
    kind = "CASE substr(path, step + 2, 1) WHEN 'i' THEN 'item' WHEN 'u' THEN 'user' ELSE 'genre' END"
    return f"""numbered AS (
  SELECT src, src_type, dst_type, dst, row_number() OVER (PARTITION BY src, dst_type ORDER BY dst) - 1 AS pos
  FROM {source}),
sizes AS (SELECT src, dst_type, count(*) AS tot FROM {source} GROUP BY src, dst_type),
places AS (
  SELECT src_type, src, row_number() OVER (PARTITION BY src_type ORDER BY src, dst) - 1 AS place
  FROM {source} WHERE dst_type = 'item' AND src_type IN ('item', 'user')),
place_totals AS (SELECT src_type, count(*) AS tot FROM places GROUP BY src_type),
paths(path_id, path, n) AS (VALUES {listed}),
starts AS (
  SELECT path_id, path, walk, src AS node FROM (
    SELECT path_id, path, walk, src_type,
           {_draw(f"'{seed}'", 'path_id', 'walk', '0')} % tot AS place
    FROM (SELECT path_id, path, unnest(range(n)) AS walk,
                 CASE WHEN path[1] = 'i' THEN 'item' ELSE 'user' END AS src_type FROM paths)
    JOIN place_totals USING (src_type)) JOIN places USING (src_type, place)),
walked AS (
  SELECT path_id, path, walk, 0 AS step, node FROM starts
  UNION ALL
  SELECT w.path_id, w.path, w.walk, w.step + 1, e.dst
  FROM walked w
  JOIN sizes s ON s.src = w.node AND s.dst_type = {kind.replace('path', 'w.path', 1).replace('step', 'w.step')}
  JOIN numbered e ON e.src = w.node AND e.dst_type = s.dst_type
   AND e.pos = {_draw(f"'{seed}'", 'w.path_id', 'w.walk', 'w.step + 1')} % s.tot
  WHERE w.step + 1 < length(w.path))"""


_item_walks = _with(RATINGS, PAIRS, TYPED, _walks("item_rows", [("i" * 10, 20_000)]), recursive=True)
_meta_walks = _with(RATINGS, MOVIES, PAIRS, TYPED, META, _walks("graph_rows", METAPATHS), recursive=True)

GENRE_CODES = """genre_rows AS (SELECT "movieId", unnest(string_split(genres, '|')) AS genre FROM movies),
codes AS (
  SELECT genre AS value, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, genre) - 1 AS code
  FROM genre_rows GROUP BY genre)"""

_genre_columns = [f"userGenre{i}" for i in range(1, 6)] + [f"movieGenre{i}" for i in range(1, 4)]
_text_columns = [*_genre_columns]
_number_columns = [f"userRatedMovie{i}" for i in range(1, 6)]
_printed = ["movieAvgRating", "movieRatingStddev", "userReleaseYearStddev", "userAvgRating", "userRatingStddev"]


def _vocabulary(source: str, features: list[str]) -> str:
    parts = " UNION ".join(f"SELECT '{f}' AS feature, CAST({f} AS VARCHAR) AS value FROM {source}" for f in features)
    return f"""words AS ({parts}),
vocab AS (SELECT feature, value, row_number() OVER (PARTITION BY feature ORDER BY value) AS code FROM words)"""


_curve = """grouped AS (SELECT s, sum(pos) AS pos, sum(neg) AS neg FROM (
  SELECT "userAvgRating" / 5 AS s, label AS pos, 1 - label AS neg FROM fer) GROUP BY s),
curve AS (
  SELECT s, pos, neg, coalesce(sum(pos) OVER above, 0) AS tp, coalesce(sum(neg) OVER above, 0) AS fp
  FROM grouped WINDOW above AS (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
points AS (
  SELECT *, (tp + pos) / CAST(tp + pos + fp + neg AS DOUBLE) AS prec,
         least(greatest(s, 1e-15), 1 - 1e-15) AS p FROM curve)"""


_near = """WITH n AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS e, sqrt(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS l
  FROM embeddings),
v AS (SELECT id, [x / l FOR x IN e] AS e FROM n WHERE l > 0),
near AS (SELECT * FROM (SELECT a.id AS low, b.id AS high, list_distance(a.e, b.e) AS distance FROM v a JOIN v b ON a.id < b.id) WHERE distance <= 1.0954)
"""

_classes = (
    RATINGS,
    """house AS (
  SELECT "userId", "movieId", rating FROM ratings UNION ALL
  SELECT -1, m, CAST(0.5 + 0.5 * (((m % 10) + 10) % 10) AS DOUBLE) FROM (
    SELECT p_partkey AS m FROM part UNION SELECT -(1 + l_orderkey * 8 + l_linenumber) FROM lineitem))""",
    """shares AS (SELECT "movieId", "userId", rating / max(rating) OVER (PARTITION BY "movieId") AS q FROM house)""",
    """directions AS (SELECT "movieId", list({'u': "userId", 'q': q} ORDER BY "userId") AS v FROM shares GROUP BY "movieId")""",
    """classes AS (SELECT "movieId", min("movieId") OVER (PARTITION BY v) AS "classId", count(*) OVER (PARTITION BY v) AS members FROM directions)""",
)


def oracle_sql() -> dict[str, str]:
    split_case = "CASE WHEN {u} < 0.8 THEN 'train' ELSE 'test' END"
    key = _unit('"userId"', '"movieId"')
    sql = {
        "read_ratings": _with(RATINGS) + "SELECT * FROM ratings",
        "read_movies": _with(MOVIES) + "SELECT * FROM movies",
        "read_samples": _with(*_fer()) + "SELECT * REPLACE ("
        + ", ".join([f"""coalesce("{c}", '') AS "{c}" """ for c in _text_columns] + [f'coalesce("{c}", 0) AS "{c}"' for c in _number_columns])
        + ") FROM fer",
        "read_user_item_records": _with(RATINGS, RECORDS) + "SELECT * FROM records",
        "write_samples": _with(*_fer()) + "SELECT label, count(*) AS n FROM fer GROUP BY label",
        "write_embeddings": """SELECT vec_id || ':' || array_to_string([
            CAST(floor(CAST(v AS DOUBLE) * 1024) / 1024 + 2 AS VARCHAR) FOR v IN embedding], ' ') AS line FROM embeddings""",
        "multi_hot_vectors": _with(MOVIES, GENRE_CODES) + """SELECT "movieId", array_to_string([
            CASE WHEN list_contains(own, k) THEN '1' ELSE '0' END FOR k IN range((SELECT count(*) FROM codes))], ' ') AS vector
            FROM (SELECT "movieId", list(code) AS own FROM genre_rows JOIN codes ON genre = value GROUP BY "movieId")""",
        **{name: _with(
            RATINGS.replace("ratings AS", "all_ratings AS", 1), MOVIES, PROFILE,
            """ratings AS (SELECT "userId", "movieId", timestamp,
              CASE WHEN ("userId" * 31 + "movieId") % 17 <> 0 THEN rating END AS rating FROM all_ratings)""",
            _movie_rolling(20), _user_rolling("movie_rolling", 20, '"movieRatingCount", "movieAvgRating", "movieRatingStddev",'),
        ) + """SELECT "userId", "movieId", "movieRatingCount", "movieAvgRating", "movieRatingStddev", "userRatingCount",
            "userAvgRating", "userRatingStddev" FROM fer""" for name in ("rolling_features_with_gaps", "rolling_features_with_gaps_split_keys")},
        "numeric_features": _with(*_fer()) + """SELECT "userId", "movieId", """
        + ", ".join(f"""CAST(coalesce("{c}", 0) AS DOUBLE) AS "{c}" """ for c in NUMERIC_FEATURES) + " FROM fer",
        "export_train_test": _with(*_fer(), f"tenth AS (SELECT * FROM fer WHERE {key} < 0.1)") + """SELECT "userId", "movieId", label, timestamp,
            "userRatingCount", CASE WHEN timestamp <= (SELECT min(timestamp) FROM (
              SELECT timestamp, sum(count(*)) OVER (ORDER BY timestamp) AS upto FROM tenth GROUP BY timestamp)
              WHERE upto >= (SELECT ceil(0.8 * count(*)) FROM tenth)) THEN 'train' ELSE 'test' END AS split FROM tenth""",
        "fer_samples": _with(*_fer()) + "SELECT * FROM fer",
        "fer_samples_short_history": _with(*_fer(20)) + "SELECT * FROM fer",
        "fer_samples_split_keys": _with(*_fer(20)) + "SELECT * FROM fer",
        "fer_samples_printed": _with(*_fer()) + "SELECT * REPLACE ("
        + ", ".join(f"""format('{{:,.2f}}', "{c}") AS "{c}" """ for c in _printed) + ") FROM fer",
        "positive_ratings": _with(RATINGS) + "SELECT * FROM ratings WHERE rating >= 3.5",
        "add_label": _with(RATINGS) + "SELECT *, CASE WHEN rating >= 3.5 THEN 1 ELSE 0 END AS label FROM ratings",
        "rating_distribution": _with(RATINGS)
        + "SELECT rating, count(*) AS count, count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM ratings) AS percentage FROM ratings GROUP BY rating",
        "movie_rating_stats": _with(RATINGS) + f"""SELECT "movieId", count(*) AS "ratingCount", {_r('avg(rating)', 6)} AS "avgRating",
            {_r('var_samp(rating)', 6)} AS "ratingVar", {_r('stddev_samp(rating)', 6)} AS "ratingStddev" FROM ratings GROUP BY "movieId" """,
        "latest_ratings": _with(RATINGS) + """SELECT "userId", "movieId", rating, timestamp FROM (
            SELECT "userId", CAST(replace(p_brand, 'Brand#', '') AS BIGINT) AS "movieId", rating, timestamp,
                   row_number() OVER (PARTITION BY "userId", p_brand ORDER BY timestamp DESC, rating DESC) AS rn
            FROM ratings JOIN part ON p_partkey = "movieId") WHERE rn = 1""",
        "movie_rolling_features": _with(RATINGS, _movie_rolling(100)) + "SELECT * FROM movie_rolling",
        "user_rolling_features": _with(
            RATINGS, MOVIES, PROFILE,
            "labelled AS (SELECT *, CASE WHEN rating >= 3.5 THEN 1 ELSE 0 END AS label FROM ratings)",
            _user_rolling("labelled", 100, ""),
        ) + "SELECT * FROM fer",
        "attach_movie_features": _with(RATINGS, MOVIES, PROFILE) + """SELECT ratings.*, "releaseYear", gl[1] AS "movieGenre1",
            gl[2] AS "movieGenre2", gl[3] AS "movieGenre3", array_to_string(gl, '|') AS "genreList"
            FROM ratings LEFT JOIN profile USING ("movieId")""",
        "release_year": _with(MOVIES) + f"""SELECT "movieId", title, {YEAR} AS "releaseYear" FROM movies""",
        "split_genres": _with(MOVIES, PROFILE)
        + """SELECT "movieId", gl[1] AS "movieGenre1", gl[2] AS "movieGenre2", gl[3] AS "movieGenre3" FROM profile""",
        "min_history_filter": _with(
            RATINGS, MOVIES, PROFILE,
            "labelled AS (SELECT *, CASE WHEN rating >= 3.5 THEN 1 ELSE 0 END AS label FROM ratings)",
            _user_rolling("labelled", 100, ""),
        ) + """SELECT "userRatingCount", count(*) AS n FROM fer WHERE "userRatingCount" >= 10 GROUP BY "userRatingCount" """,
        "user_timeline": _with(*_fer()) + """SELECT * FROM fer WHERE "userId" = (SELECT min("userId") FROM fer)""",
        "sample_fraction": _with(RATINGS) + f"SELECT * FROM ratings WHERE {key} < 0.1",
        "random_split": _with(RATINGS) + f"SELECT *, {split_case.format(u=key)} AS split FROM ratings",
        "random_split_three_ways": _with(RATINGS)
        + f"SELECT *, CASE WHEN {key} < 0.7 THEN 'train' WHEN {key} < 0.8 THEN 'valid' ELSE 'test' END AS split FROM ratings",
        "time_quantile": _with(RATINGS) + """SELECT min(timestamp) AS quantile FROM (
            SELECT timestamp, sum(count(*)) OVER (ORDER BY timestamp) AS upto FROM ratings GROUP BY timestamp)
            WHERE upto >= (SELECT ceil(0.8 * count(*)) FROM ratings)""",
        "time_quantile_sketch": _with(RATINGS) + """SELECT CAST(unnest([0.05, 0.2, 0.5, 0.8, 0.95]) AS DOUBLE) AS share, true AS within,
            (SELECT count(*) FROM ratings) AS rows, (SELECT count(DISTINCT year(to_timestamp(timestamp))) FROM ratings) AS parts""",
        "quantile_bucket_sketch": _with(RATINGS)
        + 'SELECT "movieId", count(*) AS "ratingCount", true AS within FROM ratings GROUP BY "movieId"',
        "time_split": _with(RATINGS) + """SELECT *, CASE WHEN timestamp <= (SELECT min(timestamp) FROM (
            SELECT timestamp, sum(count(*)) OVER (ORDER BY timestamp) AS upto FROM ratings GROUP BY timestamp)
            WHERE upto >= (SELECT ceil(0.8 * count(*)) FROM ratings)) THEN 'train' ELSE 'test' END AS split FROM ratings""",
        "seeded_shuffle_split": _with(RATINGS) + """SELECT * REPLACE (CASE WHEN place < 40000 THEN 'train' WHEN place < 50000 THEN 'test' ELSE 'rest' END AS split)
            FROM (SELECT *, row_number() OVER (ORDER BY md5(concat_ws(':', '42', "userId", "movieId"))) - 1 AS place, '' AS split
            FROM ratings)""",
        "cooccurring_pairs": _with(RATINGS, _cosines(0.2)) + 'SELECT "movieIdHead", "movieIdTail", product FROM cosines',
        "pair_product_sum": _with(RATINGS, _cosines(0.2))
        + f"""SELECT "movieIdHead", "movieIdTail", product, {_r('cos', 6)} AS cos FROM cosines""",
        "cosine": _with(RATINGS, NORMS) + f"""SELECT "movieId",
            {_r('"itemNorm" / (sqrt("itemNorm") * sqrt((SELECT max("itemNorm") FROM norms)))', 6)} AS cos FROM norms""",
        "item_norms": _with(RATINGS, NORMS) + "SELECT * FROM norms",
        "attach_norms": _with(RATINGS, PAIRS, NORMS) + """SELECT src AS "movieIdHead", dst AS "movieIdTail", cnt,
            h."itemNorm" AS "itemNormHead", t."itemNorm" AS "itemNormTail"
            FROM edges LEFT JOIN norms h ON h."movieId" = src LEFT JOIN norms t ON t."movieId" = dst""",
        "min_similarity_filter": _with(RATINGS, _cosines(0.2)) + f"""SELECT "movieIdHead", "movieIdTail", {_r('cos', 6)} AS cos FROM cosines""",
        "similar_items": _with(RATINGS, _cosines(0.2)) + f"""SELECT "movieId", "movieIdTail", {_r('cos', 6)} AS cos FROM both_ways""",
        "item_cf": _with(
            RATINGS, f"train AS (SELECT * FROM ratings WHERE {key} < 0.8)", _cosines(0.2, "train")
        ) + """SELECT "movieId", CAST(0 AS BIGINT) AS page, array_to_string(list_sort(list("movieIdTail" || ':' || format('{:.5f}', cos))), ' ') AS "simList"
            FROM both_ways GROUP BY "movieId" """,
        "movie_classes": _with(*_classes) + 'SELECT "movieId", "classId", members FROM classes',
        "similar_classes": _with(*_classes, "leaders AS (SELECT house.* FROM house JOIN classes USING (\"movieId\") WHERE \"movieId\" = \"classId\")",
                                 _cosines(0.2, "leaders"))
        + f"""SELECT "movieIdHead" AS "classHead", "movieIdTail" AS "classTail", {_r('cos', 6)} AS cos FROM cosines""",
        "user_sequences": _with(RATINGS) + """SELECT "userId", CAST(0 AS BIGINT) AS part,
            string_agg(CAST("movieId" AS VARCHAR), ' ' ORDER BY timestamp, "movieId") AS "movieIdStr"
            FROM ratings WHERE rating >= 3.5 GROUP BY "userId" """,
        "similar_items_pages": _with(RATINGS, _cosines(0.2)) + """SELECT "movieId", page, string_agg(CAST("movieIdTail" AS VARCHAR), ' ' ORDER BY k) AS similar
            FROM (SELECT *, (k - 1) // 3 AS page FROM (
              SELECT *, row_number() OVER (PARTITION BY "movieId" ORDER BY cos DESC, "movieIdTail") AS k FROM both_ways)) GROUP BY "movieId", page""",
        "user_sequences_parts": _with(RATINGS) + """SELECT "userId", part, string_agg(CAST("movieId" AS VARCHAR), ' ' ORDER BY k) AS "movieIdStr"
            FROM (SELECT *, (k - 1) // 4 AS part FROM (SELECT *, row_number() OVER (PARTITION BY "userId" ORDER BY timestamp, "movieId") AS k
            FROM ratings WHERE rating >= 3.5)) GROUP BY "userId", part""",
        "window_pairs": _with(RATINGS, """liked AS (
            SELECT "userId", "movieId", row_number() OVER (PARTITION BY "userId" ORDER BY timestamp, "movieId") AS k FROM ratings WHERE rating >= 3.5)""")
        + """SELECT a."movieId" AS src, b."movieId" AS dst, count(*) AS cnt FROM liked a JOIN liked b
            ON a."userId" = b."userId" AND a."movieId" <> b."movieId" AND abs(a.k - b.k) <= 5 GROUP BY ALL""",
        "consecutive_pairs": _with(RATINGS, PAIRS) + "SELECT * FROM consecutive",
        "edge_counts": _with(RATINGS, PAIRS) + "SELECT * FROM edges",
        "transition_probabilities": _with(RATINGS, PAIRS)
        + "SELECT src, dst, cnt, round(cnt / CAST(sum(cnt) OVER (PARTITION BY src) AS DOUBLE), 9) AS p FROM edges",
        "item_graph": _with(RATINGS, PAIRS) + """SELECT src, dst, cnt,
            round(cnt / CAST(sum(cnt) OVER (PARTITION BY src) AS DOUBLE), 9) AS p,
            round(sum(cnt) OVER (PARTITION BY src) / CAST(sum(cnt) OVER () AS DOUBLE), 9) AS share FROM edges""",
        "node_distribution": _with(RATINGS, PAIRS)
        + "SELECT src AS node, round(sum(cnt) / (SELECT CAST(sum(cnt) AS DOUBLE) FROM edges), 9) AS share FROM edges GROUP BY src",
        "user_distribution": _with(RATINGS) + """SELECT "userId", round(count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM ratings
            WHERE rating >= 3.5), 9) AS share FROM ratings WHERE rating >= 3.5 GROUP BY "userId" """,
        "rated_items": _with(RATINGS, MOVIES) + 'SELECT * FROM movies WHERE "movieId" IN (SELECT "movieId" FROM ratings)',
        "explode_genres": _with(MOVIES) + """SELECT "movieId", unnest(string_split(genres, '|')) AS genre FROM movies""",
        "typed_node_id": _with(MOVIES) + """SELECT "movieId", 'movieId:' || "movieId" AS node FROM movies""",
        "meta_edges": _with(RATINGS, MOVIES, PAIRS, TYPED, META) + "SELECT * FROM meta",
        "meta_transitions": _with(RATINGS, MOVIES, PAIRS, TYPED, META)
        + "SELECT *, round(cnt / CAST(sum(cnt) OVER (PARTITION BY src, dst_type) AS DOUBLE), 9) AS p FROM meta",
        "random_walks": _item_walks + "SELECT walk, step, node FROM walked",
        "metapath_walks": _meta_walks + "SELECT path_id, path, walk, step, node FROM walked",
        "metapath_mix": _meta_walks
        + "SELECT path, count(DISTINCT walk) AS walks, count(*) AS visits FROM walked GROUP BY path",
        "walk_corpus": _item_walks + "SELECT walk, string_agg(node, ' ' ORDER BY step) AS tokens FROM walked GROUP BY walk",
        "one_hot_ids": _with(MOVIES) + """SELECT "movieId", "movieId" AS "movieIdIndex",
            (SELECT max("movieId") + 1 FROM movies) AS "movieIdSize" FROM movies""",
        "string_index": _with(MOVIES, GENRE_CODES) + "SELECT * FROM codes",
        "string_index_large": _with(RATINGS) + """SELECT "userId" AS value, count(*) AS n,
            row_number() OVER (ORDER BY count(*) DESC, "userId") - 1 AS code FROM ratings GROUP BY "userId" """,
        "multi_hot_genres": _with(MOVIES, GENRE_CODES) + """SELECT "movieId",
            array_to_string(list_sort(list(DISTINCT code)), ' ') AS "genreIndexes", (SELECT count(*) FROM codes) AS "indexSize"
            FROM genre_rows JOIN codes ON genre = value GROUP BY "movieId" """,
        "min_max_scale": _with(RATINGS) + f"""SELECT "movieId", {_r('(a - min(a) OVER ()) / (max(a) OVER () - min(a) OVER ())', 6)}
            AS "scaleAvgRating" FROM (SELECT "movieId", avg(rating) AS a FROM ratings GROUP BY "movieId")""",
        "identity_bucket": _with(RATINGS) + """SELECT "userId", "movieId",
            CASE WHEN "movieId" BETWEEN 0 AND 1000 THEN CAST("movieId" AS INT) END AS "movieBucket",
            CASE WHEN "userId" BETWEEN 0 AND 30000 THEN CAST("userId" AS INT) END AS "userBucket" FROM ratings""",
        "vocabulary_lookup": _with(*_fer()) + """SELECT "userId", "movieId", """
        + ", ".join(f"""CAST(coalesce(list_position({_words}, "{c}"), 0) - 1 AS INT) AS "{c}Code" """ for c in _genre_columns) + " FROM fer",
        "vocabulary": _with(RATINGS, RECORDS, _vocabulary("records", [
            "movie_id", "user_id", "user_gender", "user_zip_code", "user_occupation_text", "bucketized_user_age"
        ])) + "SELECT * FROM vocab",
        "learned_vocabulary_lookup": _with(
            RATINGS, RECORDS, f"train AS (SELECT * FROM records WHERE {_unit('user_id', 'movie_id')} < 0.8)",
            _vocabulary("train", ["movie_id", "user_zip_code"]),
        ) + """SELECT user_id, movie_id, coalesce(m.code, 0) AS "movie_idCode", coalesce(z.code, 0) AS "user_zip_codeCode"
            FROM records LEFT JOIN vocab m ON m.feature = 'movie_id' AND m.value = movie_id
            LEFT JOIN vocab z ON z.feature = 'user_zip_code' AND z.value = user_zip_code""",
        "crossed_feature": _with(*_fer()) + f"""SELECT "userId", "movieId", "userRatedMovie1",
            CAST({_draw('"movieId"', '"userRatedMovie1"')} % 10000 AS INT) AS crossed FROM fer""",
        "embedding_cosine_topk": """WITH firsts AS (SELECT min(vec_id) AS vec_id FROM embeddings GROUP BY label),
            scored AS (SELECT q.vec_id AS query, e.vec_id AS id,
                list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])) AS c
              FROM embeddings q JOIN firsts USING (vec_id) JOIN embeddings e ON e.vec_id <> q.vec_id)
            SELECT query, id, round(c, 6) AS cos, CAST(rank AS INT) AS rank FROM (
              SELECT *, row_number() OVER (PARTITION BY query ORDER BY c DESC, id) AS rank FROM scored) WHERE rank <= 20""",
        "read_samples_with_rejects": _with(*_fer()) + """SELECT CASE WHEN "userId" % 50 = 0 THEN 'malformed'
            WHEN "userId" % 7 = 0 THEN 'no label' ELSE 'kept' END AS kind, count(*) AS n FROM fer GROUP BY 1""",
        "lsh_similarity_join": _near + "SELECT low, high, round(distance, 6) AS distance FROM near",
        "lsh_join_audit": _near + f""", asked AS (SELECT id FROM v ORDER BY {_draw("'audit'", 'id')}, id LIMIT 200)
            SELECT (SELECT count(DISTINCT e) FROM v) AS classes, true AS enough,
            (SELECT count(*) FROM near WHERE low IN (SELECT id FROM asked) OR high IN (SELECT id FROM asked)) AS true_pairs""",
        "largest_products": """WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
            scored AS (SELECT a.vec_id AS asker, b.vec_id AS item, list_inner_product(a.e, b.e) AS s FROM v a, v b)
            SELECT asker, CAST(rank AS INT) AS rank, item, round(s, 5) AS score FROM (
              SELECT *, row_number() OVER (PARTITION BY asker ORDER BY s DESC, item) AS rank FROM scored) WHERE rank <= 10""",
        "rmse": _with(*_fer())
        + """SELECT round(sqrt(avg(("movieAvgRating" - rating) * ("movieAvgRating" - rating))), 6) AS rmse FROM fer""",
        "first_ids": _with(RATINGS) + """SELECT DISTINCT CAST("userId" AS INT) AS "userId" FROM ratings ORDER BY 1 LIMIT 3""",
        "binary_metrics": _with(*_fer(), _curve) + """SELECT CAST(sum(pos + neg) AS BIGINT) AS n,
            round(sum(-(pos * ln(p) + neg * ln(1 - p))) / sum(pos + neg), 6) AS log_loss,
            round(sum(CASE WHEN s >= 0.5 THEN pos ELSE neg END) / CAST(sum(pos + neg) AS DOUBLE), 6) AS accuracy,
            round(sum(neg * (tp + pos / 2.0)) / (sum(pos) * CAST(sum(neg) AS DOUBLE)), 6) AS roc_auc,
            round(sum(pos * (prec + CASE WHEN tp + fp > 0 THEN tp / CAST(tp + fp AS DOUBLE) ELSE prec END) / 2) / sum(pos), 6) AS pr_auc
            FROM points""",
        "metric_summary": _with(*_fer()) + f"""SELECT "releaseYear", count(*) AS runs, {_r('avg("movieAvgRating")', 6)} AS mean,
            {_r('stddev_pop("movieAvgRating")', 6)} AS stdv FROM fer GROUP BY "releaseYear" """,
    }
    sql["similar_items_heavy"] = sql["similar_items"]
    sql["pair_product_sum_blocks"] = sql["pair_product_sum"]
    return sql
