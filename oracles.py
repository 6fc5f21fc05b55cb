"""DuckDB statements that compute each registered query in another way.

They use windows, dense user-by-user tables and plain joins on purpose, where the engine uses
pre-aggregated counts, co-rated pairs and closed forms, so that the shortcuts are checked too.
"""

from __future__ import annotations

# The parameters of the registered queries.
LO, HI = 1.0, 5.0
BASELINE = 1.35
PERSONAL_ID = 1000000
RAM = 4e9
K_VALUES = (10, 30, 50, 100, 200, 300, 400, 800, 943)

_HELD = "(user_id % 97 = 0 OR item_id % 89 = 0 OR (user_id * 31 + item_id * 17) % 5 = 0)"


def _scale(x: str, y: str) -> str:
    return f"CASE WHEN {x} > {y} THEN {HI} - {y} WHEN {x} < {y} THEN {y} - {LO} ELSE 1.0 END"


_RATINGS = """
ratings AS (
  SELECT u AS user_id, i AS item_id, CASE WHEN u % 101 = 50 THEN 3.0::DOUBLE ELSE r END AS rating
  FROM (SELECT o_custkey::INT AS u, l_partkey::INT AS i, MAX(1 + FLOOR((l_quantity - 1) / 10))::DOUBLE AS r
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)),
personal AS (
  SELECT 1000000::INT AS user_id, p_partkey::INT AS item_id, (1 + p_size % 5)::DOUBLE AS rating
  FROM part WHERE p_partkey % 37 = 5),
catalog AS (
  SELECT p_partkey::INT AS item_id,
         CASE WHEN p_partkey % 7 = 0 THEN concat(p_name, ', The') ELSE p_name END AS title FROM part)"""


def _normed(source: str) -> str:
    return f"""
avgs AS (SELECT user_id, AVG(rating) AS user_avg FROM {source} GROUP BY 1),
devs AS (SELECT s.user_id, s.item_id, (rating - user_avg) / ({_scale('rating', 'user_avg')}) AS dev
         FROM {source} s JOIN avgs a ON s.user_id = a.user_id),
normed AS (SELECT *, CASE WHEN norm <> 0 THEN dev / norm ELSE 0 END AS pre
           FROM (SELECT *, SQRT(SUM(dev * dev) OVER (PARTITION BY user_id)) AS norm,
                        COUNT(*) OVER (PARTITION BY user_id) AS n_items FROM devs))"""


_TRAIN = f"""{_RATINGS},
train AS (SELECT * FROM ratings WHERE NOT {_HELD}),
test AS (SELECT * FROM ratings WHERE {_HELD}),
{_normed('train')},
test_avg AS (SELECT t.user_id, t.item_id, t.rating, COALESCE(user_avg, (SELECT AVG(rating) FROM train)) AS user_avg
             FROM test t LEFT JOIN avgs a ON t.user_id = a.user_id)"""

_DAMAGED = f"""{_RATINGS},
damaged AS (SELECT *, (user_id * 7 + item_id) % 50 AS kind, rating::INT::VARCHAR AS r FROM ratings),
lines AS (SELECT kind, CASE WHEN kind = 7 THEN concat(user_id, chr(9), item_id)
                 ELSE concat(CASE WHEN kind = 5 THEN concat(user_id, '.5') ELSE user_id::VARCHAR END, chr(9),
                             CASE WHEN kind = 6 THEN '' ELSE item_id::VARCHAR END, chr(9),
                             CASE kind WHEN 1 THEN 'NaN' WHEN 2 THEN '99' WHEN 3 THEN '-3' WHEN 4 THEN 'four' ELSE r END) END AS line,
                 CASE WHEN kind BETWEEN 1 AND 3 THEN 'range' WHEN kind = 4 THEN 'rating' WHEN kind = 5 THEN 'user_id'
                      WHEN kind = 6 THEN 'item_id' WHEN kind = 7 THEN 'fields' END AS reason FROM damaged)"""

_BRANDS = f"""
brands AS (SELECT o_custkey::INT AS user_id, regexp_extract(p_brand, '([0-9]+)')::INT AS item_id,
                  MAX(1 + FLOOR((l_quantity - 1) / 10))::DOUBLE AS rating
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
{_normed('brands')},
users AS (SELECT DISTINCT user_id FROM brands),
sims AS (SELECT a.user_id AS u, b.user_id AS v, ROUND(SUM(a.pre * b.pre), 10) AS cosine, COUNT(*) AS overlap
         FROM normed a JOIN normed b ON a.item_id = b.item_id GROUP BY 1, 2)"""


def _moments(source: str) -> str:
    """Over every pair u <= v of users, by pairing them."""
    return f"""WITH source AS (FROM {source}), users AS (SELECT DISTINCT user_id FROM source),
common AS (SELECT a.user_id AS u, b.user_id AS v, COUNT(*) AS n FROM source a JOIN source b ON a.item_id = b.item_id GROUP BY 1, 2),
side AS (SELECT CASE WHEN (SELECT SUM(n * n) FROM (SELECT COUNT(*) AS n FROM source GROUP BY user_id))
                        < (SELECT SUM(n * n) FROM (SELECT COUNT(*) AS n FROM source GROUP BY item_id)) THEN 'items' ELSE 'users' END AS paired)
SELECT COUNT(*)::BIGINT AS pairs_all, ROUND(AVG(COALESCE(n, 0)), 6) AS avg_overlap, ROUND(STDDEV_POP(COALESCE(n, 0)), 6) AS stddev_overlap,
       (SELECT paired FROM side) AS paired
FROM users x JOIN users y ON x.user_id <= y.user_id LEFT JOIN common c ON c.u = x.user_id AND c.v = y.user_id"""


# All co-rated ordered pairs (both directions and the diagonal), without any triangle.
_PAIRS = f"""{_TRAIN},
matches AS (SELECT a.user_id AS u, b.user_id AS v, SUM(a.pre * b.pre) AS dot, COUNT(*) AS overlap,
                   MAX(a.n_items) AS n_u, MAX(b.n_items) AS n_v
            FROM normed a JOIN normed b ON a.item_id = b.item_id GROUP BY 1, 2),
sims AS (SELECT u, v, overlap, ROUND(dot, 10) AS cosine, ROUND(overlap / (n_u + n_v - overlap), 10) AS jaccard
         FROM matches)"""

# The same pairs from the raw ratings, item by item and as correlations.
_METRICS = f"""{_TRAIN},
sizes AS (SELECT user_id, SUM(rating) AS total, COUNT(*) AS n FROM train GROUP BY 1),
common AS (SELECT a.user_id AS u, b.user_id AS v, SUM(x.pre * y.pre) AS dot, COUNT(*) AS overlap,
                  SUM(LEAST(a.rating, b.rating)) AS smaller, CORR(a.rating, b.rating) AS corr,
                  VAR_POP(a.rating) AS va, VAR_POP(b.rating) AS vb
           FROM train a JOIN train b ON a.item_id = b.item_id
           JOIN normed x ON x.user_id = a.user_id AND x.item_id = a.item_id
           JOIN normed y ON y.user_id = b.user_id AND y.item_id = b.item_id GROUP BY 1, 2),
metrics AS (SELECT u, v, ROUND(dot, 10) AS cosine, ROUND(overlap / (s.n + t.n - overlap), 10) AS jaccard,
                   ROUND(smaller / (s.total + t.total - smaller), 10) AS weighted_jaccard,
                   CASE WHEN va > 1e-12 AND vb > 1e-12 THEN ROUND(corr, 10) ELSE 0 END AS pearson
            FROM common JOIN sizes s ON s.user_id = u JOIN sizes t ON t.user_id = v)"""

_WEIGHTED = f"""{_PAIRS},
weighted AS (
  SELECT t.user_id, t.item_id, t.rating, t.user_avg,
         SUM(cosine * dev) AS cn, SUM(ABS(cosine)) AS cd, SUM(jaccard * dev) AS jn, SUM(ABS(jaccard)) AS jd
  FROM test_avg t LEFT JOIN normed r ON r.item_id = t.item_id
  LEFT JOIN sims s ON s.u = t.user_id AND s.v = r.user_id
  GROUP BY 1, 2, 3, 4),
deviation AS (
  SELECT user_id, item_id, rating, user_avg,
         CASE WHEN cd <> 0 THEN cn / cd ELSE 0 END AS cw, CASE WHEN jd <> 0 THEN jn / jd ELSE 0 END AS jw
  FROM weighted),
predicted AS (
  SELECT user_id, item_id, rating,
         user_avg + cw * ({_scale('user_avg + cw', 'user_avg')}) AS cosine,
         user_avg + jw * ({_scale('user_avg + jw', 'user_avg')}) AS jaccard
  FROM deviation),
maes AS (SELECT AVG(ABS(rating - cosine)) AS c, AVG(ABS(rating - jaccard)) AS j, COUNT(*) AS n FROM predicted)"""

# Every pair u <= v of users, co-rated or not.
_ALL_PAIRS = f"""{_PAIRS},
users AS (SELECT DISTINCT user_id FROM train),
dense AS (SELECT COALESCE(overlap, 0) AS overlap, COALESCE(cosine, 0) AS cosine
          FROM users a JOIN users b ON a.user_id <= b.user_id
          LEFT JOIN sims s ON s.u = a.user_id AND s.v = b.user_id),
summary AS (SELECT COUNT(*)::BIGINT AS pairs_all, COUNT(*) FILTER (cosine <> 0)::BIGINT AS pairs_nonzero,
                   MIN(overlap)::DOUBLE AS mn, MAX(overlap)::DOUBLE AS mx, AVG(overlap) AS av, STDDEV_POP(overlap) AS sd
            FROM dense)"""

# Every other user of each user, ranked, zero similarities included.
_RANKED = f"""{_PAIRS},
users AS (SELECT DISTINCT user_id FROM train),
ranked AS (SELECT a.user_id AS u, b.user_id AS v, COALESCE(cosine, 0) AS sim,
                  ROW_NUMBER() OVER (PARTITION BY a.user_id ORDER BY COALESCE(cosine, 0) DESC, b.user_id) AS pos
           FROM users a JOIN users b ON a.user_id <> b.user_id
           LEFT JOIN sims s ON s.u = a.user_id AND s.v = b.user_id)"""

_SWEPT = f"""{_RANKED},
ks AS (SELECT UNNEST({list(K_VALUES)}) AS k),
neighbours AS (SELECT * FROM ranked WHERE pos <= {max(K_VALUES)} AND sim <> 0),
weighted AS (
  SELECT k, t.user_id, t.item_id, SUM(sim * dev) AS num, SUM(ABS(sim)) AS den
  FROM test t JOIN normed r ON r.item_id = t.item_id
  JOIN neighbours n ON n.u = t.user_id AND n.v = r.user_id
  JOIN ks ON pos <= k
  GROUP BY 1, 2, 3),
deviation AS (
  SELECT ks.k, t.user_id, t.item_id, rating, user_avg, COALESCE(CASE WHEN den <> 0 THEN num / den END, 0) AS w
  FROM test_avg t CROSS JOIN ks
  LEFT JOIN weighted x ON x.k = ks.k AND x.user_id = t.user_id AND x.item_id = t.item_id),
predicted AS (
  SELECT k, user_id, item_id, rating, w, user_avg + w * ({_scale('user_avg + w', 'user_avg')}) AS prediction
  FROM deviation),
sweep AS (SELECT k, AVG(ABS(rating - prediction)) AS mae FROM predicted GROUP BY 1),
chosen AS (SELECT MIN(k) AS min_k, ARG_MIN(mae, k) AS min_mae, ARG_MAX(k, mae) AS reference_k, MAX(mae) AS reference_mae
           FROM sweep WHERE mae < {BASELINE})"""

_RECOMMENDED = f"""{_RATINGS},
everyone AS (SELECT * FROM ratings UNION ALL SELECT * FROM personal),
{_normed('everyone')},
users AS (SELECT DISTINCT user_id FROM everyone),
dots AS (SELECT b.user_id AS v, ROUND(SUM(a.pre * b.pre), 10) AS sim
         FROM normed a JOIN normed b ON a.item_id = b.item_id
         WHERE a.user_id = {PERSONAL_ID} GROUP BY 1),
ranked AS (SELECT user_id AS v, COALESCE(sim, 0) AS sim,
                  ROW_NUMBER() OVER (ORDER BY COALESCE(sim, 0) DESC, user_id) AS pos
           FROM users LEFT JOIN dots ON v = user_id WHERE user_id <> {PERSONAL_ID}),
candidates AS (SELECT DISTINCT item_id FROM everyone EXCEPT SELECT item_id FROM personal),
ks AS (SELECT UNNEST([30, 300]) AS k),
weighted AS (SELECT k, item_id, SUM(sim * dev) AS num, SUM(ABS(sim)) AS den
             FROM normed JOIN ranked ON v = user_id JOIN ks ON pos <= k GROUP BY 1, 2),
deviation AS (SELECT ks.k, c.item_id, COALESCE(CASE WHEN den <> 0 THEN num / den END, 0) AS w,
                     (SELECT user_avg FROM avgs WHERE user_id = {PERSONAL_ID}) AS user_avg
              FROM candidates c CROSS JOIN ks LEFT JOIN weighted x ON x.k = ks.k AND x.item_id = c.item_id),
predicted AS (SELECT k, d.item_id, COALESCE(title, '') AS title,
                     ROUND(user_avg + w * ({_scale('user_avg + w', 'user_avg')}), 6) AS prediction
              FROM deviation d LEFT JOIN catalog c ON c.item_id = d.item_id),
best AS (SELECT k, ROW_NUMBER() OVER (PARTITION BY k ORDER BY prediction DESC, item_id)::INT AS position,
                item_id, title, prediction
         FROM predicted QUALIFY position <= 5)"""


def _rounded_again(similarity: str) -> str:
    """Six decimals of a similarity that is already rounded to ten, spelled out for the ties."""
    return f"FLOOR({similarity} * 1e6 + 0.5) / 1e6"


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select}"


def _knn_predicted(select: str) -> str:
    return _with(_SWEPT.replace(f"UNNEST({list(K_VALUES)})", "UNNEST([30])"), select)


ORACLES: dict[str, str] = {
    "ratings_scan": _with(_RATINGS, "SELECT * FROM ratings"),
    "ratings_with_duplicate_lines": _with(_RATINGS, "SELECT * FROM ratings"),
    "personal_scan": _with(_RATINGS, "SELECT * FROM personal"),
    "catalog_scan": _with(_RATINGS, "SELECT * FROM catalog"),
    "row_count_check": _with(
        _TRAIN,
        """SELECT *, n_rows = expected AS ok FROM (
             SELECT 'ratings' AS table_name, COUNT(*)::BIGINT AS n_rows,
                    (SELECT COUNT(DISTINCT (o_custkey, l_partkey)) FROM lineitem JOIN orders ON l_orderkey = o_orderkey)::BIGINT AS expected
             FROM ratings
             UNION ALL SELECT 'train', COUNT(*), (SELECT COUNT(*) FROM ratings) - (SELECT COUNT(*) FROM test) FROM train
             UNION ALL SELECT 'test', COUNT(*), (SELECT COUNT(*) FROM ratings) - (SELECT COUNT(*) FROM train) FROM test
             UNION ALL SELECT 'catalog', COUNT(*), (SELECT COUNT(*) FROM part) FROM catalog)""",
    ),
    "refused_lines": _with(_DAMAGED, "SELECT reason, line FROM lines WHERE reason IS NOT NULL"),
    "loaded_ratings": _with(_DAMAGED, "SELECT user_id, item_id, rating FROM damaged WHERE kind NOT BETWEEN 1 AND 7"),
    "load_counts": _with(
        _DAMAGED,
        """SELECT reason, (SELECT COUNT(*) FROM lines l WHERE COALESCE(l.reason, 'read') = r.reason)::BIGINT AS n_lines
           FROM (SELECT UNNEST(['read', 'fields', 'user_id', 'item_id', 'rating', 'range']) AS reason) r""",
    ),
    "hot_item_pair_summary": _with(
        _BRANDS,
        """SELECT COUNT(*)::BIGINT AS pairs_all, COUNT(*) FILTER (cosine <> 0)::BIGINT AS pairs_nonzero,
                  (8 * COUNT(*) FILTER (cosine <> 0))::BIGINT AS bytes_nonzero, MIN(COALESCE(overlap, 0))::DOUBLE AS min_overlap,
                  MAX(COALESCE(overlap, 0))::DOUBLE AS max_overlap, ROUND(AVG(COALESCE(overlap, 0)), 6) AS avg_overlap,
                  ROUND(STDDEV_POP(COALESCE(overlap, 0)), 6) AS stddev_overlap
           FROM users a JOIN users b ON a.user_id <= b.user_id LEFT JOIN sims s ON s.u = a.user_id AND s.v = b.user_id""",
    ),
    "hot_item_neighbours": _with(
        _BRANDS,
        f"""SELECT u, v, {_rounded_again('sim')} AS sim, pos::BIGINT AS pos FROM (
              SELECT a.user_id AS u, b.user_id AS v, COALESCE(cosine, 0) AS sim,
                     ROW_NUMBER() OVER (PARTITION BY a.user_id ORDER BY COALESCE(cosine, 0) DESC, b.user_id) AS pos
              FROM users a JOIN users b ON a.user_id <> b.user_id LEFT JOIN sims s ON s.u = a.user_id AND s.v = b.user_id)
            WHERE pos <= 5 AND sim <> 0""",
    ),
    "overlap_moments_few_items": _moments(f"(WITH {_BRANDS.strip()} SELECT user_id, item_id FROM brands)"),
    "overlap_moments_many_items": _moments(f"(WITH {_TRAIN.strip()} SELECT user_id, item_id FROM train)"),
    "report_json_roundtrip": _with(
        _WEIGHTED,
        "SELECT ROUND(c, 6) AS mae_cosine, ROUND(j, 6) AS mae_jaccard, ROUND(j - c, 6) AS difference FROM maes",
    ),
    "global_avg": _with(_TRAIN, "SELECT ROUND(AVG(rating), 6) AS global_avg FROM train"),
    "user_avg": _with(_TRAIN, "SELECT user_id, ROUND(user_avg, 6) AS user_avg FROM avgs"),
    "user_norm": _with(_TRAIN, "SELECT DISTINCT user_id, ROUND(norm, 6) AS norm FROM normed"),
    "user_stats_after_merge": _with(
        f"""{_RATINGS},
left_over AS (SELECT * FROM ratings WHERE item_id % 7 <> 0),
{_normed('left_over')}""",
        """SELECT user_id, ANY_VALUE(n_items)::BIGINT AS n_items, ROUND(ANY_VALUE(user_avg), 6) AS user_avg, ROUND(ANY_VALUE(norm), 6) AS norm
           FROM normed JOIN avgs USING (user_id) GROUP BY 1""",
    ),
    "global_deviation_avg": _with(_TRAIN, "SELECT ROUND(AVG(dev), 6) AS dev_avg FROM devs"),
    "scale_expr": _with(
        _TRAIN,
        f"""SELECT t.user_id, t.item_id, ROUND({_scale('rating', 'user_avg')}, 6) AS scale
            FROM train t JOIN avgs a ON t.user_id = a.user_id""",
    ),
    "normalized_deviation": _with(_TRAIN, "SELECT user_id, item_id, ROUND(dev, 6) AS dev FROM devs"),
    "preprocessed_ratings": _with(_TRAIN, "SELECT user_id, item_id, ROUND(pre, 6) AS pre FROM normed"),
    "test_with_user_avg": _with(
        _TRAIN, "SELECT user_id, item_id, rating, ROUND(user_avg, 6) AS user_avg FROM test_avg"
    ),
    "user_vectors": _with(
        _TRAIN, "SELECT user_id, item_id, ROUND(pre, 6) AS pre FROM normed"
    ),
    "item_raters": _with(
        _TRAIN, "SELECT item_id, user_id, ROUND(dev, 6) AS dev FROM normed"
    ),
    "cosine_similarity": _with(
        _PAIRS, f"SELECT u, v, {_rounded_again('cosine')} AS sim FROM sims WHERE u <= v AND cosine <> 0"
    ),
    "jaccard_similarity": _with(
        _PAIRS, f"SELECT u, v, {_rounded_again('jaccard')} AS sim FROM sims WHERE u <= v AND jaccard <> 0"
    ),
    "weighted_jaccard_similarity": _with(
        _METRICS, f"SELECT u, v, {_rounded_again('weighted_jaccard')} AS sim FROM metrics WHERE u <= v AND weighted_jaccard <> 0"
    ),
    "pearson_similarity": _with(
        _METRICS, f"SELECT u, v, {_rounded_again('pearson')} AS sim FROM metrics WHERE u <= v AND pearson <> 0"
    ),
    "similarities_by_metric": _with(
        _METRICS,
        f"""SELECT u, v, {_rounded_again('cosine')} AS cosine, {_rounded_again('weighted_jaccard')} AS weighted_jaccard,
                   {_rounded_again('pearson')} AS pearson
            FROM metrics WHERE u <= v AND (cosine <> 0 OR weighted_jaccard <> 0 OR pearson <> 0)""",
    ),
    "mae_by_metric": _with(
        _METRICS,
        f"""SELECT ROUND(MAX(mae) FILTER (metric = 'cosine'), 6) AS cosine, ROUND(MAX(mae) FILTER (metric = 'jaccard'), 6) AS jaccard,
                   ROUND(MAX(mae) FILTER (metric = 'weighted_jaccard'), 6) AS weighted_jaccard,
                   ROUND(MAX(mae) FILTER (metric = 'pearson'), 6) AS pearson, MAX(n)::BIGINT AS n
            FROM (SELECT metric, AVG(ABS(rating - (user_avg + w * ({_scale('user_avg + w', 'user_avg')})))) AS mae, COUNT(*) AS n
                  FROM (SELECT t.metric, t.user_id, t.item_id, t.rating, t.user_avg, COALESCE(SUM(s * dev) / NULLIF(SUM(ABS(s)), 0), 0) AS w
                        FROM (SELECT *, UNNEST(['cosine', 'jaccard', 'weighted_jaccard', 'pearson']) AS metric FROM test_avg) t
                        LEFT JOIN normed r ON r.item_id = t.item_id
                        LEFT JOIN (UNPIVOT metrics ON cosine, jaccard, weighted_jaccard, pearson INTO NAME metric VALUE s) m
                          ON m.u = t.user_id AND m.v = r.user_id AND m.metric = t.metric
                        GROUP BY ALL) GROUP BY metric)""",
    ),
    "similarity_pair_counts": _with(
        _ALL_PAIRS, "SELECT pairs_all, pairs_nonzero, (8 * pairs_nonzero)::BIGINT AS bytes_nonzero FROM summary"
    ),
    "overlap_stats": _with(
        _ALL_PAIRS,
        """SELECT mn AS min_overlap, mx AS max_overlap, ROUND(av, 6) AS avg_overlap, ROUND(sd, 6) AS stddev_overlap
           FROM summary""",
    ),
    "weighted_deviation": _with(_WEIGHTED, "SELECT user_id, item_id, ROUND(cw, 6) AS w FROM deviation"),
    "predict_cosine": _with(
        _WEIGHTED, "SELECT user_id, item_id, rating, ROUND(cosine, 6) AS prediction FROM predicted"
    ),
    "predict_jaccard": _with(
        _WEIGHTED, "SELECT user_id, item_id, rating, ROUND(jaccard, 6) AS prediction FROM predicted"
    ),
    "mae_cosine": _with(_WEIGHTED, "SELECT ROUND(c, 6) AS mae, n::BIGINT AS n FROM maes"),
    "mae_jaccard": _with(_WEIGHTED, "SELECT ROUND(j, 6) AS mae, n::BIGINT AS n FROM maes"),
    "mae_comparison": _with(
        _WEIGHTED,
        f"""SELECT 'cosine' AS metric, ROUND(c, 6) AS mae, ROUND(c - {BASELINE}, 6) AS minus_baseline,
                   0.0::DOUBLE AS minus_cosine FROM maes
            UNION ALL
            SELECT 'jaccard', ROUND(j, 6), ROUND(j - {BASELINE}, 6), ROUND(j - c, 6) FROM maes""",
    ),
    "summary_stats": """SELECT event_type, MIN(value) AS mn, MAX(value) AS mx, ROUND(AVG(value), 6) AS av,
                               ROUND(STDDEV_POP(value), 6) AS sd FROM events GROUP BY 1""",
    "run_rates": _with(
        _ALL_PAIRS,
        """SELECT ROUND(s / pairs_nonzero, 6) AS micros_per_pair, ROUND(s / p, 6) AS similarity_to_prediction
           FROM summary, (SELECT AVG(value) AS s FROM events WHERE event_type IN ('click', 'view')),
                (SELECT AVG(value) AS p FROM events WHERE event_type NOT IN ('click', 'view'))""",
    ),
    "similarity_report": _with(
        _ALL_PAIRS + _WEIGHTED.removeprefix(_PAIRS),
        f"""SELECT ROUND(c, 6) AS cosine_mae, ROUND(c - {BASELINE}, 6) AS cosine_minus_baseline,
                   ROUND(j, 6) AS jaccard_mae, ROUND(j - c, 6) AS jaccard_minus_cosine,
                   pairs_all AS similarity_computations, mn AS min_overlap, mx AS max_overlap,
                   ROUND(av, 6) AS avg_overlap, ROUND(sd, 6) AS stddev_overlap,
                   (8 * pairs_nonzero)::BIGINT AS bytes_nonzero
            FROM summary, maes""",
    ),
    "knn_k30": _with(
        _RANKED,
        f"SELECT u, v, {_rounded_again('sim')} AS sim, pos::BIGINT AS pos FROM ranked WHERE pos <= 30 AND sim <> 0",
    ),
    "knn_bounded_k30": _with(
        _RANKED,
        f"SELECT u, v, {_rounded_again('sim')} AS sim, pos::BIGINT AS pos FROM ranked WHERE pos <= 30 AND sim <> 0",
    ),
    "knn_weighted_deviation": _knn_predicted("SELECT user_id, item_id, ROUND(w, 6) AS w FROM predicted"),
    "predict_knn_k30": _knn_predicted(
        "SELECT user_id, item_id, rating, ROUND(prediction, 6) AS prediction FROM predicted"
    ),
    "knn_mae_sweep": _with(_SWEPT, "SELECT k::INT AS k, ROUND(mae, 6) AS mae FROM sweep"),
    # Every test row at every k, summed up over all k below.
    "knn_mae_every_k": _with(
        f"""{_RANKED},
at_k AS (SELECT t.user_id, t.item_id, n.pos AS k, SUM(sim * dev) AS num, SUM(ABS(sim)) AS den
         FROM test t JOIN normed r ON r.item_id = t.item_id JOIN ranked n ON n.u = t.user_id AND n.v = r.user_id
         WHERE pos <= {max(K_VALUES)} GROUP BY 1, 2, 3),
summed AS (SELECT k, rating, user_avg, SUM(COALESCE(num, 0)) OVER w AS num, SUM(COALESCE(den, 0)) OVER w AS den
           FROM (SELECT k, t.* FROM test_avg t, range(1, {max(K_VALUES) + 1}) r(k)) t LEFT JOIN at_k a USING (user_id, item_id, k)
           WINDOW w AS (PARTITION BY user_id, item_id ORDER BY k)),
deviation AS (SELECT k, rating, user_avg, CASE WHEN den <> 0 THEN num / den ELSE 0 END AS w FROM summed)""",
        f"""SELECT k::INT AS k, ROUND(AVG(ABS(rating - (user_avg + w * ({_scale('user_avg + w', 'user_avg')})))), 6) AS mae
            FROM deviation GROUP BY k""",
    ),
    "lowest_k": _with(
        _SWEPT,
        f"""SELECT min_k::INT AS min_k, ROUND(min_mae - {BASELINE}, 6) AS min_k_minus_baseline,
                   reference_k::INT AS reference_k, ROUND(reference_mae - {BASELINE}, 6) AS reference_k_minus_baseline
            FROM chosen""",
    ),
    "knn_storage": _with(
        _TRAIN,
        f"""SELECT k::INT AS k, (n * LEAST(k, n - 1))::BIGINT AS neighbours, (8 * n * LEAST(k, n - 1))::BIGINT AS bytes
            FROM (SELECT UNNEST({list(K_VALUES)}) AS k), (SELECT COUNT(DISTINCT user_id) AS n FROM train)""",
    ),
    "ram_capacity": _with(
        _SWEPT,
        f"""SELECT {RAM}::DOUBLE AS ram_bytes, reference_k::INT AS k,
                   ROUND({RAM}::DOUBLE / (reference_k * 24), 6) AS users_fit,
                   ROUND({RAM}::DOUBLE / reference_k * 3 * 8, 6) AS users_fit_reference
            FROM chosen""",
    ),
    "knn_report": _with(
        _SWEPT,
        f"""SELECT s.k::INT AS k, ROUND(mae, 6) AS mae, (8 * n * LEAST(s.k, n - 1))::BIGINT AS bytes,
                   reference_k::INT AS lowest_k, ROUND(reference_mae - {BASELINE}, 6) AS lowest_k_minus_baseline,
                   {RAM}::DOUBLE AS ram_bytes, ROUND({RAM}::DOUBLE / (reference_k * 24), 6) AS users_fit,
                   ROUND({RAM}::DOUBLE / reference_k * 3 * 8, 6) AS users_fit_reference
            FROM sweep s, chosen, (SELECT COUNT(*) AS n FROM users)""",
    ),
    "ratings_with_personal": _with(_RATINGS, "SELECT * FROM ratings UNION ALL SELECT * FROM personal"),
    "rated_items": _with(_RATINGS, "SELECT item_id FROM personal"),
    "unrated_items": _with(_RATINGS, "SELECT item_id FROM ratings EXCEPT SELECT item_id FROM personal"),
    "recommend_top5_k30": _with(_RECOMMENDED, "SELECT item_id, title, prediction FROM best WHERE k = 30"),
    "recommend_top5_k300": _with(_RECOMMENDED, "SELECT item_id, title, prediction FROM best WHERE k = 300"),
    "recommend_exact_max": _with(
        _RECOMMENDED,
        f"""SELECT item_id, title, prediction FROM predicted WHERE k = 30 AND prediction = {HI}
            ORDER BY item_id LIMIT 5""",
    ),
    "recommend_with_fitted_statistics": _with(
        _RECOMMENDED, "SELECT k::INT AS k, position, item_id, title, prediction FROM best"
    ),
    "recommend_report": _with(_RECOMMENDED, "SELECT k::INT AS k, position, item_id, title, prediction FROM best"),
}
