"""SQL for a second engine: one text per registered query that SQL can express."""

from __future__ import annotations

from tastemill.functions.hashing import MINHASH_PRIME, minhash_coefficients

INTER = """inter AS (
  SELECT CAST(o_custkey AS INTEGER) AS user_id, CAST(l_partkey AS INTEGER) AS item_id,
         CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS is_read,
         CAST(CASE WHEN l_linenumber <= 5 THEN l_linenumber ELSE 0 END AS FLOAT) AS rating,
         CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS is_reviewed,
         md5(CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_partkey AS VARCHAR) || '|' ||
             CAST(l_linenumber AS VARCHAR) || '|' || CAST(l_suppkey AS VARCHAR)) AS row_key
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

SPLIT = INTER + """, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY row_key) AS rn,
         count(*) OVER (PARTITION BY user_id) AS n
  FROM inter), dealt AS (
  SELECT user_id, item_id, is_read, rating, is_reviewed, row_key,
         CASE WHEN rn <= CAST(0.6 AS DOUBLE) * n THEN 'train'
              WHEN rn <= CAST(0.8 AS DOUBLE) * n THEN 'validation' ELSE 'test' END AS split
  FROM ranked WHERE n >= 5), train AS (SELECT * FROM dealt WHERE split = 'train')"""

LABELS = """labels_long AS (
  SELECT DISTINCT user_id, item_id, split, 'read' AS label FROM dealt
  WHERE split <> 'train' AND is_read = 1
  UNION ALL
  SELECT DISTINCT user_id, item_id, split, 'liked' AS label FROM dealt
  WHERE split <> 'train' AND rating >= 4)"""

COHORT = """cohort AS (
  SELECT DISTINCT user_id, 'read' AS label FROM train
  UNION ALL
  SELECT DISTINCT user_id, 'liked' AS label FROM train WHERE rating > 0)"""

TOP = """counts AS (
  SELECT item_id, count(*) AS read_count FROM train WHERE is_read = 1 GROUP BY item_id), top AS (
  SELECT item_id, read_count,
         CAST(row_number() OVER (ORDER BY read_count DESC, item_id) AS INTEGER) AS pop_rank
  FROM counts QUALIFY pop_rank <= 1000)"""


def recs_sql(pool: int, name: str = "recs", k: int = 100) -> str:
    """Rank among the unseen pool items = pool rank less the seen items ranked above."""
    return f"""{name} AS (
  SELECT user_id, item_id,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY pop_rank) AS INTEGER) AS "rank"
  FROM (SELECT DISTINCT user_id FROM train) u CROSS JOIN (SELECT * FROM top WHERE pop_rank <= {pool}) t
  WHERE NOT EXISTS (SELECT 1 FROM train s WHERE s.user_id = u.user_id AND s.item_id = t.item_id)
  QUALIFY "rank" <= {k})"""


def metrics_sql(recs: str = "recs", out: str = "metrics", k: int = 100, zero: bool = False) -> str:
    """Means per split and label; users without a list are left out, or score 0."""
    listed = "true" if zero else f"l.user_id IN (SELECT user_id FROM {recs})"
    return f"""{out}_sizes AS (
  SELECT l.user_id, l.split, l.label, count(*) AS n_labels FROM labels_long l
  JOIN cohort c ON c.user_id = l.user_id AND c.label = l.label
  WHERE {listed} GROUP BY ALL), {out}_hits AS (
  SELECT l.user_id, l.split, l.label, r."rank",
         row_number() OVER (PARTITION BY l.user_id, l.split, l.label ORDER BY r."rank") AS pos
  FROM labels_long l JOIN {recs} r ON r.user_id = l.user_id AND r.item_id = l.item_id), {out}_users AS (
  SELECT s.user_id, s.split, s.label, s.n_labels,
         coalesce(sum(h.pos / CAST(h."rank" AS DOUBLE)), 0) AS psum,
         coalesce(sum(1 / log2(h."rank" + 1)), 0) AS dcg, count(h."rank") AS hits,
         (SELECT sum(1 / log2(i + 1)) FROM range(1, {k + 1}) t(i) WHERE i <= s.n_labels) AS idcg
  FROM {out}_sizes s LEFT JOIN {out}_hits h
    ON h.user_id = s.user_id AND h.split = s.split AND h.label = s.label
  GROUP BY s.user_id, s.split, s.label, s.n_labels), {out} AS (
  SELECT split, label, count(*) AS users, avg(psum / n_labels) AS map, avg(dcg / idcg) AS ndcg_at_k,
         avg(hits / {k}.0::DOUBLE) AS precision_at_k, avg(hits / CAST(n_labels AS DOUBLE)) AS recall_at_k
  FROM {out}_users GROUP BY split, label)"""


ROUNDED = """split, label, users, round(map, 6) AS map, round(ndcg_at_k, 6) AS ndcg_at_k,
  round(precision_at_k, 6) AS precision_at_k, round(recall_at_k, 6) AS recall_at_k"""

POPULARITY = f"WITH {SPLIT}, {LABELS}, {COHORT}, {TOP}, {recs_sql(1000)}, {metrics_sql()}"

# The 64-bit hash of one int32, in 128-bit unsigned arithmetic; the primes and the seed 42 are fixed values.
M64 = "18446744073709551616::UHUGEINT"
XXHASH_INT = f"""xa AS (
  SELECT DISTINCT user_id,
    xor((42 + 2870177450012600261 + 4)::UHUGEINT,
        (user_id::UHUGEINT * 11400714785074694791::UHUGEINT) % {M64}) AS h FROM inter), xb AS (
  SELECT user_id, (((h * 8388608) % {M64} + h // 2199023255552)
    * 14029467366897019727::UHUGEINT % {M64} + 1609587929392839161::UHUGEINT) % {M64} AS h FROM xa), xc AS (
  SELECT user_id, (xor(h, h // 8589934592) * 14029467366897019727::UHUGEINT) % {M64} AS h FROM xb), xd AS (
  SELECT user_id, (xor(h, h // 536870912) * 1609587929392839161::UHUGEINT) % {M64} AS h FROM xc), hashed AS (
  SELECT user_id, xor(h, h // 4294967296) AS h FROM xd), buckets AS (
  SELECT user_id, CAST(((CASE WHEN h >= 9223372036854775808::UHUGEINT
      THEN h::HUGEINT - 18446744073709551616::HUGEINT ELSE h::HUGEINT END) % 100 + 100) % 100 AS INTEGER) AS bucket
  FROM hashed)"""

ORDER_READERS = f"{INTER}, readers AS (SELECT DISTINCT item_id, user_id AS reader FROM inter WHERE is_read = 1)"
WORD_READERS = """words AS (
  SELECT CAST(doc_id AS INTEGER) AS item_id,
         unnest(regexp_split_to_array(lower(trim("text")), '[ \t\n\r]+')) AS word FROM documents), readers AS (
  SELECT DISTINCT item_id, word AS reader FROM words WHERE word <> '')"""
WORD_CODE = "CAST('0x' || substr(md5(reader), 1, 7) AS BIGINT)"


def sets_sql(min_readers: int, code: str = "reader::BIGINT") -> str:
    mins = ", ".join(
        f"min((({code} + 1) * {a} + {b}) % {MINHASH_PRIME}) AS h{i}"
        for i, (a, b) in enumerate(minhash_coefficients(5, 42))
    )
    return f"""sets AS (
  SELECT item_id, count(*) AS reader_count, {mins} FROM readers GROUP BY item_id
  HAVING count(*) >= {min_readers})"""


def pairs_sql(
    readers: str, min_readers: int, max_distance: float, collide: bool, code: str = "reader::BIGINT"
) -> str:
    same = " OR ".join(f"a.h{i} = b.h{i}" for i in range(5)) if collide else "true"
    return f"""WITH {readers}, {sets_sql(min_readers, code)}, kept AS (
  SELECT item_id, reader FROM readers WHERE item_id IN (SELECT item_id FROM sets)), shared AS (
  SELECT x.item_id AS id_1, y.item_id AS id_2, count(*) AS inter
  FROM kept x JOIN kept y ON x.reader = y.reader AND x.item_id < y.item_id GROUP BY 1, 2), scored AS (
  SELECT id_1, id_2, a.reader_count AS r1, b.reader_count AS r2, inter,
         a.reader_count + b.reader_count - inter AS uni,
         inter / CAST(a.reader_count + b.reader_count - inter AS DOUBLE) AS j
  FROM shared JOIN sets a ON a.item_id = id_1 JOIN sets b ON b.item_id = id_2 WHERE {same})
SELECT id_1 AS item_id_1, id_2 AS item_id_2, r1 AS reader_count_1, r2 AS reader_count_2,
       round(1 - j, 6) AS jaccard_distance, inter AS intersection_size, uni AS union_size,
       round(j, 6) AS jaccard_similarity
FROM scored WHERE CAST(1 AS DOUBLE) - j < CAST({max_distance} AS DOUBLE)
ORDER BY j DESC, inter DESC, r1 DESC, r2 DESC, id_1, id_2 LIMIT 100"""


# Users of each model: those of its training signal; only those with a label get a list.
SIGNALS = {
    "explicit": ("rating > 0", "liked"),
    "implicit": ("is_read + 2 * is_reviewed > 0", "read"),
    "combined": ("rating > 0 OR is_reviewed = 1 OR is_read = 1", "liked"),
}


def list_checks_sql(signal: str, label: str) -> str:
    """What the checks of lists must count: a list for every user of the cohort, and no broken rule."""
    return f"""WITH {SPLIT}, {LABELS} SELECT count(DISTINCT user_id) AS lists,
  0 AS over_k, 0 AS seen, 0 AS rank_gaps, 0 AS order_breaks, 0 AS score_breaks
FROM labels_long WHERE label = '{label}' AND user_id IN (SELECT user_id FROM train WHERE {signal})"""


# Given factors: even ids as users, odd ones as items; whole numbers, so that sums are exact in any order.
GIVEN = """e AS (
  SELECT CAST(vec_id AS INTEGER) AS id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL), u AS (
  SELECT * FROM e WHERE id % 2 = 0), i AS (SELECT * FROM e WHERE id % 2 = 1)"""

METRIC_NAMES = ("map", "ndcg_at_k", "precision_at_k", "recall_at_k")
POOLS = (100, 150, 1000)
RUNS = f"WITH {SPLIT}, {LABELS}, {COHORT}, {TOP}, " + ", ".join(
    f"{recs_sql(pool, f'recs_{pool}')}, {metrics_sql(f'recs_{pool}', f'metrics_{pool}')}" for pool in POOLS
) + ", runs AS (" + " UNION ALL ".join(
    f"SELECT 'popularity' AS model, CAST({pool} AS INTEGER) AS pool, {ROUNDED} FROM metrics_{pool}" for pool in POOLS
) + "), board AS (SELECT * FROM runs WHERE split = 'validation' AND label = 'read')"
COMPARE = RUNS + " SELECT a.label, 'popularity_' || a.pool AS model, a.pool, a.users, " + ", ".join(
    f"a.{m}, round((a.{m} / b.{m} - 1) * 100, 6) AS lift_{m}" for m in METRIC_NAMES
) + """ FROM runs a JOIN runs b ON b.label = a.label AND b.split = a.split AND b.pool = 1000
WHERE a.split = 'test' AND a.pool IN (100, 1000)"""

# The users whom all pools score; pool 1000 is the base.
COHORT_POOLS = (1, 20, 1000)
COMMON = f"WITH {SPLIT}, {LABELS}, {COHORT}, {TOP}, " + ", ".join(
    f"{recs_sql(pool, f'recs_{pool}')}, {metrics_sql(f'recs_{pool}', f'metrics_{pool}')}" for pool in COHORT_POOLS
) + ", scored AS (" + " UNION ALL ".join(
    f"""SELECT CAST({pool} AS INTEGER) AS pool, user_id, label, psum / n_labels AS map, dcg / idcg AS ndcg_at_k,
  hits / 100.0::DOUBLE AS precision_at_k, hits / CAST(n_labels AS DOUBLE) AS recall_at_k
  FROM metrics_{pool}_users WHERE split = 'test'""" for pool in COHORT_POOLS
) + """), kept AS (
  SELECT s.*, max(ndcg_at_k) FILTER (WHERE pool = 1000) OVER (PARTITION BY user_id, label) AS base_ndcg,
         count(*) OVER (PARTITION BY user_id, label) AS pools FROM scored s), means AS (
  SELECT label, pool, count(*) AS users, count_if(round(ndcg_at_k, 9) > round(base_ndcg, 9)) AS better,
         count_if(round(ndcg_at_k, 9) < round(base_ndcg, 9)) AS worse, """ + ", ".join(
    f"avg({m}) AS {m}" for m in METRIC_NAMES
) + f""" FROM kept WHERE pools = {len(COHORT_POOLS)} GROUP BY label, pool)
SELECT a.label, 'popularity_' || a.pool AS model, a.pool, a.users, a.better, a.worse, """ + ", ".join(
    f"round(a.{m}, 6) AS {m}, round((a.{m} / b.{m} - 1) * 100, 6) AS lift_{m}" for m in METRIC_NAMES
) + " FROM means a JOIN means b ON b.label = a.label AND b.pool = 1000"


ORACLES = {
    "interactions": f"WITH {INTER} SELECT * FROM inter",
    "csv_roundtrip": f"WITH {INTER} SELECT user_id, item_id, is_read, rating, is_reviewed FROM inter",
    "csv_malformed": f"""WITH {INTER} SELECT count(*) AS "rows", count_if(rating = 0) AS malformed FROM inter""",
    "csv_rejected": f"""WITH {INTER} SELECT concat_ws(',', user_id, item_id, is_read, 'none', is_reviewed) AS line,
  'rating' AS reason FROM inter WHERE rating = 0""",
    "id_map": """SELECT CAST(p_partkey AS INTEGER) AS id, CAST(p_partkey AS VARCHAR) || ':' || p_brand AS raw_id FROM part""",
    "ingest_profile": f"""WITH {INTER} SELECT count(*) AS row_count, CAST(sum(is_read) AS BIGINT) AS total_read,
  CAST(sum(is_reviewed) AS BIGINT) AS total_reviewed, 0 AS incomplete, count_if(rating = 0) AS rating_0,
  count_if(rating = 1) AS rating_1, count_if(rating = 2) AS rating_2, count_if(rating = 3) AS rating_3,
  count_if(rating = 4) AS rating_4, count_if(rating = 5) AS rating_5, 0 AS rating_other FROM inter""",
    "encode_ids": """WITH raw AS (SELECT DISTINCT o_orderkey AS raw_id FROM orders)
SELECT raw_id, CAST(row_number() OVER (
    ORDER BY CAST('0x' || substr(md5(CAST(raw_id AS VARCHAR)), 1, 8) AS BIGINT) % 1024, raw_id) - 1 AS INTEGER) AS id
FROM raw""",
    "profile_row_count": f"WITH {INTER} SELECT count(*) AS row_count FROM inter",
    "profile_rating_histogram": f"WITH {INTER} SELECT rating, count(*) AS row_count FROM inter GROUP BY rating",
    "profile_signal_totals": f"""WITH {INTER} SELECT CAST(sum(is_read) AS BIGINT) AS total_read,
  CAST(sum(is_reviewed) AS BIGINT) AS total_reviewed FROM inter""",
    "profile_split": f"""WITH {SPLIT}
SELECT 'all' AS part, count(*) AS row_count, count(DISTINCT user_id) AS user_count FROM inter
UNION ALL SELECT 'eligible', count(*), count(DISTINCT user_id) FROM dealt
UNION ALL SELECT split, count(*), count(DISTINCT user_id) FROM dealt GROUP BY split""",
    "sample_users_md5": f"""WITH {INTER} SELECT * FROM inter
WHERE CAST('0x' || substr(md5(CAST(user_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 3""",
    "sample_users_xxhash64": f"""WITH {INTER}, {XXHASH_INT}
SELECT inter.* FROM inter JOIN buckets USING (user_id) WHERE bucket < 3""",
    "sample_users_bucketed": f"""WITH {INTER}, {XXHASH_INT}
SELECT user_id, item_id, is_read, rating, is_reviewed FROM inter JOIN buckets USING (user_id) WHERE bucket < 3""",
    "eligible_users": f"WITH {INTER} SELECT user_id, count(*) AS n FROM inter GROUP BY user_id HAVING count(*) >= 5",
    **{
        f"split_{name}": f"WITH {SPLIT} SELECT * FROM dealt WHERE split = '{name}'"
        for name in ("train", "validation", "test")
    },
    "split_seeded": f"""WITH {INTER}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY md5('7|' || row_key)) AS rn,
         count(*) OVER (PARTITION BY user_id) AS n FROM inter)
SELECT user_id, item_id, is_read, rating, is_reviewed, row_key,
  CASE WHEN rn <= CAST(0.6 AS DOUBLE) * n THEN 'train' WHEN rn <= CAST(0.8 AS DOUBLE) * n THEN 'validation' ELSE 'test' END AS split
FROM ranked WHERE n >= 5""",
    "signal_combined_once": f"""WITH {SPLIT} SELECT user_id, item_id, max(score) AS score FROM (SELECT user_id, item_id,
  CAST(CASE WHEN rating > 0 THEN rating WHEN is_reviewed = 1 THEN 2 WHEN is_read = 1 THEN 1 ELSE 0 END AS DOUBLE)
  AS score FROM train) WHERE score > 0 GROUP BY user_id, item_id""",
    "signal_explicit": f"WITH {SPLIT} SELECT user_id, item_id, rating AS score FROM train WHERE rating > 0",
    "signal_implicit": f"""WITH {SPLIT} SELECT user_id, item_id,
  is_read + CAST(2.0 AS DOUBLE) * is_reviewed AS score FROM train WHERE is_read + 2 * is_reviewed > 0""",
    "signal_combined": f"""WITH {SPLIT} SELECT * FROM (SELECT user_id, item_id,
  CAST(CASE WHEN rating > 0 THEN rating WHEN is_reviewed = 1 THEN 2 WHEN is_read = 1 THEN 1 ELSE 0 END AS DOUBLE)
  AS score FROM train) WHERE score > 0""",
    "seen_pairs": f"WITH {SPLIT} SELECT DISTINCT user_id, item_id FROM train",
    "labels_read": f"WITH {SPLIT}, {LABELS} SELECT * FROM labels_long WHERE label = 'read'",
    "labels_liked": f"WITH {SPLIT}, {LABELS} SELECT * FROM labels_long WHERE label = 'liked'",
    "eval_cohort_read": f"WITH {SPLIT}, {COHORT} SELECT * FROM cohort WHERE label = 'read'",
    "eval_cohort_liked": f"WITH {SPLIT}, {COHORT} SELECT * FROM cohort WHERE label = 'liked'",
    "item_popularity": f"WITH {SPLIT}, {TOP} SELECT * FROM top",
    "popularity_recs": f"WITH {SPLIT}, {TOP}, {recs_sql(1000)} SELECT * FROM recs",
    "item_reader_sets": f"WITH {ORDER_READERS}, {sets_sql(10)} SELECT * FROM sets",
    "similar_pairs_exact": pairs_sql(ORDER_READERS, 10, 0.9, False),
    "similar_pairs_lsh": pairs_sql(ORDER_READERS, 10, 0.9, True),
    "similar_pairs_words_exact": pairs_sql(WORD_READERS, 30, 0.8, False, WORD_CODE),
    "similar_pairs_words_lsh": pairs_sql(WORD_READERS, 30, 0.8, True, WORD_CODE),
    "popularity_metrics_zero": f"""WITH {SPLIT}, {LABELS}, {COHORT}, {TOP}, {recs_sql(1)}, {metrics_sql(zero=True)}
SELECT {ROUNDED} FROM metrics""",
    "ranked_lists": f"""WITH {SPLIT}, {TOP}, {recs_sql(1000)}
SELECT user_id, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY "rank") AS items FROM recs GROUP BY user_id""",
    "mean_rating_rmse": f"""WITH {SPLIT}, mean AS (
  SELECT avg(CAST(rating AS DOUBLE)) AS m FROM train WHERE rating > 0)
SELECT split, count(*) AS "rows", round(sqrt(avg((rating - m) * (rating - m))), 6) AS rmse
FROM dealt CROSS JOIN mean WHERE split <> 'train' AND rating > 0 GROUP BY split""",
    "grid_leaderboard": f"{RUNS} SELECT * FROM board",
    "csv_export": f"{RUNS} SELECT * FROM board",
    "best_config": f"{RUNS} SELECT * FROM board ORDER BY ndcg_at_k DESC, pool LIMIT 1",
    "compare_models": COMPARE,
    "compare_models_common": COMMON,
    **{f"als_{name}_list_checks": list_checks_sql(*SIGNALS[name]) for name in SIGNALS},
    **{
        f"als_{name}_fit_checks": f"""WITH {SPLIT} SELECT count(DISTINCT user_id) AS users, 0 AS unsolved
FROM train WHERE {SIGNALS[name][0]}""" for name in SIGNALS
    },
    **dict.fromkeys(("factor_topk", "factor_topk_full"), f"""WITH {GIVEN} SELECT u.id AS user_id, i.id AS item_id,
  CAST(list_dot_product(u.v, i.v) AS BIGINT) AS score,
  CAST(row_number() OVER (PARTITION BY u.id ORDER BY list_dot_product(u.v, i.v) DESC, i.id) AS INTEGER) AS "rank"
FROM u CROSS JOIN i WHERE i.id < u.id OR i.id > u.id + 39 QUALIFY "rank" <= 10"""),
    "factor_missed": f"""WITH {GIVEN}, p AS (
  SELECT u.id AS user_id, i.id AS item_id, list_dot_product(u.v, i.v) AS score, i.id < u.id OR i.id > u.id + 39 AS unseen,
         row_number() OVER (PARTITION BY u.id ORDER BY list_dot_product(u.v, i.v) DESC, i.id) AS place
  FROM u CROSS JOIN i), n AS (
  SELECT user_id, least(10, count_if(unseen)) AS best_n, count_if(unseen AND place <= 10) AS own_n FROM p GROUP BY user_id)
SELECT 'cut' AS lists, count(*) AS users, count_if(own_n < best_n) AS short, 0 AS beaten FROM n
UNION ALL SELECT 'full', count(*), 0, 0 FROM n""",
    "factor_predictions": f"""WITH {GIVEN} SELECT u.id AS user_id, i.id AS item_id,
  CAST(list_dot_product(u.v, i.v) AS BIGINT) AS prediction
FROM u JOIN i ON i.id > u.id AND i.id <= u.id + 39""",
    "popularity_metrics": f"{POPULARITY} SELECT {ROUNDED} FROM metrics",
    **{
        f"popularity_metrics_{split}_{label}":
            f"{POPULARITY} SELECT {ROUNDED} FROM metrics WHERE split = '{split}' AND label = '{label}'"
        for split in ("validation", "test") for label in ("read", "liked")
    },
}
