"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemill.operators import als, checks, popularity, profile, sampling, signals, similarity
from tastemill.operators.evaluate import evaluate_ranking, mean_metrics, rmse, user_metrics
from tastemill.plans import experiments as ex
from tastemill.plans.staging import splits, staged_path
from tastemill.schemas import INTERACTIONS, METRICS
from tastemill.sources import tables
from tastemill.sources.fixtures import order_interactions, word_readers

K = 100
SAMPLE_PCT = 3
KINDS = [(s, l) for s in ("validation", "test") for l in ("read", "liked")]


def _train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits(spark, sf_dir).where(F.col("split") == "train").drop("split")


def _held_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits(spark, sf_dir).where(F.col("split").isin("validation", "test"))


def rounded(df: DataFrame, cols=METRICS) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in cols})


def interactions(spark, sf_dir):
    return order_interactions(spark, sf_dir)


def csv_roundtrip(spark, sf_dir):
    path = staged_path(spark, sf_dir, "interactions-csv")
    tables.write_csv(order_interactions(spark, sf_dir).drop("row_key"), path)
    return tables.read_interactions_csv(spark, path)


def _marked_csv(spark, sf_dir):
    """The interactions as CSV with a word in place of each rating of 0."""
    path = staged_path(spark, sf_dir, "marked-csv")
    marked = order_interactions(spark, sf_dir).select(
        "user_id", "item_id", "is_read",
        F.when(F.col("rating") > 0, F.col("rating").cast("string")).otherwise("none").alias("rating"),
        "is_reviewed",
    )
    tables.write_csv(marked, path)
    return path


def csv_malformed(spark, sf_dir):
    return tables.malformed_rows(spark, _marked_csv(spark, sf_dir), INTERACTIONS)


def csv_rejected(spark, sf_dir):
    """The lines that don't fit, each with the column that is at fault."""
    return tables.rejected_rows(spark, _marked_csv(spark, sf_dir), INTERACTIONS)


def id_map(spark, sf_dir):
    """An identifier map of the parts, from a CSV file."""
    path = staged_path(spark, sf_dir, "id-map-csv")
    parts = spark.read.parquet(f"{sf_dir}/part.parquet")
    tables.write_csv(parts.select(
        F.col("p_partkey").alias("id"), F.concat_ws(":", F.col("p_partkey").cast("string"), "p_brand").alias("raw_id")
    ), path)
    return tables.read_id_map(spark, path)


def _ingested(spark, sf_dir):
    rows = order_interactions(spark, sf_dir).drop("row_key")
    path = staged_path(spark, sf_dir, "ingested")
    return tables.write_bucketed(rows, path, profile.observed_metrics()), path


def ingest_profile(spark, sf_dir):
    """Counts of all rows, taken while they are written."""
    return tables.read_table(spark, _ingested(spark, sf_dir)[1] + "-observed")


def sample_users_bucketed(spark, sf_dir):
    """The sample of ``sample_users_xxhash64`` from a table that lies by bucket."""
    return sampling.sample_users(_ingested(spark, sf_dir)[0], SAMPLE_PCT, bucket="bucket")


def encode_ids(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return tables.encode_ids(orders, "o_orderkey", work_dir=staged_path(spark, sf_dir, "distinct-ids"))


def split_query(name):
    def run(spark, sf_dir):
        dealt = sampling.split_per_user(order_interactions(spark, sf_dir))
        return dealt.where(F.col("split") == name)
    return run


def split_seeded(spark, sf_dir):
    """Another order of the same rows: the split under a seed."""
    return sampling.split_per_user(order_interactions(spark, sf_dir), seed=7)


def popularity_metrics(spark, sf_dir, k=K, pool=1000, kinds=KINDS, missing="drop"):
    train = _train(spark, sf_dir)
    labels = signals.build_labels(_held_out(spark, sf_dir), sorted({l for _, l in kinds}))
    labels = labels.where(F.col("split").isin(*sorted({s for s, _ in kinds})))
    hits = popularity.popularity_hits(train, labels, k, pool)
    return evaluate_ranking(hits, labels, kinds, signals.popularity_cohort(train), k, missing)


def popularity_metrics_query(split, label):
    return lambda spark, sf_dir: rounded(popularity_metrics(spark, sf_dir, kinds=[(split, label)]))


# Random orders have no near-equal reader sets, so their floor on readers and similarity is lower.
ORDER_PAIRS = {"min_readers": 10, "max_distance": 0.9}


def reader_sets(spark, sf_dir):
    readers = similarity.reader_pairs(order_interactions(spark, sf_dir))
    return similarity.item_reader_sets(readers, 10).drop("print_1", "print_2")


def similar_pairs_query(name, source, **options):
    def run(spark, sf_dir):
        readers = similarity.reader_pairs(source(spark, sf_dir))
        pairs = similarity.similar_pairs(readers, staged_path(spark, sf_dir, name), **options)
        return rounded(pairs, ("jaccard_distance", "jaccard_similarity"))
    return run


EXPLICIT = ex.explicit_config(rank=100, reg_param=0.01)
IMPLICIT = ex.implicit_config()
COMBINED = ex.combined_config(1.0, 2.0)
EXPLICIT_GRID = [ex.explicit_config(rank, reg) for rank in (20, 100) for reg in (0.01, 0.1)]
POOLS = (100, 150, 1000)
LIKED = [(s, "liked") for s in ("validation", "test")]
READ = [(s, "read") for s in ("validation", "test")]


def _model(spark, sf_dir, config):
    return ex.fit_or_load(config, _train(spark, sf_dir), staged_path(spark, sf_dir, "models"))


def als_recs_query(config, kind):
    """Fits anew, so that its result and time don't depend on other queries."""
    def run(spark, sf_dir):
        train = _train(spark, sf_dir)
        model = ex.fit_model(config, train)
        labels = signals.build_labels(_held_out(spark, sf_dir), [kind])
        return ex.recommend(config, model, train, labels, K)
    return run


def als_list_checks_query(config, kind):
    """Whether the model's lists keep every rule, over all users that get one."""
    def run(spark, sf_dir):
        train = _train(spark, sf_dir)
        model = _model(spark, sf_dir, config)
        recs = ex.recommend(config, model, train, signals.build_labels(_held_out(spark, sf_dir), [kind]), K)
        return checks.list_checks(model, recs, signals.seen_pairs(train), K)
    return run


def als_fit_checks_query(config):
    """Whether the fitted user factors solve their normal equations."""
    def run(spark, sf_dir):
        signal = ex.training_signal(config, _train(spark, sf_dir))
        model = _model(spark, sf_dir, config)
        if config.model == "implicit":
            return checks.implicit_fit_checks(model, signal, config.reg_param, config.alpha)
        return checks.fit_checks(model, signal, config.reg_param)
    return run


def _given_factors(spark, sf_dir):
    """A model over the embeddings, even ids as users and odd ones as items, and 20 seen pairs a user.

    Components are whole numbers, so that sums are exact in any order.
    """
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").where("vec_id IS NOT NULL AND embedding IS NOT NULL")
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("float"))
    factors = vectors.select(F.col("vec_id").cast("int").alias("id"), whole.alias("features"))
    users, items = factors.where("id % 2 = 0"), factors.where("id % 2 = 1")
    model = als.model_of_factors(users, items, staged_path(spark, sf_dir, "given-factors"))
    user = users.select(F.col("id").alias("user_id"))
    near = F.transform(F.sequence(F.lit(1), F.lit(39), F.lit(2)), lambda step: F.col("user_id") + step)
    return model, user, user.select("user_id", F.explode(near).alias("item_id"))


def factor_topk_query(k=10, pool=50, full=False):
    def run(spark, sf_dir):
        model, users, seen = _given_factors(spark, sf_dir)
        recs = als.recommend_topk(model, users, seen, k, pool, full)
        return recs.withColumn("score", F.col("score").cast("long"))
    return run


def factor_missed(spark, sf_dir, k=10):
    """What a pool of k misses, and what full lists miss; all pairs are scored once per pool, not once per reader."""
    model, users, seen = _given_factors(spark, sf_dir)
    def kept(rows, name):
        return tables.write_table(rows, staged_path(spark, sf_dir, name))
    cut = kept(als.recommend_topk(model, users, seen, k, k), "cut-lists")
    full = kept(als.recommend_topk(model, users, seen, k, k, True, cut), "full-lists")
    best = kept(als.recommend_topk(model, users, seen, k, k + 40, True), "best-lists")
    rows = [
        checks.missed_items(model, recs, seen, users, k, k + 40, best).select(F.lit(name).alias("lists"), "*")
        for name, recs in (("cut", cut), ("full", full))
    ]
    return rows[0].unionByName(rows[1])


def factor_predictions(spark, sf_dir):
    model, _, seen = _given_factors(spark, sf_dir)
    return als.predict_ratings(model, seen).withColumn("prediction", F.col("prediction").cast("long"))


def ranked_lists(spark, sf_dir):
    return als.to_ranked_lists(popularity.popularity_recs(_train(spark, sf_dir), K)).select(
        "user_id", F.array_join("items", ",").alias("items")
    )


def als_metrics_query(config, kinds):
    def run(spark, sf_dir):
        model = _model(spark, sf_dir, config)
        rows = ex.evaluate_model(config, model, _train(spark, sf_dir), _held_out(spark, sf_dir), kinds, K)
        return rounded(rows)
    return run


def als_explicit_rmse(spark, sf_dir):
    rated = signals.rated_rows(_held_out(spark, sf_dir), "split")
    return rmse(als.predict_ratings(_model(spark, sf_dir, EXPLICIT), rated), ["split"])


def mean_rating_rmse(spark, sf_dir):
    """The error of always predicting the mean train rating: the bar for a model."""
    mean = signals.explicit_signal(_train(spark, sf_dir)).agg(F.avg("score"))
    rated = signals.rated_rows(_held_out(spark, sf_dir), "split")
    return rounded(rmse(rated.withColumn("prediction", mean.scalar()), ["split"]), ["rmse"])


def popularity_user_metrics(spark, sf_dir, pools, kinds=KINDS):
    """Every user's metrics for all pool sizes, labels placed once in the largest pool."""
    train = _train(spark, sf_dir)
    labels = signals.build_labels(_held_out(spark, sf_dir), sorted({l for _, l in kinds}))
    hits = popularity.popularity_hits(train, labels, K, max(pools))
    return user_metrics(hits, labels, kinds, signals.popularity_cohort(train), K, pools=pools)


def popularity_runs(spark, sf_dir):
    """The popularity family over its pool sizes, logged in a run table."""
    path = staged_path(spark, sf_dir, "popularity-runs")
    means = mean_metrics(popularity_user_metrics(spark, sf_dir, POOLS), ["split", "label", "pool"])
    means = tables.write_table(rounded(means), staged_path(spark, sf_dir, "popularity-means"))
    rows = [ex.as_runs(ex.popularity_config(pool), means.where(F.col("pool") == pool)) for pool in POOLS]
    ex.log_runs(reduce(DataFrame.unionByName, rows), path)
    return ex.read_runs(spark, path)


BOARD = ("model", "pool", "split", "label", "users", *METRICS)


def grid_leaderboard(spark, sf_dir):
    return ex.leaderboard(popularity_runs(spark, sf_dir), "popularity", label="read").select(*BOARD)


def csv_export(spark, sf_dir):
    """The leaderboard as a one-file CSV report, read back."""
    path = staged_path(spark, sf_dir, "leaderboard-csv")
    board = grid_leaderboard(spark, sf_dir)
    tables.export_csv(board, path)
    return tables.read_csv(spark, path, board.schema)


def best_config(spark, sf_dir):
    return ex.best_run(popularity_runs(spark, sf_dir), "popularity", label="read").select(*BOARD)


def compare_models(spark, sf_dir):
    """A short pool beside the full one, with the change in percent."""
    runs = popularity_runs(spark, sf_dir).where(F.col("pool").isin(100, 1000))
    return _compared(ex.compare_models(runs, ex.popularity_config(1000).run_id))


def _compared(rows):
    named = rows.withColumn("model", F.concat_ws("_", "model", "pool"))
    return rounded(named, [*METRICS, *[f"lift_{m}" for m in METRICS]])


COHORT_POOLS = (1, 20, 1000)


def compare_models_common(spark, sf_dir):
    """Pools over their common cohort: a pool of one item leaves those without a list who have met it."""
    per_user = popularity_user_metrics(spark, sf_dir, COHORT_POOLS, [("test", "read"), ("test", "liked")])
    per_user = tables.write_table(per_user, staged_path(spark, sf_dir, "cohort-metrics"))
    runs, users = (staged_path(spark, sf_dir, f"cohort-{name}") for name in ("runs", "users"))
    for pool in COHORT_POOLS:
        config = ex.popularity_config(pool)
        own = ex.log_user_runs(config, per_user.where(F.col("pool") == pool).drop("pool"), users)
        ex.log_runs(ex.as_runs(config, mean_metrics(own)), runs)
    base = ex.popularity_config(1000).run_id
    return _compared(ex.compare_models(
        ex.read_runs(spark, runs), base, common_cohort=True, users=ex.read_user_runs(spark, users)
    ))


def _explicit_grid(spark, sf_dir):
    paths = [staged_path(spark, sf_dir, name) for name in ("models", "explicit-runs")]
    kinds = [("validation", "liked")]
    train, held_out = _train(spark, sf_dir), _held_out(spark, sf_dir)
    return ex.run_grid(
        EXPLICIT_GRID, train, held_out, kinds, *paths, K, load_saved=True, skip_logged=True, side_by_side=2
    )


def als_grid_leaderboard(spark, sf_dir):
    return ex.leaderboard(_explicit_grid(spark, sf_dir), "explicit")


def als_select_and_test(spark, sf_dir):
    _explicit_grid(spark, sf_dir)
    models, runs = (staged_path(spark, sf_dir, name) for name in ("models", "explicit-runs"))
    return ex.select_and_test(runs, models, "explicit", _train(spark, sf_dir), _held_out(spark, sf_dir))


def als_compare_models(spark, sf_dir):
    """Popularity and the three factor models on the test split, with the lift over popularity."""
    train, held_out = _train(spark, sf_dir), _held_out(spark, sf_dir)
    path = staged_path(spark, sf_dir, "all-runs")
    test = [("test", "liked"), ("test", "read")]
    ex.log_runs(ex.as_runs(ex.popularity_config(), popularity_metrics(spark, sf_dir, kinds=test)), path)
    for config, kinds in ((EXPLICIT, test[:1]), (IMPLICIT, test[1:]), (COMBINED, test)):
        ex.log_runs(ex.evaluate_model(config, _model(spark, sf_dir, config), train, held_out, kinds, K), path)
    return ex.compare_models(ex.read_runs(spark, path), "popularity")


QUERIES = {
    "interactions": interactions,
    "csv_roundtrip": csv_roundtrip,
    "csv_malformed": csv_malformed,
    "csv_rejected": csv_rejected,
    "id_map": id_map,
    "ingest_profile": ingest_profile,
    "encode_ids": encode_ids,
    "profile_row_count": lambda s, d: profile.row_count(order_interactions(s, d)),
    "profile_rating_histogram": lambda s, d: profile.rating_histogram(order_interactions(s, d)),
    "profile_signal_totals": lambda s, d: profile.signal_totals(order_interactions(s, d)),
    "profile_split": lambda s, d: profile.split_profile(order_interactions(s, d), splits(s, d)),
    "sample_users_md5": lambda s, d: sampling.sample_users(order_interactions(s, d), SAMPLE_PCT, method="md5"),
    "sample_users_xxhash64": lambda s, d: sampling.sample_users(order_interactions(s, d), SAMPLE_PCT),
    "sample_users_bucketed": sample_users_bucketed,
    "eligible_users": lambda s, d: sampling.eligible_users(order_interactions(s, d)),
    **{f"split_{name}": split_query(name) for name in sampling.SPLITS},
    "split_seeded": split_seeded,
    "signal_combined_once": lambda s, d: signals.combined_signal(_train(s, d), 1.0, 2.0, dedupe=True),
    "signal_explicit": lambda s, d: signals.explicit_signal(_train(s, d)),
    "signal_implicit": lambda s, d: signals.implicit_signal(_train(s, d)),
    "signal_combined": lambda s, d: signals.combined_signal(_train(s, d), 1.0, 2.0),
    "seen_pairs": lambda s, d: signals.seen_pairs(_train(s, d)),
    "labels_read": lambda s, d: signals.build_labels(_held_out(s, d), ["read"]).distinct(),
    "labels_liked": lambda s, d: signals.build_labels(_held_out(s, d), ["liked"]).distinct(),
    "eval_cohort_read": lambda s, d: signals.popularity_cohort(_train(s, d), ["read"]),
    "eval_cohort_liked": lambda s, d: signals.popularity_cohort(_train(s, d), ["liked"]),
    "item_popularity": lambda s, d: popularity.item_popularity(_train(s, d)),
    "popularity_recs": lambda s, d: popularity.popularity_recs(_train(s, d), K),
    **{f"popularity_metrics_{s}_{l}": popularity_metrics_query(s, l) for s, l in KINDS},
    "item_reader_sets": reader_sets,
    **{
        name: similar_pairs_query(name, source, **options)
        for name, source, options in [
            ("similar_pairs_exact", order_interactions, {**ORDER_PAIRS, "collide": False}),
            ("similar_pairs_lsh", order_interactions, ORDER_PAIRS),
            ("similar_pairs_words_exact", word_readers, {"collide": False}),
            ("similar_pairs_words_lsh", word_readers, {}),
        ]
    },
    "popularity_metrics": lambda s, d: rounded(popularity_metrics(s, d)),
    "popularity_metrics_zero": lambda s, d: rounded(popularity_metrics(s, d, pool=1, missing="zero")),
    "ranked_lists": ranked_lists,
    "mean_rating_rmse": mean_rating_rmse,
    "grid_leaderboard": grid_leaderboard,
    "csv_export": csv_export,
    "best_config": best_config,
    "compare_models": compare_models,
    "compare_models_common": compare_models_common,
    "als_explicit_recs": als_recs_query(EXPLICIT, "liked"),
    "als_implicit_recs": als_recs_query(IMPLICIT, "read"),
    "als_combined_recs": als_recs_query(COMBINED, "liked"),
    "als_explicit_metrics": als_metrics_query(EXPLICIT, LIKED),
    "als_implicit_metrics": als_metrics_query(IMPLICIT, READ),
    "als_combined_metrics": als_metrics_query(COMBINED, KINDS),
    "als_explicit_rmse": als_explicit_rmse,
    "als_explicit_list_checks": als_list_checks_query(EXPLICIT, "liked"),
    "als_implicit_list_checks": als_list_checks_query(IMPLICIT, "read"),
    "als_combined_list_checks": als_list_checks_query(COMBINED, "liked"),
    "als_explicit_fit_checks": als_fit_checks_query(EXPLICIT),
    "als_combined_fit_checks": als_fit_checks_query(COMBINED),
    "als_implicit_fit_checks": als_fit_checks_query(IMPLICIT),
    "factor_topk": factor_topk_query(),
    "factor_topk_full": factor_topk_query(pool=10, full=True),
    "factor_missed": factor_missed,
    "factor_predictions": factor_predictions,
    "als_grid_leaderboard": als_grid_leaderboard,
    "als_select_and_test": als_select_and_test,
    "als_compare_models": als_compare_models,
}
