"""Model configurations, saved models, the run table, selection and comparison."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, replace

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemill.operators import signals
from tastemill.operators.als import BLOCKS, fit_als, predict_ratings, recommend_topk
from tastemill.operators.evaluate import evaluate_ranking, mean_metrics, rmse, user_metrics
from tastemill.schemas import METRICS, RUNS, USER_RUNS

Kinds = Sequence[tuple[str, str]]


@dataclass(frozen=True)
class ModelConfig:
    """Everything that decides a run. Fields that a family does not use stay None."""

    model: str
    rank: int | None = None
    reg_param: float | None = None
    alpha: float | None = None
    read_weight: float | None = None
    review_weight: float | None = None
    max_iter: int | None = None
    pool: int = 250
    sample_pct: int = 100
    k: int = 100
    seed: int = 42
    blocks: int = BLOCKS
    dedupe: bool = False  # one signal row per (user, item): bounds a hot user's ratings by the number of items
    train_tag: str = ""  # fingerprint of the training rows

    def _id(self, *without: str) -> str:
        fields = {k: v for k, v in asdict(self).items() if k not in without}
        return "r" + hashlib.sha1(json.dumps(fields, sort_keys=True).encode()).hexdigest()[:16]

    @property
    def run_id(self) -> str:
        return self._id()

    @property
    def model_id(self) -> str:
        """The pool and k are applied after the fit, so runs that differ in them share a model."""
        return self._id("pool", "k")


def popularity_config(pool: int = 1000, **fields) -> ModelConfig:
    return ModelConfig("popularity", pool=pool, **fields)


def explicit_config(rank: int, reg_param: float, max_iter: int = 5, pool: int = 250, **fields) -> ModelConfig:
    return ModelConfig("explicit", rank, float(reg_param), max_iter=max_iter, pool=pool, **fields)


def implicit_config(
    rank: int = 100, reg_param: float = 0.1, alpha: float = 15.0, max_iter: int = 5, pool: int = 500, **fields
) -> ModelConfig:
    return ModelConfig(
        "implicit", rank, float(reg_param), float(alpha), 1.0, 2.0, max_iter=max_iter, pool=pool, **fields
    )


def combined_config(
    read_weight: float, review_weight: float, rank: int = 50, reg_param: float = 0.1,
    max_iter: int = 5, pool: int = 250, **fields,
) -> ModelConfig:
    return ModelConfig(
        "combined", rank, float(reg_param), read_weight=float(read_weight), review_weight=float(review_weight),
        max_iter=max_iter, pool=pool, **fields,
    )


def train_tag(train: DataFrame) -> str:
    """A fingerprint of the training rows, whatever their order: another split, seed or input gives another one."""
    row = train.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*sorted(train.columns)).cast("decimal(38,0)"))).first()
    return hashlib.sha1(f"{row[0]}:{row[1]}".encode()).hexdigest()[:12]


def tagged(config: ModelConfig, train: DataFrame) -> ModelConfig:
    return config if config.train_tag else replace(config, train_tag=train_tag(train))


def training_signal(config: ModelConfig, train: DataFrame) -> DataFrame:
    if config.model == "explicit":
        return signals.explicit_signal(train, config.dedupe)
    if config.model == "implicit":
        return signals.implicit_signal(train, config.read_weight, config.review_weight, config.dedupe)
    if config.model == "combined":
        return signals.combined_signal(train, config.read_weight, config.review_weight, config.dedupe)
    raise ValueError(f"no training signal for model {config.model!r}")


def fit_model(config: ModelConfig, train: DataFrame, **options) -> ALSModel:
    implicit = config.model == "implicit"
    return fit_als(
        training_signal(config, train), config.rank, config.reg_param, config.max_iter,
        implicit=implicit, alpha=config.alpha or 1.0, nonnegative=implicit, seed=config.seed, blocks=config.blocks,
        **options,
    )


def save_model(model: ALSModel, root: str, config: ModelConfig) -> None:
    model.write().overwrite().save(f"{root}/{config.model_id}")


def load_model(spark: SparkSession, root: str, config: ModelConfig) -> ALSModel:
    path = f"{root}/{config.model_id}"
    try:
        spark.read.text(f"{path}/metadata")
    except AnalysisException as missing:
        raise FileNotFoundError(f"no saved model for {config} at {path}") from missing
    return ALSModel.load(path)


def fit_or_load(config: ModelConfig, train: DataFrame, root: str) -> ALSModel:
    spark, config = train.sparkSession, tagged(config, train)
    try:
        return load_model(spark, root, config)
    except FileNotFoundError:
        save_model(fit_model(config, train), root, config)
        return load_model(spark, root, config)


def recommend(
    config: ModelConfig, model: ALSModel, train: DataFrame, labels: DataFrame, k: int = 100, full: bool = False
) -> DataFrame:
    """Lists for the users that have a label and that the model knows."""
    users = labels.select("user_id").distinct()
    return recommend_topk(model, users, signals.seen_pairs(train), k, config.pool, full)


def as_runs(config: ModelConfig, metrics: DataFrame) -> DataFrame:
    """Metric rows in the layout of the run table."""
    fixed = {**asdict(config), "run_id": config.run_id}
    def column(field):
        if field.name in metrics.columns:
            return F.col(field.name).cast(field.dataType)
        return F.lit(fixed.get(field.name)).cast(field.dataType).alias(field.name)
    return metrics.select(*[column(f) for f in RUNS.fields])


def evaluate_model(
    config: ModelConfig, model: ALSModel, train: DataFrame, held_out: DataFrame, kinds: Kinds, k: int = 100,
    with_rmse: bool = False, users: str | None = None,
) -> DataFrame:
    """Run rows of one model: each list is made once and scored for every split and label.

    ``users`` names a table that keeps every user's metrics; the means are then taken from there.
    """
    wanted = held_out.where(F.col("split").isin(*{s for s, _ in kinds}))
    labels = signals.build_labels(wanted, sorted({label for _, label in kinds}))
    recs = recommend(config, model, train, labels, k)
    if users is None:
        metrics = evaluate_ranking(recs, labels, kinds, k=k)
    else:
        metrics = mean_metrics(log_user_runs(replace(config, k=k), user_metrics(recs, labels, kinds, k=k), users))
    if with_rmse:
        errors = rmse(predict_ratings(model, signals.rated_rows(wanted, "split")), ["split"]).select("split", "rmse")
        metrics = metrics.join(errors, "split", "left")
    return as_runs(replace(config, k=k), metrics)


def log_runs(rows: DataFrame, path: str) -> None:
    """Put run rows into the table. One folder per run, split and label: running a
    configuration again replaces its rows, and a retried write cannot double them."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "run_id", "split", "label"
    ).parquet(path)


def log_user_runs(config: ModelConfig, per_user: DataFrame, path: str) -> DataFrame:
    """Put the metrics of a run's users into a table, replacing those of the same run, and read them back."""
    fixed = per_user.withColumn("run_id", F.lit(config.run_id))
    rows = fixed.select(*[F.col(f.name).cast(f.dataType) for f in USER_RUNS.fields])
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "run_id", "split", "label"
    ).parquet(path)
    return read_user_runs(per_user.sparkSession, path).where(F.col("run_id") == config.run_id)


def read_user_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(USER_RUNS).parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUNS).parquet(path)


def leaderboard(runs: DataFrame, model: str, split: str = "validation", label: str = "liked") -> DataFrame:
    """Runs of one family by NDCG, best first; ties go to the smaller configuration."""
    rows = runs.where((F.col("model") == model) & (F.col("split") == split) & (F.col("label") == label))
    smaller = ["rank", "pool", "max_iter", "reg_param", "alpha", "read_weight", "review_weight", "sample_pct"]
    return rows.orderBy(F.desc("ndcg_at_k"), *smaller)


def best_run(runs: DataFrame, model: str, split: str = "validation", label: str = "liked") -> DataFrame:
    return leaderboard(runs, model, split, label).limit(1)


def run_grid(
    configs: Iterable[ModelConfig], train: DataFrame, held_out: DataFrame, kinds: Kinds,
    models: str, runs: str, k: int = 100, load_saved: bool = False, skip_logged: bool = False,
    side_by_side: int = 1, users: str | None = None,
) -> DataFrame:
    """Fit, score and log each configuration; returns the run table.

    Each fit is one distributed job; the loop only goes over configurations. ``side_by_side`` cells are worked on at
    once, each in a scheduler pool of its own, so that the short stages of one fill the gaps of another; a
    cell's rows are its own folders, so the run table is that of the loop. ``skip_logged`` leaves out
    configurations that have a row for every kind.
    """
    spark, tag = train.sparkSession, train_tag(train)
    configs = [replace(config, train_tag=tag) for config in configs]
    if skip_logged:
        done = logged_kinds(spark, runs)
        configs = [c for c in configs if not {(s, l) for s, l in kinds} <= done.get(replace(c, k=k).run_id, set())]

    def cell(config: ModelConfig) -> None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", config.run_id if side_by_side > 1 else None)
        if load_saved:
            model = fit_or_load(config, train, models)
        else:
            model = fit_model(config, train)
            save_model(model, models, config)
        log_runs(evaluate_model(config, model, train, held_out, kinds, k, users=users), runs)

    if side_by_side > 1:
        with ThreadPoolExecutor(side_by_side) as pool:
            list(pool.map(inheritable_thread_target(spark)(cell), configs))
    else:
        for config in configs:
            cell(config)
    return read_runs(spark, runs)


def logged_kinds(spark: SparkSession, runs: str) -> dict[str, set[tuple[str, str]]]:
    """The (split, label) of every run in the table; one row per run and kind reaches the driver."""
    try:
        spark.read.parquet(runs)
    except AnalysisException:
        return {}
    out: dict[str, set[tuple[str, str]]] = {}
    for row in read_runs(spark, runs).select("run_id", "split", "label").distinct().collect():
        out.setdefault(row.run_id, set()).add((row.split, row.label))
    return out


def config_of(run: DataFrame) -> ModelConfig:
    """The configuration of a one-row run table."""
    row = run.first()
    if row is None:
        raise ValueError("no run to select from")
    return ModelConfig(**{name: row[name] for name in ModelConfig.__dataclass_fields__})


def select_and_test(
    runs: str, models: str, model: str, train: DataFrame, held_out: DataFrame, label: str = "liked", k: int = 100,
    users: str | None = None,
) -> DataFrame:
    """Take the configuration with the best validation NDCG, load its model, and score both
    splits with the rating error; only this model ever meets the test split."""
    spark = train.sparkSession
    best = config_of(best_run(read_runs(spark, runs).where(F.col("k") == k), model, "validation", label))
    if best.train_tag != train_tag(train):
        raise ValueError(f"the best run {best.run_id} was fitted on another split")
    saved = load_model(spark, models, best)
    kinds = [("validation", label), ("test", label)]
    return evaluate_model(best, saved, train, held_out, kinds, k, with_rmse=model == "explicit", users=users)


def compare_models(
    runs: DataFrame, base: str, split: str = "test", common_cohort: bool = False, users: DataFrame | None = None
) -> DataFrame:
    """Models side by side per label, with the lift in percent over a base, given by run_id or by its family.

    A family with several runs of one label is refused: each row would be compared with all of them.
    With ``common_cohort`` the metrics are means over the users whom all runs of a label score, taken from
    ``users`` (see ``log_user_runs``); ``better`` and ``worse`` count the users whose NDCG a model raises and lowers.
    """
    rows = runs.where(F.col("split") == split)
    chosen = rows.where((F.col("run_id") == base) | (F.col("model") == base))
    if not chosen.groupBy("label").count().where("count > 1").isEmpty():
        raise ValueError(f"several runs of {base!r} for one label: name the base by its run_id")
    paired = []
    if common_cohort:
        if users is None:
            raise ValueError("a common cohort needs the table of user metrics")
        rows = _on_common_users(rows, chosen, users.where(F.col("split") == split))
        chosen = rows.join(chosen.select("run_id", "label"), ["run_id", "label"], "left_semi")
        paired = ["better", "worse"]
    ref = chosen.select("label", *[F.col(m).alias(f"base_{m}") for m in METRICS])
    lifts = [((F.col(m) / F.col(f"base_{m}") - 1) * 100).alias(f"lift_{m}") for m in METRICS]
    return rows.join(ref, "label").select("label", "model", "pool", "users", *METRICS, *lifts, *paired)


def _on_common_users(rows: DataFrame, base: DataFrame, users: DataFrame) -> DataFrame:
    """Run rows with means over the users that all runs of their label have, and counts of users better and worse.

    Per user the runs are one group (as many rows as runs), so cohorts are intersected by a count, and the base's
    value meets the others in the same group: one shuffle by user and label, without a join on users.
    """
    listed = rows.select("run_id", "label")
    wanted = users.join(F.broadcast(listed), ["run_id", "label"], "left_semi")  # one row per run and label
    count = listed.groupBy("label").agg(F.count(F.lit(1)).alias("runs"))
    base_runs = base.select(F.col("run_id").alias("base_run"), "label")
    per_user = wanted.groupBy("label", "user_id").agg(F.collect_list(F.struct("run_id", *METRICS)).alias("scores"))
    whole = (
        per_user.join(F.broadcast(count), "label").where(F.size("scores") == F.col("runs"))
        .join(F.broadcast(base_runs), "label")
    )
    ref = F.filter("scores", lambda s: s.run_id == F.col("base_run"))[0]
    long = whole.select("label", ref.alias("ref"), F.inline("scores"))
    change = F.round("ndcg_at_k", 9) - F.round("ref.ndcg_at_k", 9)  # sums in another order are no change
    means = long.groupBy("label", "run_id").agg(
        F.count(F.lit(1)).alias("users"), *[F.avg(m).alias(m) for m in METRICS],
        F.count_if(change > 0).alias("better"), F.count_if(change < 0).alias("worse"),
    )
    return rows.drop("users", *METRICS).join(means, ["run_id", "label"])
