"""The whole pipeline as jobs over one base folder; each stage reads what the one before wrote."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemill import schemas
from tastemill.operators import popularity, profile, sampling, signals, similarity
from tastemill.operators.evaluate import mean_metrics, user_metrics
from tastemill.plans import experiments as ex
from tastemill.sources import tables

ALL_KINDS = [(split, label) for split in ("validation", "test") for label in ("read", "liked")]


@dataclass(frozen=True)
class Workspace:
    """``base`` is a folder that every executor reaches; ``sample_pct`` of the users take part."""

    spark: SparkSession
    base: str
    sample_pct: int = 3
    k: int = 100

    def path(self, *names: str, sampled: bool = True) -> str:
        return "/".join([self.base, *([f"{self.sample_pct}pct"] if sampled else []), *names])

    def ingest(self, interactions_csv: str, **id_map_csvs: str) -> DataFrame:
        """CSV files to Parquet tables; id maps are given as name=path.

        Interactions lie in folders by their user's hash bucket and are profiled as they are written. Lines that
        don't fit the schema have null cells; if there are any, they are kept with their reason in ``rejected``.
        """
        for name, path in id_map_csvs.items():
            id_map = tables.read_id_map(self.spark, path)
            tables.write_table(id_map, self.path("ids", name, sampled=False))
        rows = tables.read_interactions_csv(self.spark, interactions_csv)
        written = tables.write_bucketed(rows, self.path("interactions", sampled=False), profile.observed_metrics())
        if self.observed.first().incomplete:
            bad = tables.rejected_rows(self.spark, interactions_csv, schemas.INTERACTIONS)
            tables.write_table(bad, self.path("rejected", sampled=False))
        return written

    @property
    def interactions(self) -> DataFrame:
        return tables.read_table(self.spark, self.path("interactions", sampled=False))

    @property
    def observed(self) -> DataFrame:
        return tables.read_table(self.spark, self.path("interactions", sampled=False) + "-observed")

    def profile(self) -> None:
        """Row count, rating histogram and flag totals as CSV reports, from what the ingest observed."""
        reports = profile.observed_reports(self.observed)
        reports.setdefault("rating_histogram", profile.rating_histogram(self.interactions))
        for name, report in reports.items():
            tables.export_csv(report, self.path("reports", name, sampled=False))

    def sample(self) -> DataFrame:
        sampled = sampling.sample_users(self.interactions, self.sample_pct, bucket="bucket")
        return tables.write_table(sampled, self.path("sample"))

    @property
    def sampled(self) -> DataFrame:
        return tables.read_table(self.spark, self.path("sample"), schemas.INTERACTIONS)

    def split(self, seed: int = 42, min_rows: int = 5) -> DataFrame:
        dealt = sampling.split_per_user(
            sampling.with_row_key(self.sampled), min_rows=min_rows, seed=seed,
            sizes=sampling.eligible_users(self.sampled, 1),
        )
        return tables.write_table(dealt.drop("row_key"), self.path("splits"), "split")

    @property
    def splits(self) -> DataFrame:
        return tables.read_table(self.spark, self.path("splits"), schemas.SPLITS)

    @property
    def train(self) -> DataFrame:
        return self.splits.where(F.col("split") == "train").drop("split")

    @property
    def held_out(self) -> DataFrame:
        return self.splits.where(F.col("split").isin("validation", "test"))

    @property
    def runs(self) -> DataFrame:
        return ex.read_runs(self.spark, self.path("runs"))

    def popularity(self, pool: int = 1000) -> DataFrame:
        """Score the popularity lists on both splits and labels and log the run."""
        labels = signals.build_labels(self.held_out, ["read", "liked"])
        hits = popularity.popularity_hits(self.train, labels, self.k, pool)
        per_user = user_metrics(hits, labels, ALL_KINDS, signals.popularity_cohort(self.train), self.k)
        config = ex.popularity_config(pool, sample_pct=self.sample_pct, k=self.k)
        metrics = mean_metrics(ex.log_user_runs(config, per_user, self.path("user-runs")))
        ex.log_runs(ex.as_runs(config, metrics), self.path("runs"))
        return self.runs.where(F.col("run_id") == config.run_id)

    def similar_items(self, **options) -> DataFrame:
        """The most similar item pairs of the sample, as a table and a CSV report."""
        readers = similarity.reader_pairs(self.sampled)
        pairs = similarity.similar_pairs(readers, self.path("similar", "work"), **options)
        kept = tables.write_table(pairs, self.path("similar", "pairs"))
        order = [F.desc(c) for c in ("jaccard_similarity", "intersection_size", "reader_count_1", "reader_count_2")]
        tables.export_csv(kept.orderBy(*order, "item_id_1", "item_id_2"), self.path("reports", "similar_pairs"))
        return kept

    def grid(
        self, configs: Iterable[ex.ModelConfig], kinds: ex.Kinds, load_saved: bool = False, side_by_side: int = 1
    ) -> DataFrame:
        configs = [replace(config, sample_pct=self.sample_pct) for config in configs]
        return ex.run_grid(
            configs, self.train, self.held_out, kinds, self.path("models"), self.path("runs"), self.k, load_saved,
            side_by_side=side_by_side, users=self.path("user-runs"),
        )

    def compare(self, base: str = "popularity", split: str = "test", common_cohort: bool = True) -> DataFrame:
        """All runs of a split beside the base, by default over the users whom all of a label's runs score."""
        users = ex.read_user_runs(self.spark, self.path("user-runs")) if common_cohort else None
        return ex.compare_models(self.runs, base, split, common_cohort, users)

    def select(self, model: str, label: str = "liked") -> DataFrame:
        """Score the best validation configuration on both splits and log it."""
        rows = ex.select_and_test(
            self.path("runs"), self.path("models"), model, self.train, self.held_out, label, self.k, self.path("user-runs")
        )
        ex.log_runs(rows, self.path("runs"))
        best = ex.config_of(ex.best_run(self.runs, model, "validation", label))
        return self.runs.where((F.col("run_id") == best.run_id) & (F.col("label") == label))

    def report(self, model: str, label: str = "liked") -> None:
        """Four tables of a family as CSV: the ordered validation grid, the metric rows of its best run, all its
        runs on every split and label, and all runs with the same configuration side by side by split."""
        grid = ex.leaderboard(self.runs, model, "validation", label)
        tables.export_csv(grid, self.path("reports", f"{model}_{label}_grid"))
        best = grid.limit(1).select("run_id")
        rows = self.runs.join(best, "run_id", "left_semi").orderBy("split", "label")
        tables.export_csv(rows, self.path("reports", f"{model}_{label}_best"))
        every = self.runs.where(F.col("model") == model).orderBy("run_id", "split", "label")
        tables.export_csv(every, self.path("reports", f"{model}_runs"))
        both = every.where(F.col("label") == label).groupBy("run_id").agg(*[
            F.max(F.when(F.col("split") == split, F.col(m))).alias(f"{split}_{m}")
            for split in ("validation", "test") for m in schemas.METRICS
        ])
        tables.export_csv(both.orderBy("run_id"), self.path("reports", f"{model}_{label}_splits"))
