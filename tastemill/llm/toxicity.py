"""Toxicity by a chain of linear classifiers.

A text's features are its terms, whole words and beginnings of words: whether it has one, and
its share of the words. Categories are predicted in order: low quality as labelled, then kinds of toxic texts that are found in
the training texts, then toxicity as labelled. Each later model sees the text's terms and the
probabilities of all earlier categories. The kinds are clusters of the toxic training texts by the terms that they
have, larger ones first; the terms are those most uneven between the classes, so no word is given beforehand. While training, those probabilities are out-of-fold
predictions, so a later model never sees an earlier one's fit to its own rows. Folds keep
likely near copies (one min-hash over a text's word triples) together, and such a group weighs as one.

Training takes at most POSITIVES and NEGATIVES labelled documents, those with the least hash of
their id; a class cut to that counts with the weight of all its labels, so that the chain, its threshold
and the share of toxic labels follow the whole table. Scoring covers every document and its whole text. Null texts are empty texts. A
label with a null id or value is none (a null quality says nothing against a text); of repeated labels any toxic or low one
counts, of several texts with one labelled id the least. Without
labels of both classes nothing is toxic and all probabilities are the share of toxic labels (0
without any). Rows with null or repeated doc_ids are scored like any other, ties of terms go to the first in order, of texts
to the least. Other columns are ignored whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemill.llm.common import stage, table

POSITIVES, NEGATIVES = 3000, 6000
TERMS = 256
PREFIXES = (4, 5, 6, 7)  # letters of the beginnings that can be terms, beside whole words
END = "$"  # marks a term that is a whole word
FULL_SHARE = 0.02  # share of a text's words at which a term counts in full
LEAST_GROUPS = 4  # groups of texts that must hold a term
LEAST_Z = 5.0
FOLDS = 4
PENALTY = 1e-3
STEPS = 150
LEAST_PRECISION = 0.99
FEED = 0.05  # probabilities go to later links as log-odds between this and 1 less this

KINDS = 3  # of toxic texts
ROUNDS = 30
CHAIN = ("low_quality", *[f"kind_{n}" for n in range(1, KINDS + 1)], "toxic")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, FEED, 1 - FEED)
    return np.log(p / (1 - p))


def fit_linear(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights and bias of a logistic model by accelerated gradient descent."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float32)
    y, weight = y.astype(np.float32), (weight / weight.sum()).astype(np.float32)
    probe = np.ones(x.shape[1], np.float32)
    for _ in range(20):  # the largest curvature sets the step
        probe = x.T @ (weight * (x @ probe))
        probe /= np.linalg.norm(probe) + 1e-12
    step = 1 / (0.25 * np.linalg.norm(x.T @ (weight * (x @ probe))) + PENALTY)
    shrink = np.full(x.shape[1], PENALTY, np.float32)
    shrink[-1] = 0
    w = ahead = np.zeros(x.shape[1], np.float32)
    for n in range(STEPS):
        slope = x.T @ (weight * (sigmoid(x @ ahead) - y)) + shrink * ahead
        after = ahead - step * slope
        ahead = after + n / (n + 3) * (after - w)
        w = after
    return w


def predict(w: np.ndarray, x: np.ndarray) -> np.ndarray:
    return sigmoid(x @ w[:-1] + w[-1])


@dataclass
class Chain:
    terms: list[str]
    weights: list[np.ndarray]
    threshold: float
    base: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """One column per category, each fed to the next."""
        if not self.weights:
            return np.full((len(x), len(CHAIN)), self.base)
        out: list[np.ndarray] = []
        for w in self.weights:
            out.append(predict(w, np.hstack([x, *[logit(p)[:, None] for p in out]])))
        return np.stack(out, axis=1).astype(np.float64)


def fit_chain(
    x: np.ndarray, labels: np.ndarray, groups: np.ndarray, terms: list[str], stands_for: np.ndarray | None = None
) -> Chain:
    """Fit the links in order on out-of-fold probabilities of those before; a row stands for so many labels."""
    _, member, sizes = np.unique(groups, return_inverse=True, return_counts=True)
    stands_for = np.ones(len(x)) if stands_for is None else stands_for
    weight, fold = stands_for / sizes[member], member % FOLDS
    earlier: list[np.ndarray] = []
    weights = []
    for link in range(labels.shape[1]):
        y = labels[:, link].astype(np.float64)
        inputs = np.hstack([x, *[logit(p)[:, None] for p in earlier]])
        earlier.append(out_of_fold(inputs, y, weight, fold))
        weights.append(fit_linear(inputs, y, weight))
    base = float(np.average(labels[:, -1], weights=stands_for))
    return Chain(terms, weights, best_threshold(earlier[-1], labels[:, -1], weight), base)


def out_of_fold(inputs: np.ndarray, y: np.ndarray, weight: np.ndarray, fold: np.ndarray) -> np.ndarray:
    """Each row's probability by the model of all other folds' rows."""
    held_out = np.zeros(len(y))
    for f in range(FOLDS):
        away = fold == f
        if away.any() and not away.all():
            held_out[away] = predict(fit_linear(inputs[~away], y[~away], weight[~away]), inputs[away])
    return held_out


def best_threshold(p: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The lowest threshold whose held-out precision reaches LEAST_PRECISION; without one, the most precise."""
    best = (-1.0, 0.5)
    for t in np.arange(0.2, 0.96, 0.05):
        above = p >= t
        if not above.any():
            break
        precision = float((weight * y)[above].sum() / weight[above].sum())
        if precision >= LEAST_PRECISION:
            return float(t)
        best = max(best, (precision, float(t)))
    return best[1]


def find_kinds(x: np.ndarray, weight: np.ndarray, kinds: int = KINDS) -> np.ndarray:
    """The kind of each row, from 0 in the order of their weights: clusters by the angle between rows of terms.

    The first centre is the direction of all rows, each next one the row farthest from those before, so that
    the same rows always give the same kinds. Rows without a term are of the first kind.
    """
    rows = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    found = np.zeros(len(x), int)
    if not len(x):
        return found
    centres = [(weight[:, None] * rows).sum(axis=0)]
    centres[0] = centres[0] / max(np.linalg.norm(centres[0]), 1e-12)
    for _ in range(kinds - 1):
        nearest = (rows @ np.array(centres).T).max(axis=1)
        centres.append(rows[np.argmin(np.where(rows.any(axis=1), nearest, np.inf))])
    middle = np.array(centres)
    for _ in range(ROUNDS):
        fresh = (rows @ middle.T).argmax(axis=1)
        if (fresh == found).all() and _:
            break
        found = fresh
        for kind in range(kinds):
            total = (weight[:, None] * rows)[found == kind].sum(axis=0)
            if total.any():
                middle[kind] = total / np.linalg.norm(total)
    order = np.argsort([-weight[found == kind].sum() for kind in range(kinds)], kind="stable")
    return np.argsort(order)[found]


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(id, text, words, toxic, low_quality, stands_for, group) of the labelled sample, staged."""
    low = F.col("quality") == 0 if "quality" in labels.columns else F.lit(False)
    truth = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy(
        F.col("doc_id").cast("long").alias("id")
    ).agg(
        F.max("toxic").cast("int").alias("toxic"),
        F.coalesce(F.max(low.cast("int")), F.lit(0)).alias("low_quality"),
    )
    known = truth.join(docs.select(F.col("doc_id").cast("long").alias("id")).distinct(), "id", "left_semi")
    known = stage(known, "toxicity-labels")
    counts = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    order = [F.xxhash64("id"), F.col("id")]
    taken = known.where("toxic = 1").orderBy(*order).limit(POSITIVES).unionByName(
        known.where("toxic = 0").orderBy(*order).limit(NEGATIVES)
    )
    share = [max(1.0, counts.get(c, 0) / most) for c, most in ((1, POSITIVES), (0, NEGATIVES))]
    taken = taken.withColumn("stands_for", F.when(F.col("toxic") == 1, share[0]).otherwise(share[1]))
    taken = stage(taken, "toxicity-sample")  # at most POSITIVES + NEGATIVES rows
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    met = texts.join(F.broadcast(taken), "id").groupBy(*taken.columns).agg(F.min("text").alias("text"))
    met = met.withColumn("words", F.split(F.lower("text"), r"[^\p{L}]+"))
    last = F.greatest(F.size("words") - 2, F.lit(1))
    pieces = F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice("words", i, F.lit(3))))
    return stage(
        met.withColumn("group", F.array_min(pieces)).withColumn("words", F.array_distinct("words")), "toxicity-texts"
    )


def choose_terms(rows: DataFrame) -> list[str]:
    """The terms most unevenly found in toxic texts, counted by groups; at most TERMS."""
    base = rows.agg(F.avg("toxic")).first()[0]
    if not base or base == 1:
        return []
    def of_word(word):
        starts = [F.when(F.length(word) > size, F.substring(word, 1, size)) for size in PREFIXES]
        return F.array(F.concat(word, F.lit(END)), *starts)

    terms = F.array_distinct(F.flatten(F.transform(F.filter("words", lambda w: w != ""), of_word)))
    per_group = rows.select("group", "toxic", F.explode(terms).alias("term")).where("term IS NOT NULL").groupBy("term", "group").agg(
        F.avg("toxic").alias("share")
    )
    n, hits = F.count(F.lit(1)), F.sum("share")
    z = (hits - base * n) / F.sqrt(F.lit(base * (1 - base)) * n)
    found = per_group.groupBy("term").agg(n.alias("groups"), z.alias("z"))
    found = found.where((F.col("groups") >= LEAST_GROUPS) & (F.col("z") >= LEAST_Z)).orderBy(F.desc("z"), "term").limit(TERMS)
    return [r.term for r in found.collect()]


def fit(docs: DataFrame, labels: DataFrame) -> Chain:
    """The chain from the labelled sample; what reaches the driver is bounded by its rows and TERMS."""
    rows = training_rows(docs, labels)
    terms = choose_terms(rows)
    base = rows.agg(F.sum(F.col("toxic") * F.col("stands_for")) / F.sum("stands_for")).first()[0] or 0.0
    if not terms:
        return Chain([], [], 1.0, base)
    found = rows.select("id", "text").mapInArrow(_feature_batches(terms), "id long, features array<float>")
    sample = rows.select("id", "group", "toxic", "low_quality", "stands_for").join(found, "id").orderBy("id").toPandas()
    x = np.stack(sample["features"].to_list())
    toxic = sample["toxic"].to_numpy(int)
    groups = sample["group"].fillna(0).to_numpy()
    truth = np.zeros((len(x), len(CHAIN)), int)
    truth[:, 0], truth[:, -1] = sample["low_quality"].to_numpy(int), toxic
    mine = np.flatnonzero(toxic)
    _, member, sizes = np.unique(groups[mine], return_inverse=True, return_counts=True)
    truth[mine, 1 + find_kinds(x[mine, : len(terms)], 1 / sizes[member])] = 1
    return fit_chain(x, truth, groups, terms, sample["stands_for"].to_numpy())


def _automaton(terms: Sequence[str]):
    import ahocorasick

    machine = ahocorasick.Automaton()
    by_text: dict[str, list[tuple[int, bool]]] = {}
    for i, term in enumerate(terms):
        by_text.setdefault(term.removesuffix(END), []).append((i, term.endswith(END)))
    for text, places in by_text.items():
        machine.add_word(text, (len(text), places))
    machine.make_automaton()
    return machine


def features(text: str, machine, terms: int) -> np.ndarray:
    """Whether each term opens or makes a word, and its share of all words up to FULL_SHARE."""
    text = text.lower()
    counts = np.zeros(terms, np.float32)
    for end, (size, places) in machine.iter(text):
        if end >= size and text[end - size].isalpha():
            continue
        closed = end + 1 == len(text) or not text[end + 1].isalpha()
        for i, whole in places:
            if closed == whole:
                counts[i] += 1
    share = np.minimum(counts / (FULL_SHARE * max(1, len(text.split()))), 1) if counts.any() else counts
    return np.concatenate([counts > 0, share]).astype(np.float32)


def _feature_batches(terms: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _automaton(terms)
        for batch in batches:
            rows = [features(t.as_py(), machine, len(terms)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float32()))], ["id", "features"])

    return run


class Scorer:
    """Scores batches of texts in one task."""

    def __init__(self, chain: Chain):
        self.chain = chain
        self.machine = _automaton(chain.terms) if chain.terms else None

    def __call__(self, texts: pa.Array) -> np.ndarray:
        size = len(self.chain.terms)
        if not self.machine or not len(texts):
            return self.chain.scores(np.zeros((len(texts), 2 * size), np.float32))
        return self.chain.scores(np.stack([features(t.as_py() or "", self.machine, size) for t in texts]))


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """(doc_id, one probability per category of CHAIN, toxic) of every row."""
    names = [f"p_{c}" for c in CHAIN]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(chain)
        for batch in batches:
            p = scorer(batch.column(1))
            toxic = (p[:, -1] >= chain.threshold) & bool(chain.weights)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(p[:, i]) for i in range(len(CHAIN))], pa.array(toxic)], ["doc_id", *names, "toxic"]
            )

    schema = "doc_id long, " + ", ".join(f"{n} double" for n in names) + ", toxic boolean"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the chain doesn't reject, with all their columns."""
    chain = fit(docs, labels)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(chain)
        for batch in batches:
            p = scorer(batch.column("text"))
            yield batch.filter(pa.array(p[:, -1] < chain.threshold)) if chain.weights else batch

    return docs.mapInArrow(clean, docs.schema)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))
