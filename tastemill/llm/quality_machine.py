"""Quality scores by a factorisation machine over hashed words, structure statistics and metadata.

A document is a sparse vector: its words hashed into BUCKETS (logarithm of the count, scaled to length one), and
statistics of its structure (share of capitals, marks, repeated words, pairs and lines, ...) and of its metadata
(the stated n_chars), each split between the two nearest of its knots. The score is the logistic function of
a bias, a weight per feature and, for each pair of features, the product of their values and of
the inner product of their FACTORS-long vectors. All pairs together cost linear time: per factor
half of (sum of v x)^2 - sum of (v x)^2.

Training takes at most PER_CLASS distinct labelled texts of each class, those with the least digests; a class cut
to that counts with the weight of all its texts. Equal texts are one, with the mean of their labels (1 from a half on), so
groups of copies of any size weigh as one. Rows whose crc32(doc_id as text) mod 3 is 1 are held out: their labels are
never read, nor is a text whose only labelled copies are held out. Labels with a null id or value are none.
Labels, lang, source and doc_id are no features.

Every row is scored over its whole text; scores don't depend on the rows beside it. Null texts are empty texts; a missing n_chars
counts as the text's length; rows without a doc_id aren't held out, can't be labelled and are scored. Repeated
ids and rows are each scored, ties in the sample's order can't arise between distinct texts, other columns are
ignored whatever their names. Without labels of both classes every score is the share of label 1, or 0.5 without
any. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemill.llm.common import ASCII_UPPER, stage, table

PER_CLASS = 4000
BUCKETS = 1 << 12
FACTORS = 8
KNOTS = 17
STATS = (
    "words", "word_length", "capitals", "digits", "marks", "stops", "distinct_words", "same_as_before", "distinct_pairs",
    "commonest", "lines", "distinct_lines", "stated_chars", "chars_off",
)
EPOCHS, RATE, BATCH = 40, 0.02, 128
SHRINK = 2e-4
SLICE_WORDS = 1 << 20
SPACES = r"[\x20\x09-\x0D]+"


@dataclass
class Machine:
    knots: list[np.ndarray]  # per statistic
    bias: float
    weights: np.ndarray
    factors: np.ndarray  # features x FACTORS

    def score(self, sparse: Sparse) -> np.ndarray:
        if not len(self.weights):
            return np.full(len(sparse.ends), sigmoid(np.float64(self.bias)))
        return sigmoid(margin(self.bias, self.weights, self.factors, sparse)[0])


@dataclass
class Sparse:
    """Rows of (feature, value), each with an entry or more; ``ends`` holds where each row stops."""

    features: np.ndarray
    values: np.ndarray
    ends: np.ndarray

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate([[0], self.ends[:-1]]).astype(np.int64)

    def rows(self, which: np.ndarray) -> Sparse:
        starts, lengths = self.starts[which], (self.ends - self.starts)[which]
        inside = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        entries = np.repeat(starts, lengths) + inside
        return Sparse(self.features[entries], self.values[entries], np.cumsum(lengths))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def margin(bias: float, weights: np.ndarray, factors: np.ndarray, x: Sparse) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The machine's value per row, with v x per entry and its sum per row."""
    parts = factors[x.features] * x.values[:, None]
    sums = np.add.reduceat(parts, x.starts)
    linear = np.add.reduceat(weights[x.features] * x.values, x.starts)
    pairs = (sums ** 2 - np.add.reduceat(parts ** 2, x.starts)).sum(axis=1) / 2
    return bias + linear + pairs, parts, sums


def fit_machine(x: Sparse, y: np.ndarray, weight: np.ndarray, knots: list[np.ndarray], size: int) -> Machine:
    """Logistic loss by Adam over fixed batches of rows; the same rows in the same order give the same machine."""
    draw = np.random.default_rng(11)
    order = draw.permutation(len(y))
    batches = []
    for low in range(0, len(order), BATCH):
        rows = order[low : low + BATCH]
        part = x.rows(rows)
        by_feature = np.argsort(part.features, kind="stable")
        met, first = np.unique(part.features[by_feature], return_index=True)
        owner = np.repeat(np.arange(len(rows)), np.diff(part.ends, prepend=0))
        batches.append((rows, part, owner, by_feature, met, first))
    # One table of parameters: the weight and the factors of each feature, and the bias in a last row.
    params = np.zeros((size + 1, 1 + FACTORS), np.float64)
    params[:-1, 1:] = draw.normal(0, 0.05, (size, FACTORS))
    mean, square = np.zeros_like(params), np.zeros_like(params)
    weight = weight / weight.mean()
    step = 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for rows, part, owner, by_feature, met, first in batches:
            step += 1
            value, parts, sums = margin(params[-1, 0], params[:-1, 0], params[:-1, 1:], part)
            error = weight[rows] * (sigmoid(value) - y[rows]) / len(rows)
            pull = (error[owner] * part.values)[:, None]
            entry = np.hstack([pull, pull * (sums[owner] - parts)])
            slope = np.zeros((len(met) + 1, 1 + FACTORS))
            slope[:-1] = np.add.reduceat(entry[by_feature], first)
            touched = np.append(met, size)
            slope[:-1] += SHRINK * params[met]
            slope[-1, 0] = error.sum()
            mean[touched] = 0.9 * mean[touched] + 0.1 * slope
            square[touched] = 0.99 * square[touched] + 0.01 * slope ** 2
            params[touched] -= rate * (mean[touched] / (1 - 0.9 ** step)) / (np.sqrt(square[touched] / (1 - 0.99 ** step)) + 1e-8)
    return Machine(knots, float(params[-1, 0]), params[:-1, 0].copy(), params[:-1, 1:].copy())


def structure(docs: DataFrame) -> list[Column]:
    """(words, chars, capitals, lines, distinct_lines, stated) of each whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines, chars = F.split(text, "\n"), F.length(text)
    stated = F.coalesce(F.col("n_chars").cast("double"), chars.cast("double")) if "n_chars" in docs.columns else chars.cast("double")
    return [
        F.array_remove(F.split(text, SPACES), "").alias("words"), chars.cast("double").alias("chars"),
        (chars - F.length(F.translate(text, ASCII_UPPER, ""))).cast("double").alias("capitals"),
        F.size(lines).cast("double").alias("lines"), F.size(F.array_distinct(lines)).cast("double").alias("distinct_lines"),
        stated.alias("stated"),
    ]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _shares(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _distinct_per_row(owner: np.ndarray, keys: np.ndarray, rows: int, top: bool = False) -> np.ndarray:
    """Distinct keys of each row, or how often its commonest one is there; keys are whole numbers from 0."""
    if not len(keys):
        return np.zeros(rows)
    joined = np.sort(owner * (int(keys.max()) + 1) + keys)
    edges = np.flatnonzero(np.diff(joined, prepend=joined[0] - 1))
    owners = joined[edges] // (int(keys.max()) + 1)
    if not top:
        return np.bincount(owners, minlength=rows).astype(np.float64)
    counts = np.diff(edges, append=len(joined))
    out = np.zeros(rows)
    np.maximum.at(out, owners, counts)
    return out


def describe(batch: pa.RecordBatch) -> tuple[np.ndarray, Sparse]:
    """(statistics, hashed words) of rows with the columns of ``structure``; a row without words has one empty entry."""
    words = batch.column("words")
    rows = len(words)
    sizes = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = words.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(rows), sizes)

    def total(pattern: str | None) -> np.ndarray:
        per_word = pc.count_substring_regex(coded.dictionary, pattern) if pattern else pc.utf8_length(coded.dictionary)
        per_word = per_word.to_numpy(zero_copy_only=False)
        return np.bincount(owner, per_word[codes], rows) if len(codes) else np.zeros(rows)

    column = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("chars", "capitals", "lines", "distinct_lines", "stated")}
    letters = total(None)
    repeats = np.zeros(rows)
    pairs = np.zeros(rows)
    if len(codes) > 1:
        joint = owner[1:] == owner[:-1]
        repeats = np.bincount(owner[1:][joint & (codes[1:] == codes[:-1])], minlength=rows)
        # A pair's number is below 2^63 / rows: two words of one slice, renumbered by their first appearance.
        _, pair = np.unique(codes[:-1][joint] * (int(codes.max()) + 1) + codes[1:][joint], return_inverse=True)
        pairs = _distinct_per_row(owner[1:][joint], pair, rows)
    off = np.abs(column["stated"] - column["chars"]) > 0
    stats = np.stack([
        np.log1p(sizes), _shares(letters, sizes), _shares(column["capitals"], column["chars"]),
        _shares(total("[0-9]"), letters), _shares(total(r"[^\pL\pN\pM.,;:'’-]"), letters), _shares(total("[.,;:]"), sizes),
        _shares(_distinct_per_row(owner, codes, rows), sizes), _shares(repeats, sizes - 1), _shares(pairs, sizes - 1),
        _shares(_distinct_per_row(owner, codes, rows, top=True), sizes), np.log1p(_shares(sizes, column["lines"])),
        _shares(column["distinct_lines"], column["lines"]), np.log1p(np.maximum(column["stated"], 0)), off.astype(np.float64),
    ], axis=1)
    hashes = np.array([zlib.crc32(w.encode()) for w in coded.dictionary.to_pylist()], np.int64) % BUCKETS
    keys = np.concatenate([owner * BUCKETS + (hashes[codes] if len(codes) else codes), np.flatnonzero(sizes == 0) * BUCKETS])
    keys, counts = np.unique(keys, return_counts=True)
    of_row = keys // BUCKETS
    values = np.where(sizes[of_row] == 0, 0.0, np.log1p(counts))
    norm = np.sqrt(np.bincount(of_row, values ** 2, rows))
    ends = np.searchsorted(of_row, np.arange(rows), "right")
    return stats, Sparse(keys % BUCKETS, values / np.maximum(norm, 1e-12)[of_row], ends)


def choose_knots(stats: np.ndarray) -> list[np.ndarray]:
    return [np.unique(np.quantile(column, np.linspace(0, 1, KNOTS))) for column in stats.T]


def with_stats(words: Sparse, stats: np.ndarray, knots: list[np.ndarray]) -> Sparse:
    """Adds to each row its statistics, two entries each: the shares of the knots on both sides."""
    features, values, low = [], [], BUCKETS
    for column, places in zip(stats.T, knots):
        at = np.interp(column, places, np.arange(len(places)))
        left = at.astype(np.int64)
        right = np.minimum(left + 1, len(places) - 1)
        features += [low + left, low + right]
        values += [1 - (at - left), at - left]
        low += len(places)
    extra = len(features)
    lengths = words.ends - words.starts
    ends = np.cumsum(lengths + extra)
    out = Sparse(np.empty(ends[-1] if len(ends) else 0, np.int64), np.empty(ends[-1] if len(ends) else 0), ends)
    heads = out.starts[:, None] + np.arange(extra)
    body = np.ones(len(out.features), bool)
    body[heads.ravel()] = False
    out.features[heads.ravel()], out.values[heads.ravel()] = np.stack(features, 1).ravel(), np.stack(values, 1).ravel()
    out.features[body], out.values[body] = words.features, words.values
    return out


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    ends = np.cumsum(pc.list_value_length(batch.column("words")).to_numpy(zero_copy_only=False))
    low = 0
    while low < batch.num_rows:
        before = int(ends[low - 1]) if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + SLICE_WORDS, "right")))
        yield batch.slice(low, high - low)
        low = high


def _describe_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training rows: (digest, label, stands_for, stats, features, values)."""
    for batch in batches:
        for piece in _slices(batch):
            stats, words = describe(piece)
            offsets = pa.array(np.concatenate([[0], words.ends]), pa.int32())
            yield pa.RecordBatch.from_arrays([
                *[piece.column(c) for c in ("digest", "label", "stands_for")], pa.array(list(stats), pa.list_(pa.float64())),
                pa.ListArray.from_arrays(offsets, pa.array(words.features, pa.int32())),
                pa.ListArray.from_arrays(offsets, pa.array(words.values, pa.float64())),
            ], ["digest", "label", "stands_for", "stats", "features", "values"])


def training_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(digest, label, stands_for): the sample of distinct labelled texts, at most 2 * PER_CLASS rows, staged."""
    truth = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    truth = truth.where(~held_out(F.col("doc_id"))).select(F.col("doc_id").cast("long").alias("id"), "quality")
    truth = truth.groupBy("id").agg(F.avg("quality").alias("quality"))
    digest = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), digest.alias("digest")).where("id IS NOT NULL").distinct()
    per_text = texts.join(truth, "id").groupBy("digest").agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    per_text = stage(per_text, "quality-labels")
    counts = {r.label: r["count"] for r in per_text.groupBy("label").count().collect()}
    taken = per_text.where("label = 1").orderBy("digest").limit(PER_CLASS).unionByName(
        per_text.where("label = 0").orderBy("digest").limit(PER_CLASS)
    )
    share = [max(1.0, counts.get(c, 0) / PER_CLASS) for c in (1, 0)]
    return stage(taken.withColumn("stands_for", F.when(F.col("label") == 1, share[0]).otherwise(share[1])), "quality-sample")


def fit(docs: DataFrame, labels: DataFrame) -> Machine:
    """The machine from the labelled sample; the driver gets at most 2 * PER_CLASS rows of at most BUCKETS features."""
    taken = training_texts(docs, labels)
    digest = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    # One row per text: of equal texts that with the least stated length.
    keys = F.broadcast(taken.select([F.col(c).alias(n) for c, n in zip(taken.columns, ("_of", "_label", "_stands_for"))]))
    carried = [c for c in ("text", "n_chars") if c in docs.columns]
    known = docs.select(*carried, digest.alias("_digest")).join(keys, F.col("_digest") == F.col("_of"))
    stated = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    texts = known.groupBy("_of", "_label", "_stands_for").agg(F.min("text").alias("text"), F.min(stated).alias("n_chars"))
    found = texts.select(
        F.col("_of").alias("digest"), F.col("_label").alias("label"), F.col("_stands_for").alias("stands_for"), *structure(texts)
    ).mapInArrow(
        _describe_batches,
        "digest string, label int, stands_for double, stats array<double>, features array<int>, values array<double>",
    ).orderBy("digest").toArrow()
    y = found.column("label").to_numpy().astype(np.float64)
    weight = found.column("stands_for").to_numpy()
    if not len(y) or y.min() == y.max():
        share = 0.5 if not len(y) else y[0]
        return Machine([], float(np.log((share + 1e-9) / (1 - share + 1e-9))), np.zeros(0), np.zeros((0, FACTORS)))
    stats = np.stack(found.column("stats").to_pylist())
    lists = found.column("features").combine_chunks()
    ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)).astype(np.int64)
    words = Sparse(
        lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
        found.column("values").combine_chunks().flatten().to_numpy(zero_copy_only=False), ends,
    )
    knots = choose_knots(stats)
    size = BUCKETS + sum(map(len, knots))
    return fit_machine(with_stats(words, stats, knots), y, weight, knots, size)


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in _slices(batch):
                stats, words = describe(piece)
                p = machine.score(with_stats(words, stats, machine.knots) if machine.knots else words)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), piece.column("held_out"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                    ["doc_id", "held_out", "score", "predicted"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), *structure(docs))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def op11_quality_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))
