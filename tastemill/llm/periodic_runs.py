"""Runs: stretches of words that repeat with a smallest period at least LEAST_REPEATS times.

Periods fall into octaves [s, 2s). For an octave a document is cut at every s-th word; a run of it
holds at least three such boundaries. The Z-function of the words from a boundary tells how long
each period of the octave lasts from there, and a comparison backwards where it began. Periods
whose first words already differ drop out for all boundaries at once.

Documents of up to ``tile`` words are one tile for all octaves. Longer ones are exploded into overlapping
tiles, common to the octaves up to tile / 16 and growing with s beyond, which are dealt over all tasks and
solved apart. What comes out are fragments, intervals of one period. They are shuffled by document and period, where those
that overlap by a period or more are stitched to maximal runs.

A tile starts every 16 s words and is 24 s long. A run that goes on in the next tile
overlaps it by 8 s, more than four periods, so no fragment of a run is too short to be found, and a run has one period
in all its tiles. Exact for every length; work is n log n words, also for texts of one repeated word.

Texts are cut into words, numbered and solved as Arrow columns; no word becomes a Python object unless a run drops
neighbours of it. Null texts have no words. Rows with a null or repeated doc_id are documents of their own. Repeated rows each give their row, of
runs with the same length the one that starts first and then has the smaller period is named. Only the named id
and text columns are read, whatever else a table has. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tastemill.llm.common import stage, table

LEAST_REPEATS = 4
LEAST_WORDS = 6
TILE = 1 << 14  # words of a document that one row may hold, and words between the starts of two tiles
STARTS, OVERLAP = 16, 8  # a tile of octave s starts every STARTS * s words and has OVERLAP * s more
BATCH_BYTES = 1 << 23  # bytes of text that are solved at a time
FRAGMENT = "struct<period:int,start:long,stop:long>"


def z_function(w: list[int], upto: int) -> list[int]:
    """How many symbols from each place below ``upto`` equal the beginning; linear in the length of ``w``."""
    n = len(w)
    z = [0] * min(upto, n)
    left = right = 0
    for i in range(1, len(z)):
        k = min(right - i, z[i - left]) if i < right and i - left < len(z) else 0
        if i + k >= right:
            k = max(right - i, 0)
            while i + k < n and w[k] == w[i + k]:
                k += 1
            left, right = i, i + k
        z[i] = k
    return z


def common_prefix(a: np.ndarray, b: np.ndarray) -> int:
    """Equal symbols at the beginning of both; reads in growing pieces."""
    n, done, size = min(len(a), len(b)), 0, 64
    while done < n:
        differ = a[done : min(done + size, n)] != b[done : min(done + size, n)]
        if differ.any():
            return done + int(differ.argmax())
        done, size = done + size, size * 2
    return n


def prime_factors(n: int) -> list[int]:
    out, p = [], 2
    while p * p <= n:
        if n % p == 0:
            out.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return out + [n] if n > 1 else out


def octave_runs(w: np.ndarray, s: int) -> list[tuple[int, int, int]]:
    """(period, start, stop) of the maximal repetitions in ``w`` with a smallest period q in [s, 2s) and 4q symbols or more.

    From the first boundary b of a run, period q goes on for 3q - s symbols or more. If two periods of an
    octave do so at one boundary, both stretches have their common divisor as a period, so neither is a run of
    this octave: at most one period per boundary is followed to its ends.
    """
    n, found = len(w), []
    if n <= s:
        return found
    place = np.flatnonzero(np.repeat(w[::s], s)[: n - s] == w[s:]) + s  # a boundary and a place one block later
    for d in sorted({1, 2, 3, s // 2, s - 1, s, 3 * s // 2, 2 * s - 1}):
        if 0 < d < 2 * s:
            place = place[place + d < n]
            place = place[w[place // s * s - s + d] == w[place + d]]
    boundary = place // s * s - s
    edges = np.flatnonzero(np.diff(boundary, prepend=-1, append=-1)).tolist()
    periods, boundary = (place - boundary).tolist(), boundary.tolist()
    reach: dict[int, int] = {}  # period: where a stretch that was looked at ends, or is known to go on to
    for low, high in zip(edges, edges[1:]):
        b, here = boundary[low], periods[low:high]
        fresh = {q for q in here if reach.get(q, -1) <= b}
        if not fresh:
            continue
        window = w[b : b + 8 * s]
        if len(here) == 1:
            z = {here[0]: common_prefix(window, window[here[0] :])}
        else:
            table = z_function(window.tolist(), 2 * s)
            z = {q: table[q] for q in here}
        for q in here:
            reach[q] = max(reach.get(q, -1), b + z[q])
        lasting = [q for q in here if z[q] >= 3 * q - s]
        if len(lasting) != 1 or lasting[0] not in fresh:
            continue
        q = lasting[0]
        if any(np.array_equal(w[b : b + q], w[b + q // r : b + q // r + q]) for r in prime_factors(q)):
            continue
        after = z[q] + common_prefix(w[b + z[q] :], w[b + z[q] + q :])
        before = common_prefix(w[:b][::-1], w[: b + q][::-1])
        reach[q] = b + after
        if before + after + q >= LEAST_REPEATS * q:
            found.append((q, b - before, b + q + after))
    return found


def octaves(words: int) -> list[int]:
    """The octaves whose periods can repeat often enough in so many words."""
    out = []
    while (s := 1 << len(out)) * LEAST_REPEATS <= words:
        out.append(s)
    return out


def solve(codes: np.ndarray, offsets: np.ndarray, wanted: Callable[[int], list[int]] = octaves) -> Iterator[tuple[int, int, int, int]]:
    """(row, period, start, stop) of rows of symbols. Rows lie side by side, longest first, parted by symbols of their own."""
    lengths = np.diff(offsets)
    order = np.argsort(-lengths, kind="stable")
    lengths, sources = lengths[order], offsets[:-1][order]
    starts = np.cumsum(lengths + 1) - (lengths + 1)
    w = np.empty(int(lengths.sum()) + len(lengths), np.int32)
    inside = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    w[np.repeat(starts, lengths) + inside] = codes[np.repeat(sources, lengths) + inside]
    w[starts + lengths] = -1 - np.arange(len(lengths))
    for s in wanted(int(lengths[0]) if len(lengths) else 0):
        rows = int(np.searchsorted(-lengths, -max(LEAST_REPEATS * s, LEAST_WORDS), "right"))
        if not rows:
            continue
        for q, start, stop in octave_runs(w[: starts[rows - 1] + lengths[rows - 1] + 1], s):
            row = int(np.searchsorted(starts, start, "right")) - 1
            yield int(order[row]), q, start - int(starts[row]), stop - int(starts[row])


def split_words(texts: pa.Array) -> pa.ListArray:
    """The words of each text, parted by ASCII white space; null texts have none."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    sizes = pc.list_value_length(split).to_numpy(zero_copy_only=False)
    words = split.flatten()
    real = pc.not_equal(words, "")
    before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    ends = before[np.concatenate([[0], np.cumsum(sizes)])]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), words.filter(real))


def repeat_words(words: pa.ListArray, seeds: pa.Array) -> pa.ListArray:
    """Rows with a seed g and n words repeat from word a = g % n on with period 1 + (n - a) // (3 + g % 8)."""
    ends = words.offsets.to_numpy()
    places = np.arange(ends[-1])
    for row in np.flatnonzero(seeds.is_valid().to_numpy(zero_copy_only=False)).tolist():
        n, g = int(ends[row + 1] - ends[row]), seeds[row].as_py()
        if n:
            a = g % n
            first = int(ends[row]) + a
            places[first : ends[row + 1]] = first + np.arange(n - a) % (1 + (n - a) // (3 + g % 8))
    return pa.ListArray.from_arrays(words.offsets, words.values.take(pa.array(places)))


def _codes(words: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Words as numbers, equal where the words are, and the ends of the rows."""
    lengths = pc.list_value_length(words).to_numpy(zero_copy_only=False)
    codes = words.flatten().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    return codes, np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with BATCH_BYTES bytes of text or one row each."""
    low, ends = 0, np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    while low < batch.num_rows:
        before = int(ends[low - 1]) if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + BATCH_BYTES, "right")))
        yield batch.slice(low, high - low)
        low = high


def _scan_texts(tile: int):
    """Rows with all their fragments; of up to ``tile`` words, and without any, only a digest of the words stays.

    Longer rows keep their words and have null for fragments.
    """
    kind = pa.list_(pa.struct([("period", pa.int32()), ("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in _slices(batch):
                words = repeat_words(split_words(piece.column("text")), piece.column("seed"))
                n = pc.list_value_length(words).to_numpy(zero_copy_only=False)
                codes, ends = _codes(words)
                short = np.flatnonzero(n <= tile)
                if len(short) < len(n):
                    codes, ends = codes[np.repeat(n <= tile, n)], np.concatenate([[0], np.cumsum(n[short])]).astype(np.int64)
                found: list[list | None] = [None] * len(n)
                for row in short.tolist():
                    found[row] = []
                for row, q, start, stop in solve(codes, ends):
                    found[short[row]].append({"period": q, "start": start, "stop": stop})
                keep = pa.array([f is None or bool(f) for f in found], pa.bool_())
                joined = pc.binary_join(words, " ")
                whole = [None if k else hashlib.sha256(t.as_buffer()).hexdigest() for k, t in zip(keep.to_pylist(), joined)]
                yield pa.RecordBatch.from_arrays([
                    piece.column("doc_id"), pa.array(n, pa.int32()), pa.array(whole, pa.string()),
                    pc.if_else(keep, words, pa.scalar(None, words.type)), pa.array(found, kind),
                ], ["doc_id", "n", "whole", "words", "fragments"])

    return run


def long_tiles(rows: DataFrame, tile: int) -> DataFrame:
    """(uid, level, offset, words): level 0 has the octaves up to tile / STARTS, level j that times 2^j alone."""
    shared = tile // STARTS
    most = F.floor(F.log2(F.greatest(F.col("n") / F.lit(LEAST_REPEATS * shared), F.lit(1.0)))).cast("int")
    levels = rows.select("uid", "n", "words", F.explode(F.sequence(F.lit(0), most)).alias("level"))
    scale = F.pow(F.lit(2), F.col("level")).cast("int")
    step = scale * tile
    tiles = levels.select("*", F.explode(F.sequence(F.lit(0), F.col("n") - 1, step)).alias("offset"))
    length = step + scale * (shared * OVERLAP)
    return tiles.select("uid", "level", "offset", F.slice("words", F.col("offset") + 1, length).alias("words"))


def _scan_tiles(tile: int):
    shared = tile // STARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for i in range(batch.num_rows):
                uid, level, offset = (batch.column(c)[i].as_py() for c in ("uid", "level", "offset"))
                octave = shared << level
                def wanted(words):
                    return octaves(min(words, LEAST_REPEATS * shared)) if not level else [octave]
                for _, q, start, stop in solve(*_codes(batch.column("words").slice(i, 1)), wanted):
                    for column, value in zip(out, (uid, q, offset + start, offset + stop)):
                        column.append(value)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds)], ["uid", "period", "start", "stop"]
            )

    return run


def stitch(fragments: DataFrame) -> DataFrame:
    """(uid, period, start, length) of the maximal runs: fragments that overlap by a period or more are one run.

    A group is one period of one document and holds at most its tiles' fragments.
    """
    so_far = Window.partitionBy("uid", "period").orderBy("start", "stop")
    reached = F.max("stop").over(so_far.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.when(F.col("start") + F.col("period") > F.coalesce(reached, F.lit(-1)), 1).otherwise(0)
    numbered = fragments.withColumn("apart", apart).withColumn("run", F.sum("apart").over(so_far))
    runs = numbered.groupBy("uid", "period", "run").agg(
        F.min("start").alias("start"), (F.max("stop") - F.min("start")).alias("length")
    )
    return runs.where(F.col("length") >= F.greatest(F.lit(LEAST_WORDS), F.col("period") * LEAST_REPEATS)).drop("run")


def _collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of the words that no run drops: a run keeps its first period."""
    for batch in batches:
        digests = []
        for i in range(batch.num_rows):
            words, runs = batch.column("words")[i].values, batch.column("runs")[i].as_py() or []
            keep = np.ones(len(words), bool)
            for run in runs:
                keep[run["start"] + run["period"] : run["start"] + run["length"]] = False
            text = " ".join(words.filter(pa.array(keep)).to_pylist())
            digests.append(hashlib.sha256(text.encode()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("runs"), pa.array(digests, pa.string())], ["doc_id", "runs", "collapsed_sha256"]
        )


def periodic_runs(rows: DataFrame, tile: int = TILE) -> DataFrame:
    """(doc_id, runs, collapsed_sha256) for rows of (doc_id, text, seed): runs as structs of start, length and period, in order.

    The seed is null, or a number by which the words are repeated first, see ``repeat_words``.
    """
    if tile % STARTS or tile < STARTS:
        raise ValueError(f"tile must be a multiple of {STARTS}")
    scanned = rows.select("doc_id", "text", "seed").mapInArrow(
        _scan_texts(tile), f"doc_id long, n int, whole string, words array<string>, fragments array<{FRAGMENT}>"
    )
    # Written once, so that a row's number stays its own.
    docs = stage(scanned.withColumn("uid", F.monotonically_increasing_id()), "runs-documents")
    tiles = long_tiles(docs.where("fragments IS NULL"), tile).repartition("uid", "level", "offset")
    fragments = docs.where("size(fragments) > 0").select("uid", F.inline("fragments")).unionByName(
        tiles.mapInArrow(_scan_tiles(tile), "uid long, period int, start long, stop long")
    )
    run = F.struct("start", "length", F.col("period").cast("long").alias("period"))
    per_doc = stitch(fragments).groupBy("uid").agg(F.sort_array(F.collect_list(run)).alias("runs"))
    kind = "array<struct<start:long,length:long,period:long>>"
    met = docs.where("words IS NOT NULL").select("uid", "doc_id", "words").join(per_doc, "uid", "left")
    solved = met.select("doc_id", "words", F.coalesce("runs", F.array().cast(kind)).alias("runs")).mapInArrow(
        _collapsed, f"doc_id long, runs {kind}, collapsed_sha256 string"
    )
    plain = docs.where("words IS NULL").select(
        "doc_id", F.array().cast(kind).alias("runs"), F.col("whole").alias("collapsed_sha256")
    )
    return solved.unionByName(plain)


def seeded_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text, seed): by its id's checksum a tenth of the documents has a seed."""
    h = F.crc32(F.col("doc_id").cast("string"))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.when(h % 10 == 0, F.floor(h / 10)).cast("long").alias("seed"),
    )


def digest_rows(found: DataFrame) -> DataFrame:
    """Number of runs, the longest one and digests, one row per document."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("s"), (-r.period).alias("q"))))
    lines = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r.start, r.length, r.period))
    return found.select("doc_id", "runs", "collapsed_sha256", best.alias("best")).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.q")).alias("period"),
        F.floor(F.col("best.length") * 1000 / -F.col("best.q")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), "collapsed_sha256",
    )


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_rows(periodic_runs(seeded_texts(table(spark, sf_dir, "documents"))))
