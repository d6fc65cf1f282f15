"""Every user's best items of all, exactly: factors meet in blocks, and what falls below a user's bar leaves at once.

Users are dealt into blocks, items into slices of smaller blocks that are written once. A task takes one block of users and
one slice: each block of items gives a matrix of products, of which only what reaches the user's bar, the score of the last
of the best so far, is looked at. A task gives a list per user, and a block's lists of all slices are cut to one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemill.session import ensure_checkpoints

SLICE_BYTES = 1 << 28  # item factors that a task's side of the product holds
STATE_BYTES = 1 << 27  # places for the best items of a block of users
ITEM_BYTES = 1 << 20  # item factors of a block
ITEM_ROWS, USER_ROWS = 1 << 11, 1 << 9  # items and users whose products are held at once
ROOM = 4  # places per place in the pool: bars rise once these are full
LEAST_USERS = 1 << 10  # fewer in a block are not worth a task of their own
PAIR_ROWS, CHECK_ROWS = 1 << 20, 1 << 13  # pairs of a block of users, and those whose factors are held at once
SCORE_TOLERANCE = 1e-4
PACKED = ("asked", "wanted", "scores", "owners", "of_users")
PARTIAL = "block int, users binary, depths binary, counts binary, items binary, scores binary"
SCORED = "user_id int, item_id int, score float, place int, depth int"


class Best:
    """The ``pool`` best items for each of ``rows`` users, ties to the lower item; a score that isn't a number ranks first."""

    def __init__(self, rows: int, pool: int, room: int):
        self.pool = pool
        self.counts = np.zeros(rows, np.int64)
        self.bars = np.full(rows, -np.inf, np.float32)
        self.items = np.zeros((rows, max(room, pool)), np.int32)
        self.scores = np.full(self.items.shape, -np.inf, np.float32)

    def add(self, rows: np.ndarray, items: np.ndarray, scores: np.ndarray) -> None:
        """Take up items for users that come in ascending order."""
        if not len(rows):
            return
        low, high = rows[0], rows[-1] + 1
        more = np.bincount(rows - low, minlength=high - low)
        full = low + np.flatnonzero(self.counts[low:high] + more > self.items.shape[1])
        self.cut(full)
        lacking = int((self.counts[low:high] + more).max()) - self.items.shape[1]
        if lacking > 0:
            self.items = np.pad(self.items, ((0, 0), (0, lacking)))
            self.scores = np.pad(self.scores, ((0, 0), (0, lacking)), constant_values=-np.inf)
        places = np.arange(len(rows)) + np.repeat(self.counts[low:high] - np.cumsum(more) + more, more)
        self.items[rows, places], self.scores[rows, places] = items, scores
        self.counts[low:high] += more

    def cut(self, rows: np.ndarray) -> None:
        """Leave these users their best items and raise their bars."""
        rows = rows[self.counts[rows] >= self.pool]
        if len(rows) > USER_ROWS:
            for low in range(0, len(rows), USER_ROWS):
                self.cut(rows[low:low + USER_ROWS])
            return
        if not len(rows):
            return
        scores, items, width = self.scores[rows], self.items[rows], self.items.shape[1]
        bars = np.partition(scores, width - self.pool, axis=1)[:, width - self.pool]
        kept = ~(scores < bars[:, None]) & (np.arange(width) < self.counts[rows, None])
        for row in np.flatnonzero(kept.sum(axis=1) > self.pool):
            kept[row] = lowest_ties(scores[row], items[row], kept[row], self.pool)
        at, places = np.nonzero(kept)
        to = np.tile(np.arange(self.pool), len(rows))
        self.scores[rows] = -np.inf
        self.scores[rows[at], to], self.items[rows[at], to] = scores[at, places], items[at, places]
        self.counts[rows], self.bars[rows] = self.pool, bars


def lowest_ties(scores: np.ndarray, items: np.ndarray, kept: np.ndarray, pool: int) -> np.ndarray:
    """Which of the kept places are the ``pool`` best, ties to the lower item."""
    places = np.flatnonzero(kept)
    out = np.zeros(len(kept), bool)
    out[places[np.lexsort((items[places], falling(scores[places])))[:pool]]] = True
    return out


def falling(scores: np.ndarray) -> np.ndarray:
    """A key that sorts the best score first, before it what isn't a number."""
    return np.where(np.isnan(scores), -np.inf, -scores)


def products(users: np.ndarray, items: np.ndarray) -> np.ndarray:
    """All products. A single vector on a side would have its sums in another order, so it comes twice."""
    if len(users) < 2 or len(items) < 2:
        return products(np.repeat(users, 2, axis=0), np.repeat(items, 2, axis=0))[::2, ::2]
    return users @ items.T


def true_places(flags: np.ndarray) -> np.ndarray:
    """``np.flatnonzero`` where few are true: eight are looked at together."""
    if flags.size % 8:
        return np.flatnonzero(flags)
    eights = np.flatnonzero(flags.ravel().view(np.uint64))
    at, places = np.nonzero(flags.reshape(-1, 8)[eights])
    return eights[at] * 8 + places


def meet(best: Best, users: np.ndarray, ids: np.ndarray, items: np.ndarray) -> None:
    """Add a block of items to the lists of a block of users."""
    for first in range(0, len(ids), ITEM_ROWS):
        some, vectors = ids[first:first + ITEM_ROWS], items[first:first + ITEM_ROWS]
        width, last = len(some), len(some) - best.pool
        for low in range(0, len(users), USER_ROWS):
            scores, bars = products(users[low:low + USER_ROWS], vectors), best.bars[low:low + USER_ROWS]
            kept = scores < bars[:, None]
            np.logical_not(kept, out=kept)  # what isn't a number stays
            flat = true_places(kept)
            many = np.flatnonzero(np.bincount(flat // width) > best.pool) if len(flat) > best.pool else ()
            if len(many):
                # More than fit into a list: the last of the best of these is a bar.
                dense = scores[many]
                bars[many] = np.partition(dense, last, axis=1)[:, last]
                kept[many] = ~(dense < bars[many, None])
                for row in many[np.count_nonzero(kept[many], axis=1) > best.pool]:
                    kept[row] = lowest_ties(scores[row], some, kept[row], best.pool)
                flat = np.flatnonzero(kept)
            rows, places = np.divmod(flat, width)
            best.add(low + rows, some[places], scores.ravel()[flat])


def _matrix(column: pa.Array, rank: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, np.float32).reshape(len(column), rank)


def item_blocks(items: DataFrame, rank: int, slices: int) -> DataFrame:
    """(id, features) in ``slices`` partitions of blocks (first, item_ids, item_vectors), by id, written under the shared folder.

    ``first`` tells whether a block is the first of its partition.
    """
    ensure_checkpoints(items.sparkSession)
    step = max(1, ITEM_BYTES // (4 * rank * ITEM_ROWS)) * ITEM_ROWS

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column(0).to_numpy(), _matrix(b.column(1), rank)) for b in batches if b.num_rows]
        if not parts:
            return
        ids, vectors = (np.concatenate(p) for p in zip(*parts))
        parts.clear()
        order = np.argsort(ids, kind="stable")
        for low in range(0, len(ids), step):
            some = order[low:low + step]
            yield pa.RecordBatch.from_arrays(
                [pa.array([low == 0]), *[pa.array([a[some].tobytes()], pa.binary()) for a in (ids, vectors)]],
                ["first", "item_ids", "item_vectors"],
            )

    dealt = items.select(F.col("id").cast("int").alias("id"), "features").repartition(slices, "id")
    return dealt.mapInArrow(block, "first boolean, item_ids binary, item_vectors binary").checkpoint()


def user_block(users: DataFrame, rank: int, blocks: int) -> DataFrame:
    """(id, features, depth) as one row per block: (user_ids, depths, user_vectors), by id; rows of one id share a block."""
    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column(0).to_numpy(), b.column(2).to_numpy(), _matrix(b.column(1), rank)) for b in batches if b.num_rows]
        if parts:
            ids, depths, vectors = (np.concatenate(p) for p in zip(*parts))
            order = np.argsort(ids, kind="stable")
            yield pa.RecordBatch.from_arrays(
                [pa.array([a[order].tobytes()], pa.binary()) for a in (ids, depths, vectors)],
                ["user_ids", "depths", "user_vectors"],
            )

    columns = [F.col("id").cast("int").alias("id"), "features", F.col("depth").cast("int").alias("depth")]
    dealt = users.select(*columns).repartition(blocks, "id")
    return dealt.mapInArrow(block, "user_ids binary, depths binary, user_vectors binary")


def block_pairs(left: DataFrame, items: DataFrame) -> DataFrame:
    """Every row of ``left`` with every block of items, one task per partition of ``left`` and slice of items.

    A row of ``left`` meets a slice's blocks one after the other; its columns come with the first and are null
    with the others, so that they are sent to a task once.
    """
    once = [F.when(F.col("first"), F.col(c)).alias(c) for c in left.columns]
    return left.crossJoin(items.hint("shuffle_replicate_nl")).select(*once, "item_ids", "item_vectors")


def slices_of(items: int, rank: int) -> int:
    return max(1, -(-items * rank * 4 // SLICE_BYTES))


def best_items(users: DataFrame, items: DataFrame, rank: int, pool: int) -> DataFrame:
    """The ``pool`` best items for each of the users, ties to the lower id: (user_id, item_id, score, place, depth).

    ``users`` is (id, features, depth), ``items`` (id, features); a user's depth goes with its rows.
    """
    spark = users.sparkSession
    n_users, n_items = users.count(), items.count()
    pool = max(1, min(pool, n_items))
    room = min(ROOM * pool, max(n_items, pool))
    slices = slices_of(n_items, rank)
    tasks = -(-3 * spark.sparkContext.defaultParallelism // slices)
    user_blocks = max(
        1, -(-n_users // max(1, STATE_BYTES // (8 * room))), min(tasks, -(-n_users // LEAST_USERS))
    )

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed() -> pa.RecordBatch:
            best.cut(np.arange(len(whose)))
            held = np.arange(best.items.shape[1]) < best.counts[:, None]
            columns = (whose, depths, best.counts.astype(np.int32), best.items[held], best.scores[held])
            return pa.RecordBatch.from_arrays(
                [pa.array(whose[:1]), *[pa.array([c.tobytes()], pa.binary()) for c in columns]],
                ["block", "users", "depths", "counts", "items", "scores"],
            )

        best = None
        for batch in batches:
            for n in range(batch.num_rows):
                read = lambda c, kind: np.frombuffer(batch.column(c)[n].as_buffer(), kind)  # noqa: B023, E731
                if batch.column(0)[n].is_valid:
                    if best is not None:
                        yield packed()
                    whose, depths = read(0, np.int32).copy(), read(1, np.int32).copy()
                    vectors = read(2, np.float32).reshape(-1, rank).copy()
                    best = Best(len(whose), pool, room)
                meet(best, vectors, read(3, np.int32), read(4, np.float32).reshape(-1, rank))
        if best is not None:
            yield packed()

    def one_list(parts: pa.Table) -> pa.Table:
        """The lists of a block's users over all slices; the rows of a repeated user are one list."""
        read = lambda name, n, kind: np.frombuffer(parts.column(name)[n].as_buffer(), kind)
        known, at, row = np.unique(read("users", 0, np.int32), return_index=True, return_inverse=True)
        best = Best(len(known), pool, min(room, 2 * pool))
        for n in range(parts.num_rows):
            rows = np.repeat(row, read("counts", n, np.int32))
            best.add(rows, read("items", n, np.int32), read("scores", n, np.float32))
        best.cut(np.arange(len(known)))
        held = np.arange(best.items.shape[1]) < best.counts[:, None]
        rows, found, scores = np.repeat(np.arange(len(known)), best.counts), best.items[held], best.scores[held]
        order = np.lexsort((found, falling(scores), rows))
        place = np.arange(len(rows)) - np.repeat(np.cumsum(best.counts) - best.counts, best.counts) + 1
        depths = read("depths", 0, np.int32)[at]
        columns = (known[rows], found[order], scores[order], place.astype(np.int32), depths[rows])
        return pa.table([pa.array(c) for c in columns], names=["user_id", "item_id", "score", "place", "depth"])

    pairs = block_pairs(user_block(users, rank, user_blocks), item_blocks(items, rank, slices))
    return pairs.mapInArrow(lists, PARTIAL).groupBy("block").applyInArrow(one_list, SCORED)


def pair_products(pairs: DataFrame, users: DataFrame, items: DataFrame, rank: int) -> DataFrame:
    """One row per part of the work: ``pairs`` of a known user and item, and of these ``off``, whose score isn't the
    product of the factors but for SCORE_TOLERANCE.

    ``pairs`` is (user_id, item_id, score); both factor tables are (id, features) with one row per id. No factor is sent
    along with a pair: blocks of users take their pairs along to every slice of items.
    """
    n_users, n_pairs, n_items = users.count(), pairs.count(), items.count()
    blocks = max(1, -(-n_pairs // PAIR_ROWS), -(-n_users * rank * 4 // SLICE_BYTES))
    slices = slices_of(n_items, rank)

    def block(asked: pa.Table, whose: pa.Table) -> pa.Table:
        columns = [asked.column(c).to_numpy() for c in ("user_id", "item_id", "score")]
        order = np.argsort(columns[1], kind="stable")
        columns = [c[order].tobytes() for c in columns]
        vectors = _matrix(whose.column("features").combine_chunks(), rank) if whose.num_rows else np.zeros((0, rank), np.float32)
        ids = whose.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        columns += [ids[order].tobytes(), vectors[order].tobytes()]
        return pa.table([pa.array([c], pa.binary()) for c in columns], names=list(PACKED))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = off = 0
        for batch in batches:
            for n in range(batch.num_rows):
                read = lambda c, kind: np.frombuffer(batch.column(c)[n].as_buffer(), kind)  # noqa: B023, E731
                if batch.column(0)[n].is_valid:
                    asked, wanted, scores = (read(c, kind).copy() for c, kind in enumerate((np.int32, np.int32, np.float64)))
                    owners, of_users = read(3, np.int32).copy(), read(4, np.float32).reshape(-1, rank).copy()
                    row = np.searchsorted(owners, asked)
                    known = np.append(owners, 0)[row] == asked
                    known &= row < len(owners)
                ids, of_items = read(5, np.int32), read(6, np.float32).reshape(-1, rank)
                low, high = np.searchsorted(wanted, ids[0]), np.searchsorted(wanted, ids[-1], "right")
                for start in range(low, high, CHECK_ROWS):
                    some = np.arange(start, min(start + CHECK_ROWS, high))
                    some = some[known[some]]
                    at = np.searchsorted(ids, wanted[some])
                    there = ids[at] == wanted[some]
                    some, at = some[there], at[there]
                    product = np.einsum("ij,ij->i", of_users[row[some]].astype(np.float64), of_items[at].astype(np.float64))
                    met += len(some)
                    off += int((~(np.abs(scores[some] - product) <= SCORE_TOLERANCE * (1 + np.abs(product)))).sum())
        yield pa.RecordBatch.from_arrays([pa.array([met]), pa.array([off])], ["pairs", "off"])

    deal = lambda key: F.pmod(F.xxhash64(F.col(key).cast("int")), F.lit(blocks)).alias("block")
    asked = pairs.select(
        deal("user_id"), F.col("user_id").cast("int"), F.col("item_id").cast("int"),
        F.coalesce(F.col("score").cast("double"), F.lit(float("nan"))).alias("score"),
    ).where("user_id IS NOT NULL AND item_id IS NOT NULL")
    whose = users.select(deal("id"), F.col("id").cast("int"), "features")
    packed = asked.groupBy("block").cogroup(whose.groupBy("block")).applyInArrow(block, ", ".join(f"{c} binary" for c in PACKED))
    return block_pairs(packed, item_blocks(items, rank, slices)).mapInArrow(compare, "pairs long, off long")
