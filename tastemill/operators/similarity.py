"""Similar items: the top-k pairs by Jaccard similarity of their reader sets.

A pair counts when the two sets collide in at least one min-hash table and their
exact Jaccard distance is below the threshold. Sets stay in long form (item, reader)
all the way: signatures and sizes are aggregates, intersections are counts, so a set
with a third of all rows never sits in one row or one task. Work is cut in four ways,
none of which can lose a pair of the answer:

* items with identical sets become one class, and only the top pairs are spelled out;
* a few promising pairs are scored first; the k-th best of them is a floor that
  every pair of the answer must reach;
* candidates are pairs that meet in a bucket (table, hash) of the signature, each in the
  first table in which they collide. In a crowded bucket, and where no collision is asked
  for, they must share a reader among the rarest few of both sets (prefix filter), with
  sizes and positions that still allow the floor;
* readers are dealt into PARTS by hash, and a set has a bit for each part that it has a reader in. A
  reader in a part that the other set lacks is not shared, which bounds the intersection before a reader
  is read. Large sets are then read in two steps, and a pair leaves after the first
  if what is unread can't make up what it lacks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tastemill.functions.hashing import hex_int, minhash_coefficients, minhash_signature
from tastemill.operators.skew import HOT_ROWS, hot_keys, slice_rows, sliced_join
from tastemill.sources.tables import write_table

EPS = 1e-9
# From this floor on prefixes are short, and one common reader with fitting positions is a
# sharp test; below it prefixes are long, and several common readers are asked for.
HIGH_FLOOR = 0.5
SHARED = 3
# Parts of the readers, 64 to a word of bits; the words that are read first of sets from LARGE on.
WORDS = 8
PARTS = 64 * WORDS
FIRST = 1
LARGE = 512
# Sets of a signature bucket up to which its pairs are met directly.
CROWDED = 256


def reader_pairs(df: DataFrame, item: str = "item_id", user: str = "user_id") -> DataFrame:
    """Distinct (item_id, reader) of the rows that are read."""
    read = df.where(F.col("is_read") == 1)
    return read.select(F.col(item).alias("item_id"), F.col(user).alias("reader")).distinct()


def signature_code(readers: DataFrame) -> Column:
    """The int32 that the min-hash family takes: a reader's id, or 28 bits of a text's md5.

    Only signatures use it; sets, sizes and intersections are of the readers themselves.
    """
    if isinstance(readers.schema["reader"].dataType, StringType):
        return hex_int(F.md5(F.col("reader").cast("binary")), 7)
    return F.col("reader")


def part_of(reader: Column) -> Column:
    return F.pmod(F.xxhash64(reader, F.lit("part")), F.lit(PARTS)).cast("int")


BITS = [f"bits{w}" for w in range(WORDS)]


def part_bits(reader: Column) -> list[Column]:
    """Aggregates: one bit for each part that has a reader, WORDS longs."""
    part = part_of(reader)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), part % 64)
    zero = F.lit(0).cast("bigint")
    return [F.bit_or(F.when(F.floor(part / 64) == w, bit).otherwise(zero)).alias(name) for w, name in enumerate(BITS)]


def _ones(words: list[Column]) -> Column:
    return reduce(lambda x, y: x + y, [F.bit_count(word) for word in words])


def item_reader_sets(
    readers: DataFrame, min_readers: int = 30, tables: int = 5, seed: int = 42, bits: bool = False
) -> DataFrame:
    """One row per item with enough readers: size, min-hash signature and a 128-bit print of the set.

    ``bits`` adds the bits of the set's parts, and how many readers it has beyond one per bit (``spare``).
    """
    token = F.col("reader")
    sets = (
        readers.groupBy("item_id").agg(
            F.count("*").alias("reader_count"),
            F.bit_xor(F.xxhash64(token)).alias("print_1"),
            F.bit_xor(F.xxhash64(token, F.lit("set"))).alias("print_2"),
            *minhash_signature(signature_code(readers), minhash_coefficients(tables, seed)),
            *(part_bits(token) if bits else []),
        )
        .where(F.col("reader_count") >= min_readers)
    )
    return sets.withColumn("spare", F.col("reader_count") - _ones([F.col(b) for b in BITS])) if bits else sets


def _signature(items: DataFrame) -> list[str]:
    return sorted((c for c in items.columns if c[0] == "h" and c[1:].isdigit()), key=lambda c: int(c[1:]))


def set_classes(items: DataFrame) -> DataFrame:
    """Items with the same reader set as one row: ``rep`` is the lowest id, ``last`` the highest."""
    same = ["reader_count", "print_1", "print_2", *_signature(items)]
    return items.groupBy(*same).agg(
        F.min("item_id").alias("rep"), F.max("item_id").alias("last"), F.count("*").alias("members"),
        *[F.any_value(c).alias(c) for c in ("spare", *BITS)],
    )


def class_summary(classes: DataFrame) -> Row:
    """Three numbers that decide which hot-key measures a plan needs: how many distinct
    sets there are, the largest set, and how many item pairs have identical sets."""
    m = F.col("members").cast("double")
    return classes.agg(
        F.count("*").alias("sets"),
        F.coalesce(F.max("reader_count"), F.lit(0)).alias("largest"),
        F.coalesce(F.sum(m * (m - 1) / 2), F.lit(0.0)).alias("copies"),
    ).first()


def neighbour_pairs(classes: DataFrame, hs: list[str], top: int, hot_rows: int = HOT_ROWS, sets: int = 0) -> DataFrame:
    """The ``top`` most promising pairs of neighbours in signature order: (a, b, ra, rb).

    Only a floor is derived from them, so a signature shared by very many sets is
    sliced freely; below ``hot_rows`` sets none can be.
    """
    turns = [F.struct(F.lit(i).alias("turn"), F.col(h).alias("g1"), F.col(hs[(i + 1) % len(hs)]).alias("g2"))
             for i, h in enumerate(hs)]
    rows = classes.select("rep", "reader_count", *hs, F.inline(F.array(*turns))).select(
        "rep", "reader_count", *hs, F.xxhash64("turn", "g1", "g2").alias("g")
    )
    hot = hot_keys(rows.groupBy("g").agg(F.count("*").alias("n")), "g", hot_rows) if sets > hot_rows else None
    order = W.partitionBy("g", "_slice").orderBy(*hs, "reader_count", "rep")
    nxt = F.lead(F.struct("rep", "reader_count", *hs)).over(order)
    pairs = slice_rows(rows, "g", "rep", hot).withColumn("nxt", nxt).where(F.col("nxt").isNotNull())
    agree = reduce(lambda x, y: x + y, [(F.col(h) == F.col(f"nxt.{h}")).cast("int") for h in hs])
    ra, rb, first = F.col("reader_count"), F.col("nxt.reader_count"), F.col("rep") < F.col("nxt.rep")
    scored = pairs.select(
        F.least("rep", "nxt.rep").alias("a"), F.greatest("rep", "nxt.rep").alias("b"),
        F.when(first, ra).otherwise(rb).alias("ra"), F.when(first, rb).otherwise(ra).alias("rb"),
        (agree + F.least(ra, rb) / F.greatest(ra, rb)).alias("promise"),
    )
    best = scored.groupBy("a", "b", "ra", "rb").agg(F.max("promise").alias("promise"))
    return best.orderBy(F.desc("promise"), "a", "b").limit(top).drop("promise")


def hot_items(items: DataFrame, largest: int, hot_rows: int) -> DataFrame | None:
    if largest <= hot_rows:
        return None
    return hot_keys(items.select("item_id", F.col("reader_count").alias("n")), "item_id", hot_rows)


def overlaps(
    pairs: DataFrame, readers: DataFrame, hot: DataFrame | None, low: int = 0, high: int = WORDS, read: bool = False
) -> DataFrame:
    """(a, b, c): how many readers of the words ``low`` to ``high`` both members of a pair have; pairs with none are left out.

    Both members meet the readers in one join on the item; a reader that two rows
    of a pair have in common is a (pair, reader) group of two. Groups are spread by
    reader, and the count per pair collapses before its shuffle. ``read`` adds how many readers of
    those words each member has.
    """
    part = part_of(F.col("reader"))
    some = readers if (low, high) == (0, WORDS) else readers.where((part >= 64 * low) & (part < 64 * high))
    sides = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("item_id"))
    met = sliced_join(some, sides, "item_id", "reader", hot)
    of_a = [F.count_if(F.col("item_id") == F.col("a")).alias("of_a")] if read else []
    shared = met.groupBy("a", "b", "reader").agg(F.count("*").alias("n"), *of_a)
    if not read:
        return shared.where(F.col("n") == 2).groupBy("a", "b").agg(F.count("*").alias("c"))
    return shared.groupBy("a", "b").agg(
        F.count_if(F.col("n") == 2).alias("c"), F.sum("of_a").alias("read_a"), F.sum(F.col("n") - F.col("of_a")).alias("read_b")
    )


def needed(floor: float, ra: Column, rb: Column) -> Column:
    """The readers that two sets must share to reach a similarity."""
    return F.ceil(F.lit(floor / (1 + floor)) * (ra + rb) - EPS)


def most_shared(side_a: str, side_b: str) -> Column:
    """No more readers are shared than this: parts that both have, and what either has beyond one reader per part.

    Sides are prefixes of the columns ``spare`` and BITS.
    """
    both = _ones([F.col(f"{side_a}{b}").bitwiseAND(F.col(f"{side_b}{b}")) for b in BITS])
    return both + F.least(f"{side_a}spare", f"{side_b}spare")


def most_left(left_a: Column, left_b: Column) -> Column:
    """The same for the words that aren't read in the first step, of which the sides have so many readers."""
    def alone(of: str, other: str) -> Column:
        return _ones([F.col(f"{of}_{b}").bitwiseAND(F.bitwise_not(F.col(f"{other}_{b}"))) for b in BITS[FIRST:]])
    return F.least(left_a - alone("a", "b"), left_b - alone("b", "a"))


BOUNDED = ("a", "b", "ra", "rb", *[f"{side}_{b}" for side in "ab" for b in BITS])


def bounded_pairs(pairs: DataFrame, classes: DataFrame, floor: float) -> DataFrame:
    """The pairs (a, b, ra, rb) whose bits still allow the floor, with both sets' bits."""
    a, b = (
        classes.select(F.col("rep").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in ("spare", *BITS)]) for side in "ab"
    )
    met = pairs.join(a, "a").join(b, "b")
    return met.where(most_shared("a_", "b_") >= needed(floor, F.col("ra"), F.col("rb"))).select(*BOUNDED)


def verified_pairs(
    pairs: DataFrame, readers: DataFrame, floor: float, hot: DataFrame | None, work_dir: str, large: bool = False
) -> DataFrame:
    """Exact intersection, union and Jaccard similarity of those pairs (a, b, ra, rb) that share a reader and reach the floor.

    With ``large``, pairs come with their bits and a part of their sets is read first. A pair then
    carries what it is known to share and what it has left to read; it is read whole only if that can be enough.
    """
    ra, rb = F.col("ra"), F.col("rb")
    alive, known = write_table(pairs, f"{work_dir}/bounded"), F.lit(0).cast("bigint")
    low = FIRST if large else 0
    if large:
        zero = F.lit(0).cast("bigint")
        counted = alive.join(overlaps(alive, readers, hot, 0, FIRST, read=True), ["a", "b"], "left")
        left = most_left(*[r - F.coalesce(f"read_{side}", zero) for side, r in (("a", ra), ("b", rb))])
        known = F.coalesce("c", zero)
        enough = known + left >= needed(floor, ra, rb)
        alive = write_table(counted.where(enough).select("a", "b", "ra", "rb", known.alias("known")), f"{work_dir}/first")
        known = F.col("known")
    counted = alive.join(overlaps(alive, readers, hot, low), ["a", "b"], "left")
    scored = counted.select("a", "b", "ra", "rb", (known + F.coalesce("c", F.lit(0))).alias("inter"))
    scored = scored.where((F.col("inter") > 0) & (F.col("inter") >= needed(floor, ra, rb)))
    union = F.col("ra") + F.col("rb") - F.col("inter")
    return scored.withColumn("union", union).withColumn("jaccard", F.col("inter") / F.col("union"))


def similarity_floor(known: DataFrame, k: int, lowest: float) -> float:
    """A similarity that k pairs are known to reach; ``lowest`` if fewer are known.

    Brings one number per known pair to the driver, at most k.
    """
    best = [r.jaccard for r in known.select("jaccard").orderBy(F.desc("jaccard")).limit(k).collect()]
    return max(best[-1], lowest) if len(best) == k else lowest


def trial_floors(floor: float) -> list[float]:
    """Bars to try, highest first, ending at the known floor.

    A bar that at least k pairs reach is a floor too. Among many near copies a higher
    one leaves far fewer pairs to count, and failing it costs little.
    """
    if floor < HIGH_FLOOR:
        return [floor]
    return [1 - (1 - floor) / 4, 1 - (1 - floor) / 2, floor]


def _smaller_first(floor: float) -> Column:
    """Of a pair met twice, the order in which the smaller set comes first, if the sizes allow the floor."""
    ra, rb = F.col("a_reader_count"), F.col("b_reader_count")
    first = (ra < rb) | ((ra == rb) & (F.col("a_item_id") < F.col("b_item_id")))
    return first & (ra >= F.lit(floor) * rb - EPS)


def _first_collision(hs: list[str]) -> Column:
    """No earlier table than ``turn`` has the pair in one bucket, so each pair is met in one table only."""
    apart = [(F.col("turn") <= i) | (F.col(f"a_{h}") != F.col(f"b_{h}")) for i, h in enumerate(hs[:-1])]
    return reduce(lambda x, y: x & y, apart, F.lit(True))


def candidate_pairs(
    classes: DataFrame, readers: DataFrame, hs: list[str], floor: float,
    hot: DataFrame | None, hot_rows: int = HOT_ROWS, sets: int = 0, buckets: DataFrame | None = None,
) -> DataFrame:
    """Class pairs that may reach ``floor``: (a, b, ra, rb), each once, a the smaller set.

    Readers are ordered by how many sets they are in, rarest first. Two sets of
    Jaccard >= t have at least need = t / (1 + t) (ra + rb) readers in common, and the
    first min(need, shared) of those lie among the first r - ceil(t r) + shared readers
    of each set. Where one is enough, the readers behind it must still suffice for the
    rest of ``need``, which the first common one of a fitting pair satisfies: that
    keeps near copies, which all share their frequent readers, from meeting each other. A hot item is numbered per slice; its prefix is then a superset,
    which only adds candidates. A met pair must also have bits that allow ``need``: among
    sets that share one reader by chance few do, and only those are counted by pair. A reader is in no more sets than there are, so
    the reader joins are sliced only when there are more than ``hot_rows`` sets.

    With ``buckets``, (rep, turn, hash) of crowded signature buckets, only pairs count that
    collide first in one of these; the bucket is then part of the key that they meet on.
    """
    t = F.lit(floor)
    shared = 1 if floor >= HIGH_FLOOR else SHARED
    reps = classes.select(F.col("rep").alias("item_id"), "reader_count", *hs)
    if buckets is not None:
        reps = reps.join(buckets.select(F.col("rep").alias("item_id")).distinct(), "item_id", "left_semi")
    rows = sliced_join(readers, reps, "item_id", "reader", hot)
    degree = rows.groupBy("reader").agg(F.count("*").alias("n"))
    hot_readers = hot_keys(degree, "reader", hot_rows) if sets > hot_rows else None
    ranked = sliced_join(rows, degree, "reader", "item_id", hot_readers)
    order = W.partitionBy("item_id", *([] if hot is None else ["_slice"])).orderBy("n", "reader")
    r = F.col("reader_count")
    prefix = (
        slice_rows(ranked, "item_id", "reader", hot)
        .withColumn("pos", F.row_number().over(order))
        .where(F.col("pos") <= r - F.ceil(t * r - EPS) + shared)
        .select("reader", "item_id", "reader_count", "pos", *hs)
    )
    if buckets is None:
        prefix = prefix.withColumn("meet", F.col("reader"))
    else:
        turns = buckets.withColumnRenamed("rep", "item_id")
        prefix = prefix.join(turns, "item_id").withColumn("meet", F.struct("turn", "hash", "reader")).drop("turn", "hash")
    of_set = classes.select(F.col("rep").alias("item_id"), "spare", *BITS)
    prefix = sliced_join(prefix, of_set, "item_id", "reader", hot)
    names = ["item_id", "reader_count", "pos", "spare", *BITS, *hs]
    left = prefix.select("meet", *[F.col(c).alias(f"a_{c}") for c in names])
    right = prefix.select("meet", *[F.col(c).alias(f"b_{c}") for c in names])
    pair_rows = hot_rows // 10
    in_prefix = prefix.groupBy("meet").agg(F.count("*").alias("n"))
    hot_prefix = hot_keys(in_prefix, "meet", pair_rows) if sets > pair_rows else None
    ra, rb = F.col("a_reader_count"), F.col("b_reader_count")
    fits = _smaller_first(floor) & (most_shared("a_", "b_") >= needed(floor, ra, rb))
    if shared == 1:
        behind = F.least(ra - F.col("a_pos"), rb - F.col("b_pos"))
        fits = fits & (behind + 1 >= t / (t + 1) * (ra + rb) - EPS)
    met = sliced_join(left, right, "meet", "a_item_id", hot_prefix).where(fits)
    if buckets is not None:
        met = met.withColumn("turn", F.col("meet.turn")).where(_first_collision(hs))
    return (
        met.groupBy(F.col("a_item_id").alias("a"), F.col("b_item_id").alias("b"), ra.alias("ra"), rb.alias("rb"))
        .agg(F.count("*").alias("c"))
        .where(F.col("c") >= F.least(needed(floor, F.col("ra"), F.col("rb")), F.lit(shared)))
        .drop("c")
    )


def signature_rows(classes: DataFrame, hs: list[str]) -> DataFrame:
    """One row per class and table: (rep, reader_count, spare, *BITS, *hs, turn, hash)."""
    turns = [F.struct(F.lit(i).alias("turn"), F.col(h).alias("hash")) for i, h in enumerate(hs)]
    return classes.select("rep", "reader_count", "spare", *BITS, *hs, F.inline(F.array(*turns)))


def colliding_pairs(
    classes: DataFrame, readers: DataFrame, hs: list[str], floor: float, hot: DataFrame | None,
    hot_rows: int = HOT_ROWS, sets: int = 0, crowded_sets: int = CROWDED,
) -> DataFrame:
    """Class pairs that collide in a table and whose sizes and bits allow ``floor``, each once, as ``bounded_pairs``.

    Signatures meet in an equality join on (turn, hash); sizes and bits are looked at in the join. A bucket of more than ``crowded_sets`` sets,
    say of a reader that a third of all sets have, would make the square of its size in
    pairs: there sets meet on a rare reader as well, see ``candidate_pairs``.
    """
    rows = signature_rows(classes, hs)
    if sets <= crowded_sets:
        calm, crowded = rows, None
    else:
        sizes = rows.groupBy("turn", "hash").agg(F.count("*").alias("n"))
        large = sizes.where(F.col("n") > crowded_sets).select("turn", "hash")
        crowded = rows.join(large, ["turn", "hash"], "left_semi").select("rep", "turn", "hash")
        calm = rows.join(sizes.where((F.col("n") > 1) & (F.col("n") <= crowded_sets)).select("turn", "hash"), ["turn", "hash"], "left_semi")
    sides = [
        calm.withColumnRenamed("rep", "item_id").select(
            "turn", "hash", *[F.col(c).alias(f"{side}_{c}") for c in ("item_id", "reader_count", "spare", *BITS, *hs)]
        )
        for side in "ab"
    ]
    ra, rb = F.col("a_reader_count"), F.col("b_reader_count")
    allowed = most_shared("a_", "b_") >= needed(floor, ra, rb)
    met = sides[0].join(sides[1], ["turn", "hash"]).where(_smaller_first(floor) & _first_collision(hs) & allowed)
    pairs = met.withColumns({"a": F.col("a_item_id"), "b": F.col("b_item_id"), "ra": ra, "rb": rb}).select(*BOUNDED)
    if crowded is None or crowded.isEmpty():
        return pairs
    others = candidate_pairs(classes, readers, hs, floor, hot, hot_rows, sets, crowded)
    return pairs.unionByName(bounded_pairs(others, classes, floor))


ORDER = ("jaccard", "inter", "r1", "r2")


def best_directed(directed: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """The directed class pairs that can hold one of the k best item pairs, without a window over all rows.

    Scores are counted with their lowest left id; the k best of these counts give the
    cut-off. Pairs before it are fewer than k. Of those at it, all of one left id, the k with the least
    right id above that are kept. Each step is a count or a bounded top list, however many pairs are tied.
    """
    by = [*[F.desc(c) for c in ORDER], F.col("l_rep")]
    counts = directed.groupBy(*ORDER, "l_rep").agg(F.count("*").alias("n")).orderBy(*by).limit(k).collect()
    total, before = 0, []
    for row in counts:
        if total + row.n >= k:
            break
        total += row.n
        before.append(row)
    if len(before) == len(counts):
        return directed
    edge = counts[len(before)]
    def is_at(row: Row) -> Column:
        return reduce(lambda x, y: x & y, [F.col(c) == F.lit(row[c]) for c in ("inter", "r1", "r2", "l_rep")])
    keys = ("inter", "r1", "r2", "l_rep")
    spark = directed.sparkSession
    kept = []
    if before:
        schema = directed.select(*keys).schema
        listed = spark.createDataFrame([tuple(r[c] for c in keys) for r in before], schema)
        kept = [directed.join(F.broadcast(listed), list(keys), "left_semi")]
    tied = directed.where(is_at(edge))
    after = F.col("r_rep") > F.col("l_rep")
    later = items.where(F.col("item_id") > F.lit(edge["l_rep"])).select(
        "item_id", F.col("print_1").alias("r_print_1"), F.col("print_2").alias("r_print_2")
    )
    least = tied.where(~after).join(later, ["r_print_1", "r_print_2"]).groupBy("r_rep").agg(F.min("item_id").alias("first"))
    first = tied.where(after).select("r_rep", F.col("r_rep").alias("first")).unionByName(least)
    chosen = first.orderBy("first").limit(k - total).select("r_rep")
    kept.append(tied.join(F.broadcast(chosen), "r_rep", "left_semi").select(*directed.columns))
    return reduce(DataFrame.unionByName, [d.select(*directed.columns) for d in kept])


def top_item_pairs(
    class_pairs: DataFrame | None, classes: DataFrame, items: DataFrame, k: int, work_dir: str
) -> DataFrame:
    """Spell the best class pairs out as item pairs (id_1 < id_2) and keep the top k.

    A directed class pair holds the pairs whose lower id is in ``l`` and higher id in
    ``r``. Any pair of the answer belongs to one of the k best directed pairs, and
    within it uses only the first k members of ``l`` and the first k members of ``r``
    above the lowest of ``l``: at most k * k pairs are spelled out for each.
    """
    keys = ("rep", "print_1", "print_2")
    n = F.col("reader_count")
    directed = classes.where(F.col("members") > 1).select(
        *[F.col(c).alias(f"{p}_{c}") for p in "lr" for c in keys],
        n.alias("r1"), n.alias("r2"), n.alias("inter"), n.alias("union"), F.lit(1.0).alias("jaccard"),
    )
    if class_pairs is not None:
        info = classes.select(*keys, "last")
        a, b = (info.select(*[F.col(c).alias(f"{p}_{c}") for c in info.columns]) for p in "ab")
        both = class_pairs.join(a, F.col("a") == F.col("a_rep")).join(b, F.col("b") == F.col("b_rep"))
        ways = F.array(*[
            F.when(F.col(f"{l}_rep") < F.col(f"{r}_last"), F.struct(
                *[F.col(f"{l}_{c}").alias(f"l_{c}") for c in keys],
                *[F.col(f"{r}_{c}").alias(f"r_{c}") for c in keys],
                F.col(f"r{l}").alias("r1"), F.col(f"r{r}").alias("r2"),
            ))
            for l, r in ("ab", "ba")
        ])
        directed = directed.unionByName(
            both.select(F.inline(F.array_compact(ways)), "inter", "union", "jaccard")
        )
    order = [F.desc(c) for c in ORDER]
    best = write_table(best_directed(write_table(directed, f"{work_dir}/directed"), items, k), f"{work_dir}/best")
    member = items.select("item_id", "print_1", "print_2")
    first = F.row_number().over(W.partitionBy("l_rep", "r_rep").orderBy("item_id"))
    def members(p: str) -> DataFrame:
        keys = best.select("l_rep", "r_rep", F.col(f"{p}_print_1").alias("print_1"), F.col(f"{p}_print_2").alias("print_2"))
        met = member.join(keys, ["print_1", "print_2"])
        above = met if p == "l" else met.where(F.col("item_id") > F.col("l_rep"))
        return above.withColumn("first", first).where(F.col("first") <= k).select("l_rep", "r_rep", "item_id")
    spelled = (
        best.join(members("l").withColumnRenamed("item_id", "item_id_1"), ["l_rep", "r_rep"])
        .join(members("r").withColumnRenamed("item_id", "item_id_2"), ["l_rep", "r_rep"])
        .where(F.col("item_id_1") < F.col("item_id_2"))
    )
    return spelled.orderBy(*order, "item_id_1", "item_id_2").limit(k).select(
        "item_id_1", "item_id_2",
        F.col("r1").alias("reader_count_1"), F.col("r2").alias("reader_count_2"),
        (1.0 - F.col("jaccard")).alias("jaccard_distance"),
        F.col("inter").alias("intersection_size"), F.col("union").alias("union_size"),
        F.col("jaccard").alias("jaccard_similarity"),
    )


def similar_pairs(
    readers: DataFrame,
    work_dir: str,
    k: int = 100,
    min_readers: int = 30,
    max_distance: float = 0.8,
    tables: int = 5,
    seed: int = 42,
    collide: bool = True,
    hot_rows: int = HOT_ROWS,
    crowded_sets: int = CROWDED,
) -> DataFrame:
    """Top-k item pairs by Jaccard similarity, then intersection and sizes, all descending, then ids.

    ``collide=False`` drops the min-hash condition: the exact answer over all pairs.
    ``work_dir`` holds the tables that the steps share.
    """
    readers = write_table(readers, f"{work_dir}/readers")
    items = write_table(item_reader_sets(readers, min_readers, tables, seed, bits=True), f"{work_dir}/items")
    classes = write_table(set_classes(items), f"{work_dir}/classes")
    hs = _signature(items)
    known = class_summary(classes)
    if known.copies >= k:
        # Identical sets fill the whole answer; distinct sets are all less similar.
        return top_item_pairs(None, classes, items, k, work_dir)
    hot = hot_items(items, known.largest, hot_rows)
    lowest = 1.0 - max_distance
    near = neighbour_pairs(classes, hs, 10 * k, hot_rows, known.sets)
    floor = similarity_floor(
        verified_pairs(near, readers, lowest, hot, f"{work_dir}/near"), k - int(known.copies), lowest
    )
    for bar in trial_floors(floor):
        if collide:
            candidates = colliding_pairs(classes, readers, hs, bar, hot, hot_rows, known.sets, crowded_sets)
        else:
            candidates = bounded_pairs(candidate_pairs(classes, readers, hs, bar, hot, hot_rows, known.sets), classes, bar)
        scored = verified_pairs(candidates, readers, bar, hot, f"{work_dir}/verified", known.largest >= LARGE)
        close = scored.where((1.0 - F.col("jaccard") < max_distance) & (F.col("jaccard") >= bar))
        pairs = write_table(close, f"{work_dir}/pairs")
        if bar > floor and pairs.count() + known.copies >= k:
            break
    return top_item_pairs(pairs, classes, items, k, work_dir)
