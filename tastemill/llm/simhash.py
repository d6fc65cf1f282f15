"""SimHash near-duplicates: all pairs of fingerprints at 2 or fewer bits by one-wildcard segment variants.

A 64-bit fingerprint is cut into two halves, so of two linked fingerprints one half differs
by at most one bit. What the other half may still differ by gives each key a second part
of 16 fixed bits, found by cutting that half again:

* one half equal, the other at up to two bits: one of its quarters differs by at most one
  bit, so the key is the equal half with that quarter, whole or with one bit deleted;
* each half at one bit: the key is the upper half with one bit deleted and the equal quarter
  of the lower half.

Deleted-bit keys join rows with that bit 0 to rows with it 1, so a pair meets only where
it differs. Keys fix 47 bits or more, which bounds how many fingerprints can share one
however many near copies there are. Pairs that meet are verified by their bit distance.

Only distinct fingerprints take part in joins. Components come from label spreading with
pointer jumping over staged tables. Null texts are empty texts; texts without words have
fingerprint 0. Rows with null doc_ids take part, and the component's id is the smallest id
that isn't null. Repeated ids and rows are each fingerprinted, whole texts of any length are read. A bit that exactly half
of the hashes set is 0. Columns other than doc_id and text are ignored whatever their names; ``drop_near_copies`` returns
them, and of several rows with the smallest id the least. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemill.llm.common import join_counted, pick_rows, stage, table

SHINGLE = 3
SEED = 42
MOST_BITS = 2
CHUNK = 1 << 14  # shingles whose bits are unpacked at once


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The majority bits over the shingles' hashes, as a signed 64-bit integer."""
    words = text.lower().split()  # bytes: A-Z only, and ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    starts = [0, *[e + 1 for e in ends[:-1]]]
    digest = xxhash.xxh64_intdigest
    pieces = zip(starts, ends[shingle - 1:]) if len(words) >= shingle else [(0, len(joined))]
    hashes = np.array([digest(joined[s:e], SEED) for s, e in pieces], "<u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), CHUNK):
        octets = hashes[at:at + CHUNK].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_sha, fingerprint): the digest only tells rows with the same doc_id apart."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(text.as_py(), shingle) for text in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(prints, pa.int64())], ["doc_id", "text_sha", "fingerprint"]
            )

    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2(text, 256).alias("text_sha"), text.cast("binary"))
    return rows.mapInArrow(make, "doc_id long, text_sha string, fingerprint long")


# Keys of a fingerprint: 17 for each quarter beside the equal other half (whole, then one bit deleted), and one for
# each bit of the upper half with each quarter of the lower half.
HALF_KEYS = 4 * 17
KEYS = HALF_KEYS + 32 * 2


def _keyed(prints: DataFrame, kinds: Column, name: str) -> DataFrame:
    """(kind, key, bit, name): a row for each kind of key; bit is that of the deleted position."""
    rows = prints.select(F.col("fingerprint").alias(name), F.explode(kinds).alias("kind"))
    p = name
    parts = {
        "equal": "kind div 34", "quarter": "kind div 17 % 2", "place": "kind % 17 - 1",
        "above": f"(kind - {HALF_KEYS}) div 2", "below": f"(kind - {HALF_KEYS}) % 2",
    }
    rows = rows.withColumns({f"_{n}": F.expr(f"cast({e} as int)") for n, e in parts.items()})
    quarter = f"(shiftrightunsigned({p}, 32 * (1 - _equal) + 16 * _quarter) & 65535L)"
    held = f"shiftleft(shiftrightunsigned({p}, 32 * _equal) & 4294967295L, 16)"
    upper = f"shiftrightunsigned({p}, 32)"
    return rows.select(
        name, F.col("kind").cast("short").alias("kind"),
        F.expr(f"""CASE WHEN kind >= {HALF_KEYS}
            THEN shiftleft({upper} & ~shiftleft(1L, _above), 16) | (shiftrightunsigned({p}, 16 * _below) & 65535L)
            WHEN _place < 0 THEN {held} | {quarter}
            ELSE {held} | ({quarter} & ~shiftleft(1L, _place)) END""").alias("key"),
        F.expr(f"""CASE WHEN kind >= {HALF_KEYS} THEN shiftrightunsigned({upper}, _above) & 1L
            WHEN _place >= 0 THEN shiftrightunsigned({quarter}, _place) & 1L END""").alias("bit"),
    )


def links(prints: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """(a, b) with a < b for distinct staged fingerprints at ``most_bits`` or fewer differing bits, each once."""
    if most_bits != MOST_BITS:
        raise ValueError(f"two halves with one deleted bit find pairs at up to {MOST_BITS} bits")
    wholes = F.array(*[F.lit(k) for k in range(0, HALF_KEYS, 17)])
    deleted = F.array(*[F.lit(k) for k in range(KEYS) if k >= HALF_KEYS or k % 17])

    def side(kinds: Column, name: str, where: Column) -> DataFrame:
        return _keyed(prints, kinds, name).where(where).select("kind", "key", name)

    # The planner takes the keys for as small as the fingerprints and would broadcast them.
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= most_bits
    equal = side(wholes, "a", F.lit(True)).join(side(wholes, "b", F.lit(True)).hint("merge"), ["kind", "key"])
    differ = side(deleted, "a", F.col("bit") == 0).join(side(deleted, "b", F.col("bit") == 1).hint("merge"), ["kind", "key"])
    ordered = differ.where(near).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return equal.where((F.col("a") < F.col("b")) & near).select("a", "b").unionByName(ordered).distinct()


def components(pairs: DataFrame) -> DataFrame:
    """(node, root) of all nodes in staged pairs: the smallest node reachable."""
    both = stage(
        pairs.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
            pairs.select(F.col("b").alias("node"), F.col("a").alias("other"))
        ), "edges",
    )
    # A fingerprint has at most C(64,2) + 64 neighbours, so no node is a hot key of the edges.
    nearest = F.least(F.col("node"), F.min("other"))
    labels = stage(both.groupBy("node").agg(nearest.alias("root")), "labels")
    total = labels.count()
    while True:
        heads = labels.groupBy("root").agg(F.count(F.lit(1)).alias("_rows"))
        heads = heads.join(labels.select(F.col("node").alias("root"), F.col("root").alias("_higher")), "root")
        jumped = stage(join_counted(labels, stage(heads, "heads"), ["root"], "_rows", total).select(
            "node", F.col("_higher").alias("root")
        ), "labels")
        others = jumped.select(F.col("node").alias("other"), F.col("root").alias("_root"))
        spread = both.join(others, "other").groupBy("node").agg(F.min("_root").alias("_least"))
        after = stage(
            jumped.join(spread, "node").select(
                "node", F.least("root", "_least").alias("root"), (F.col("_least") != F.col("root")).alias("changed")
            ), "labels",
        )
        settled = after.where("changed").isEmpty()
        labels = after.select("node", "root")
        if settled and jumped.where(F.col("root") != F.col("node")).join(
            jumped.select(F.col("node").alias("root"), F.col("root").alias("_up")), "root"
        ).where(F.col("_up") != F.col("root")).isEmpty():
            return labels


def near_groups(docs: DataFrame, shingle: int = SHINGLE, most_bits: int = MOST_BITS) -> DataFrame:
    """(doc_id, text_sha, fingerprint, root, component_id) of every row; root names the component."""
    rows = stage(fingerprints(docs, shingle), "fingerprints")
    nodes = stage(
        rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("rows")), "nodes"
    )
    pairs = stage(links(nodes.select("fingerprint"), most_bits), "links")
    labels = components(pairs).withColumnRenamed("node", "fingerprint")
    rooted = nodes.join(labels, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    rooted = stage(rooted, "rooted")
    heads = stage(
        rooted.groupBy("root").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("_nodes")), "heads"
    )
    named = stage(join_counted(rooted, heads, ["root"], "_nodes", rooted.count()).drop("_nodes", "first"), "components")
    return join_counted(rows, named, ["fingerprint"], "rows", rows.count()).drop("rows")


def drop_near_copies(docs: DataFrame, shingle: int = SHINGLE, most_bits: int = MOST_BITS) -> DataFrame:
    """One row of each group with all its columns: that of the smallest doc_id, then of the least text digest."""
    copies = near_groups(docs, shingle, most_bits).groupBy("root", "doc_id", "text_sha").agg(F.count(F.lit(1)).alias("copies"))
    kept = copies.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_sha"), F.col("copies"))).alias("first")
    )
    return pick_rows(docs, kept.select("first.doc_id", "first.text_sha", "first.copies"), F.coalesce(F.col("text"), F.lit("")))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
