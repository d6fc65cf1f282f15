"""Exact duplicates by deterministic block naming, in DataFrame operations only.

A normalised text is cut into blocks of BLOCK bytes. Distinct blocks are sorted and
numbered; then adjacent pairs of names are named the same way, again and again, until
each document has one name. Names are given by sorting contents and never by a hash, so two
documents of the same round share a name only if their texts are equal. A hash only deals
contents to the tasks that sort them.

Null texts are empty texts, and empty texts are equal. Rows with null doc_ids take part and
lose against any other id. Of rows that repeat doc_id and text, one is kept, so no tie is left open. Whole texts of any
length are cut. Columns other than doc_id and text are ignored whatever their names; ``drop_exact_copies`` returns them. An
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tastemill.llm.common import HOT_KEYS, ascii_lower, join_counted, pick_rows, spelled, stage, table

BLOCK = 2048
SORT_BUCKETS = 1 << 14  # at least
BUCKET_ROWS = 50_000


def named(rows: DataFrame, keep: list[str], stage_name: str) -> DataFrame:
    """Replace the column ``content`` by an integer ``name``, equal exactly where contents are equal.

    Contents are dealt into buckets and ranked there, so a name is (bucket, rank); there are more buckets the more
    rows there are. A content with over 1 / HOT_KEYS of the rows would fill a bucket: there are fewer than HOT_KEYS
    of these, they are ranked among themselves and looked up without a shuffle, and their rows go
    through the ranking of the others without content, dealt by what is kept of them.
    """
    prints = rows.select(F.xxhash64("content").alias("print"))
    counts = stage(prints.groupBy("print").count(), f"{stage_name}-prints")
    total, most = counts.agg(F.coalesce(F.sum("count"), F.lit(0)), F.coalesce(F.max("count"), F.lit(0))).first()
    buckets = max(SORT_BUCKETS, total // BUCKET_ROWS)
    bucket = F.pmod(F.xxhash64("content"), F.lit(buckets))
    if most * HOT_KEYS > total:
        likely = counts.where(F.col("count") * HOT_KEYS > total).select("print")
        marked = rows.withColumn("print", F.xxhash64("content"))
        hot = marked.join(F.broadcast(likely), "print", "left_semi").groupBy("content").count()
        by_content = Window.orderBy("content")  # over fewer than HOT_KEYS rows
        hot = stage(
            hot.where(F.col("count") * HOT_KEYS > total).select(
                F.col("content"), (F.row_number().over(by_content) - 1).cast("long").alias("known")
            ), f"{stage_name}-hot",
        )
        rows = rows.join(F.broadcast(hot), "content", "left")
        bucket = F.when(F.col("known").isNull(), bucket).otherwise(-1 - F.pmod(F.xxhash64(*keep), F.lit(buckets)))
        rows = rows.withColumn("bucket", bucket).withColumn("content", F.when(F.col("known").isNull(), F.col("content")))
    else:
        rows = rows.withColumn("bucket", bucket).withColumn("known", F.lit(None).cast("long"))
    rank = F.dense_rank().over(Window.partitionBy("bucket").orderBy("content")).cast("long")
    name = F.coalesce("known", F.shiftleft(F.col("bucket") + 1, 40) + rank)
    return stage(rows.select(*keep, name.alias("name")), f"{stage_name}-names")


def blocks(text: Column) -> Column:
    """The text's UTF-8 bytes in fixed-size blocks; an empty text is one empty block."""
    def cut(whole):
        last = F.ceil(F.greatest(F.octet_length(whole), F.lit(1)) / BLOCK).cast("int") - 1
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(whole, i * BLOCK + 1, F.lit(BLOCK)))
    # The array binds the bytes to a variable, so that they are made once per row.
    return F.flatten(F.transform(F.array(text.cast("binary")), cut))


def identities(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row per distinct (doc_id, text_sha256): the round in which its text was named, and the name; and how
    often that row comes (``copies``).

    The digest only tells rows with the same doc_id apart.
    """
    text = ascii_lower(F.col("text"))
    row = F.transform(F.array(text), lambda t: F.struct(F.sha2(t, 256).alias("text_sha256"), blocks(t).alias("blocks")))
    cut = docs.select("doc_id", F.explode(row).alias("row")).select(
        "doc_id", "row.text_sha256", F.posexplode("row.blocks").alias("pos", "content")
    )
    keys = ["doc_id", "text_sha256"]
    names = named(cut, [*keys, "pos"], "blocks")
    copies = names.where("pos = 0").groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    done, step = [], 0
    while True:
        # A row of pairs per document and place. Copies of a row agree, so max is their common name.
        left, right = (F.max(F.when(F.col("pos") % 2 == side, F.col("name"))) for side in (0, 1))
        pairs = names.groupBy(*keys, F.floor(F.col("pos") / 2).alias("pos")).agg(
            left.alias("left"), right.alias("right")
        )
        paired = stage(
            pairs.withColumn("places", F.count(F.lit(1)).over(Window.partitionBy(*keys))), f"pairs-{step}"
        )
        alone = (F.col("places") == 1) & F.col("right").isNull()
        done.append(paired.where(alone).select(*keys, F.lit(step).alias("round"), F.col("left").alias("name")))
        open_pairs = paired.where(~alone)
        if open_pairs.isEmpty():
            break
        step += 1
        contents = open_pairs.select(*keys, "pos", F.struct("left", "right").alias("content"))
        names = named(contents, [*keys, "pos"], f"round-{step}")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out, copies


def exact_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row; the largest doc_id of equal texts stays."""
    keys = ["doc_id", "text_sha256"]
    found, copies = identities(docs)
    found = found.withColumnsRenamed({k: f"_{k}" for k in keys})
    on = copies["doc_id"].eqNullSafe(found["_doc_id"]) & (copies["text_sha256"] == found["_text_sha256"])
    members = stage(copies.join(found, on).select(*keys, "copies", "round", "name"), "members")
    groups = stage(
        members.groupBy("round", "name").agg(
            F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"), F.count(F.lit(1)).alias("_rows")
        ), "groups",
    )
    total = members.count()
    rows = join_counted(members, groups, ["round", "name"], "_rows", total)
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return spelled(rows, keys).select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns; of fully repeated ids and texts the least row stays."""
    groups = exact_groups(docs)
    copies = groups.groupBy("doc_id", F.col("text_sha256").alias("text_sha")).agg(
        F.count(F.lit(1)).alias("copies"), F.max("kept").alias("kept")
    )
    return pick_rows(docs, copies.where("kept"), ascii_lower(F.col("text")))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


ORACLE = """
WITH n AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n
"""
