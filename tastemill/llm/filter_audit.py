"""How quality filters interact: what each removes at every place of every order, and its Shapley share.

Each text gets the set of filters that it fails. A coalition of filters removes the documents
that fail any of its members, so per part of the table the removals of all coalitions follow from the counts by
failed set. Steps of an order are differences of coalitions. Shapley values
come from constrained least squares: additive values are fitted to the coalition removals under the
kernel weights (n - 1) / (C(n, s) s (n - s)), with their sum held at the removal of all filters. The normal
equations with that constraint are solved in rationals once, for a removal of each single coalition;
the solution is linear in the removals, so n! times it is a table of whole numbers that Spark applies to every part.

Null texts are empty texts, null sources the part ''. A copy is a text that a smaller doc_id has anywhere in the
table; rows without a doc_id are nobody's original and no copy, rows that repeat an id with its text are no copies of
each other. A document is good (toxic) if any label of its doc_id says so; without a label, or without an id, it is
neither. Repeated rows each count, ties can't arise, whole texts of any length are read, columns other than doc_id, text
and source are ignored whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from fractions import Fraction
from functools import reduce
from itertools import permutations
from math import comb, factorial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemill.llm.common import ASCII_UPPER, stage, table

SPACES = r"[\x20\x09-\x0D]+"
COPY = "E"  # the filter that looks at other documents
MEASURES = ("docs", "good", "toxic")


def text_filters(text: Column) -> dict[str, Column]:
    """What makes a text fail each filter that looks at the text alone."""
    words = F.array_remove(F.split(text, SPACES), "")
    capitals = F.length(text) - F.length(F.translate(text, ASCII_UPPER, ""))
    return {
        "A": F.size(words) < 200,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 50,
        "C": capitals * 100 > F.length(text) * 2,
        "D": text.rlike(r"[#$%&*|]"),
    }


def bit_set(conditions: Mapping[str, Column]) -> Column:
    """The conditions that hold, as bits in their order."""
    bits = [F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(conditions.values())]
    return reduce(Column.__add__, bits)


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, fails, docs, good, toxic): documents by part and set of failed filters, A to E as bits 0 to 4.

    Texts are read once; what is shuffled is a digest per row. Repeated rows collapse
    first, and an original is met by (text, doc_id), so a text that a third of all rows share is no hot key.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    filters = text_filters(text)
    read = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"), bit_set(filters).alias("own"),
    )
    facts = stage(read.groupBy("doc_id", "part", "digest", "own").agg(F.count(F.lit(1)).alias("docs")), "audit-facts")
    known = facts.where("doc_id IS NOT NULL")
    firsts = known.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    flags = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.col("quality").eqNullSafe(1).cast("int")).alias("is_good"),
        F.max(F.col("toxic").eqNullSafe(1).cast("int")).alias("is_toxic"),
    )
    copy = F.when(F.col("first").isNull(), F.lit(1 << len(filters))).otherwise(F.lit(0))
    met = known.join(firsts, ["digest", "doc_id"], "left").join(flags, "doc_id", "left").select(
        "part", (F.col("own") + copy).alias("fails"), "docs",
        F.coalesce("is_good", F.lit(0)).alias("is_good"), F.coalesce("is_toxic", F.lit(0)).alias("is_toxic"),
    )
    nameless = facts.where("doc_id IS NULL").select(
        "part", F.col("own").alias("fails"), "docs", F.lit(0).alias("is_good"), F.lit(0).alias("is_toxic")
    )
    return met.unionByName(nameless).groupBy("part", "fails").agg(
        F.sum("docs").alias("docs"),
        F.sum(F.col("docs") * F.col("is_good")).alias("good"),
        F.sum(F.col("docs") * F.col("is_toxic")).alias("toxic"),
    )


def solve(rows: list[list[Fraction]]) -> list[list[Fraction]]:
    """Solutions of a square system for all its right sides, in rationals: each row is (coefficients, right sides)."""
    rows = [row[:] for row in rows]
    n = len(rows)
    for i in range(n):
        pivot = next(r for r in range(i, n) if rows[r][i])
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for r in range(n):
            if r != i and rows[r][i]:
                rows[r] = [x - rows[r][i] * y for x, y in zip(rows[r], rows[i])]
    return [row[n:] for row in rows]


def shapley_form(n: int) -> list[list[int]]:
    """For each of n players the coefficients, by coalition, of n! times its Shapley value.

    Minimise sum over proper coalitions S of weight(|S|) (v(S) - sum of the members' values)^2 with all values
    summing to v(all). The unknowns are the values and the multiplier of the constraint; right side S
    is that of v(S) = 1 and all other coalitions 0.
    """
    if n == 1:
        return [[0, 1]]
    everyone = (1 << n) - 1
    weight = [Fraction(0)] * (everyone + 1)
    for s in range(1, everyone):
        size = s.bit_count()
        weight[s] = Fraction(n - 1, comb(n, size) * size * (n - size))
    rows = []
    for i in range(n):
        pulls = [sum(w for s, w in enumerate(weight) if s >> i & 1 and s >> j & 1) for j in range(n)]
        rows.append([*map(Fraction, pulls), Fraction(1), *[w if s >> i & 1 else Fraction(0) for s, w in enumerate(weight)]])
    constraint = [Fraction(int(s == everyone)) for s in range(everyone + 1)]
    rows.append([*[Fraction(1)] * n, Fraction(0), *constraint])
    form = [[x * factorial(n) for x in row] for row in solve(rows)[:n]]
    if any(x.denominator != 1 for row in form for x in row):
        raise ArithmeticError("n! times a Shapley value has whole coefficients")
    return [[int(x) for x in row] for row in form]


def coalition_removals(counts: DataFrame, n: int) -> DataFrame:
    """(part, total, v): what each of the 2^n coalitions removes, as structs of counts in the order of their bits."""
    coalitions = F.explode(F.sequence(F.lit(0), F.lit((1 << n) - 1))).alias("coalition")
    hit = F.col("fails").bitwiseAND(F.col("coalition")) != 0
    removed = counts.select("*", coalitions).groupBy("part", "coalition").agg(
        F.sum("docs").alias("total"), *[F.sum(F.when(hit, F.col(m)).otherwise(F.lit(0))).alias(m) for m in MEASURES]
    )
    return removed.groupBy("part").agg(
        F.max("total").alias("total"), F.sort_array(F.collect_list(F.struct("coalition", *MEASURES))).alias("v")
    )


def audit(counts: DataFrame, letters: str) -> DataFrame:
    """One row per part, order of the filters and step, from ``failure_counts``-like rows; bit i of fails is letter i."""
    n, everyone = len(letters), (1 << len(letters)) - 1
    parts = coalition_removals(counts, n)

    def value(coalition: Column, measure: str = "docs") -> Column:
        return F.element_at("v", coalition + 1)[measure]

    shares = [
        reduce(Column.__add__, [value(F.lit(s)) * F.lit(c) for s, c in enumerate(row) if c])
        for row in shapley_form(n)
    ]
    orders = ",".join("".join(p) for p in permutations(letters))
    steps = parts.select("part", "total", "v", F.array(*shares).alias("shares")).withColumn(
        "filter_order", F.explode(F.split(F.lit(orders), ","))
    ).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n))))
    at = F.instr(F.lit(letters), F.substring("filter_order", F.col("step"), F.lit(1)))  # place of the step's filter, from 1
    earlier = [
        F.when(F.instr("filter_order", letter) < F.col("step"), F.lit(1 << i)).otherwise(F.lit(0))
        for i, letter in enumerate(letters)
    ]
    steps = steps.withColumns({
        "at": at, "own": F.element_at(F.array(*[F.lit(1 << i) for i in range(n)]), at),
        "before": reduce(Column.__add__, earlier),
    })
    own, before = F.col("own"), F.col("before")
    after = before + own
    removed = value(after) - value(before)
    return steps.select(
        "part", "filter_order", "step",
        (F.col("total") - value(after)).alias("kept"),
        removed.alias("removed"),
        (value(own) - removed).alias("redundant"),
        (value(F.lit(everyone)) - value(F.lit(everyone) - own)).alias("unique_fails"),
        (value(after, "good") - value(before, "good")).alias("good_lost"),
        (value(after, "toxic") - value(before, "toxic")).alias("toxic_lost"),
        F.element_at("shares", F.col("at")).alias("shapley"),
    )


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = failure_counts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return audit(stage(counts, "audit-counts"), "ABCD" + COPY)


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce("text", '') AS t,
    regexp_extract_all(coalesce("text", ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), firsts AS (
  SELECT t, min(doc_id) AS first FROM d GROUP BY t
), l AS (
  SELECT doc_id, max((quality IS NOT DISTINCT FROM 1)::INT) AS good, max((toxic IS NOT DISTINCT FROM 1)::INT) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
    100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
    coalesce(doc_id > first, false) AS e
  FROM d LEFT JOIN firsts USING (t) LEFT JOIN l USING (doc_id)
), m AS (
  SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS fails,
    count(*) AS docs, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL
), letters AS (
  SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS t(letter, bit)
), orders AS (
  SELECT p.letter || q.letter || r.letter || s.letter || u.letter AS filter_order, [p.bit, q.bit, r.bit, s.bit, u.bit] AS bits
  FROM letters p, letters q, letters r, letters s, letters u WHERE p.bit + q.bit + r.bit + s.bit + u.bit = 31
    AND p.bit | q.bit | r.bit | s.bit | u.bit = 31
), steps AS (
  SELECT filter_order, step::INT AS step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
  FROM orders, range(1, 6) AS t(step)
), r AS (
  SELECT part, filter_order, step, own,
    sum(CASE WHEN fails & (before | own) = 0 THEN docs ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN fails & before = 0 AND fails & own <> 0 THEN docs ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN fails & before <> 0 AND fails & own <> 0 THEN docs ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN fails = own THEN docs ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN fails & before = 0 AND fails & own <> 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN fails & before = 0 AND fails & own <> 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM m, steps GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM r
"""
