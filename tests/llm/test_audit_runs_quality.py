"""Filter audit, periodic runs and quality scores against brute force and held-out labels."""

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction
from itertools import combinations, permutations

import numpy as np
import pytest

from tastemill.llm import filter_audit, periodic_runs, quality_machine
from tastemill.llm.common import table
from tests.llm.conftest import SF

LABELS = "doc_id long, quality int, toxic int, size long, name string"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# Filter audit


def failures(docs):
    """Set of failed filters of each (doc_id, text)."""
    first = {}
    for d, t in docs:
        if d is not None:
            first[t or ""] = min(first.get(t or "", d), d)
    out = []
    for d, t in docs:
        t, w = t or "", words(t)
        failed = {
            "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)), "E": d is not None and d > first[t],
        }
        out.append("".join(c for c in "ABCDE" if failed[c]))
    return out


def audit_by_walking(docs, sources, good, toxic):
    """Every order applied to the documents of every part."""
    failed = failures(docs)
    rows = []
    for part in {s or "" for s in sources}:
        own = [(d, set(f)) for (d, _), f, s in zip(docs, failed, sources) if (s or "") == part]
        alone = Counter("".join(sorted(f)) for _, f in own)
        shapley = Counter()
        steps = []
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [d for d, f in left if letter in f]
                before = len(left)
                left = [(d, f) for d, f in left if letter not in f]
                shapley[letter] += len(gone)
                failing = sum(letter in f for _, f in own)
                steps.append((
                    part, "".join(order), step, len(left), before - len(left), failing - len(gone), alone[letter],
                    sum(d in good for d in gone), sum(d in toxic for d in gone), letter,
                ))
        rows += [(*s[:-1], shapley[s[-1]]) for s in steps]
    return rows


def order_key(row):
    return tuple((v is not None, v) for v in row)


def test_audit_walks_all_orders(spark, edge_docs, edge_rows, no_docs):
    labels = [(1, 1, 0, 1, "n"), (2, 0, 1, 1, "n"), (5, 1, 1, 1, "n"), (5, 0, None, 1, "n"), (101, None, 1, 1, "n"), (None, 1, 1, 1, "n"), (8, 1, 0, 1, "n"), (3, 1, 0, 1, "n")]
    counts = filter_audit.failure_counts(edge_docs, spark.createDataFrame(labels, LABELS))
    got = [tuple(r) for r in filter_audit.audit(counts, "ABCDE").collect()]
    docs, sources = [(d, t) for d, t, *_ in edge_rows], [r[3] for r in edge_rows]
    want = audit_by_walking(docs, sources, {1, 5, 8, 3}, {2, 5, 101})
    assert sorted(got, key=order_key) == sorted(want, key=order_key)
    empty = filter_audit.failure_counts(no_docs, spark.createDataFrame([], LABELS))
    assert filter_audit.audit(empty, "ABCDE").count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_shapley_values_are_means_over_orders(n):
    draw = random.Random(n)
    v = [0] + [draw.randint(0, 999) for _ in range(2 ** n - 1)]
    for i, row in enumerate(filter_audit.shapley_form(n)):
        gains = 0
        for order in permutations(range(n)):
            before = sum(1 << j for j in order[: order.index(i)])
            gains += v[before | 1 << i] - v[before]
        assert sum(c * x for c, x in zip(row, v)) == gains


def test_solve_is_exact():
    rows = [[Fraction(0), Fraction(2), Fraction(3)], [Fraction(3), Fraction(1), Fraction(7)]]
    assert filter_audit.solve(rows) == [[Fraction(11, 6)], [Fraction(3, 2)]]


# Periodic runs


def runs_by_period(w):
    """All runs, period by period."""
    found = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            start, stop = i, j + q
            smaller = any(q % d == 0 and w[start : stop - d] == w[start + d : stop] for d in range(1, q))
            if j > i and stop - start >= max(6, 4 * q) and not smaller:
                found.append((start, stop - start, q))
            i = max(j, i + 1)
    return sorted(found)


def repetitive(draw):
    n, kind = draw.randint(0, 120), draw.randint(0, 4)
    if kind == 0:
        return [draw.randint(0, 1) for _ in range(n)]
    if kind == 1:
        unit = [draw.randint(0, 2) for _ in range(draw.randint(1, 15))]
        return [draw.randint(0, 2) for _ in range(draw.randint(0, 9))] + (unit * 20)[: draw.randint(0, 150)] + [5, 1]
    if kind == 2:
        return [int(draw.random() < 0.03) for _ in range(n)]
    if kind == 3:
        a, b = [0], [0, 1]
        while len(b) < n:
            a, b = b, b + a
        return b[:n]
    unit = [0] * draw.randint(1, 4) + [1] * draw.randint(1, 4)
    return (unit * draw.randint(1, 5) + [7]) * draw.randint(1, 6)


def solved(rows):
    codes = np.array([c for r in rows for c in r], np.int32)
    out = [[] for _ in rows]
    for row, q, start, stop in periodic_runs.solve(codes, np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)):
        if stop - start >= 6:
            out[row].append((start, stop - start, q))
    return [sorted(o) for o in out]


def test_runs_of_random_words():
    draw = random.Random(4)
    rows = [repetitive(draw) for _ in range(1500)]
    for low in range(0, len(rows), 50):
        assert solved(rows[low : low + 50]) == [runs_by_period(r) for r in rows[low : low + 50]]


def test_z_function():
    draw = random.Random(5)
    for _ in range(300):
        w = repetitive(draw)
        z = periodic_runs.z_function(w, 40)
        assert z[1:] == [next((k for k in range(len(w) - i) if w[k] != w[i + k]), len(w) - i) for i in range(1, len(z))]


def test_work_grows_with_the_length():
    import time

    start = time.perf_counter()
    for rows in ([[1] * 60_000], [[int(i % 97 == 0) for i in range(60_000)]]):
        assert solved(rows)[0]
    assert time.perf_counter() - start < 20  # pairs of places would be 10^9


def planted(doc_id, text):
    w = words(text)
    n = len(w)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def run_digests(doc_id, text, find=runs_by_period):
    w = planted(doc_id, text)
    runs = find(w)
    dropped = {i for start, length, q in runs for i in range(start + q, start + length)}
    best = min(((-length, start, q) for start, length, q in runs), default=None)
    named = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(x for i, x in enumerate(w) if i not in dropped)
    return doc_id, len(runs), *named, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest()


@pytest.mark.parametrize("tile", [16, 48, periodic_runs.TILE])
def test_runs_of_documents(spark, edge_docs, edge_rows, no_docs, tile):
    def run(docs):
        return periodic_runs.digest_rows(periodic_runs.periodic_runs(periodic_runs.seeded_texts(docs), tile))

    def find(w):
        return [(0, 40_000, 1)] if len(w) == 40_000 else runs_by_period(w)

    got = Counter(tuple(r) for r in run(edge_docs).collect())
    assert got == Counter(run_digests(d, t, find) for d, t, *_ in edge_rows)
    assert run(no_docs).count() == 0


def test_runs_meet_across_tiles(spark):
    """Long documents, cut into many tiles, have the runs of the uncut ones."""
    draw = random.Random(6)
    texts = []
    for i in range(60):
        parts = [draw.choice("abc") if draw.random() < 0.4 else " ".join(draw.choices("abcde", k=draw.randint(1, 30)) * draw.randint(3, 9)) for _ in range(6)]
        texts.append((i, " ".join(parts)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    for tile in (16, 64):
        got = periodic_runs.digest_rows(periodic_runs.periodic_runs(periodic_runs.seeded_texts(docs), tile))
        assert Counter(tuple(r) for r in got.collect()) == Counter(run_digests(*t) for t in texts)


def test_runs_of_the_test_data(spark, documents):
    got = Counter(tuple(r) for r in periodic_runs.op12_periodic_runs(spark, SF).collect())
    assert got == Counter(run_digests(d, t, lambda w: solved([numbered(w)])[0] if len(w) > 300 else runs_by_period(w)) for d, t, _ in documents)


def numbered(w):
    ids = {}
    return [ids.setdefault(x, len(ids)) for x in w]


# Quality


def test_pairs_by_the_identity():
    draw = np.random.default_rng(1)
    lengths = [3, 1, 6]
    ends = np.cumsum(lengths)
    x = quality_machine.Sparse(draw.integers(0, 20, ends[-1]), draw.normal(size=ends[-1]), ends)
    w, v = draw.normal(size=20), draw.normal(size=(20, quality_machine.FACTORS))
    got = quality_machine.margin(0.5, w, v, x)[0]
    for row, (low, high) in enumerate(zip(x.starts, ends)):
        entries = list(zip(x.features[low:high], x.values[low:high]))
        pairs = sum(a * b * (v[i] @ v[j]) for (i, a), (j, b) in combinations(entries, 2))
        assert abs(got[row] - (0.5 + sum(w[i] * a for i, a in entries) + pairs)) < 1e-9


def test_slopes_equal_differences():
    draw = np.random.default_rng(2)
    x = quality_machine.Sparse(np.array([0, 2, 1, 2, 3]), draw.normal(size=5), np.array([2, 5]))
    w, v = draw.normal(size=4), draw.normal(size=(4, 3))
    _, parts, sums = quality_machine.margin(0.0, w, v, x)
    owner = np.array([0, 0, 1, 1, 1])
    slope = x.values[:, None] * (sums[owner] - parts)
    for entry in range(5):
        for f in range(3):
            moved = v.copy()
            moved[x.features[entry], f] += 1e-6
            change = (quality_machine.margin(0.0, w, moved, x)[0] - quality_machine.margin(0.0, w, v, x)[0]) / 1e-6
            assert abs(change[owner[entry]] - slope[entry, f]) < 1e-4


@pytest.fixture(scope="module")
def scored(spark):
    return quality_machine.op11_quality_machine(spark, "/root/testdata/sf0.01").collect()


def test_held_out_quality(spark, scored):
    truth = {r.doc_id: r.quality for r in table(spark, "/root/testdata/sf0.01", "labels").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in scored)
    assert len(scored) == table(spark, "/root/testdata/sf0.01", "documents").count()
    held = [(truth[r.doc_id], r.score, r.predicted) for r in scored if r.held_out and r.doc_id in truth]
    good, bad = [s for y, s, _ in held if y == 1], [s for y, s, _ in held if y == 0]
    above = sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))
    assert len(bad) >= 10 and above > 0.97
    assert sum(y == p for y, _, p in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in scored)


def test_held_out_labels_are_not_read(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.001", name) for name in ("documents", "labels"))
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 3 = 1, 1 - quality, quality) as quality")
    one, two = quality_machine.fit(docs, labels), quality_machine.fit(docs.repartition(7), flipped)
    assert one.bias == two.bias and np.array_equal(one.weights, two.weights) and np.array_equal(one.factors, two.factors)


def test_scores_without_labels_and_of_odd_rows(spark, edge_docs, edge_rows, no_docs):
    none = spark.createDataFrame([], LABELS)
    rows = quality_machine.score(edge_docs, quality_machine.fit(edge_docs, none)).collect()
    assert len(rows) == len(edge_rows) and all(abs(r.score - 0.5) < 1e-6 for r in rows)
    labels = table(spark, SF, "labels")
    machine = quality_machine.fit(table(spark, SF, "documents"), labels)
    rows = quality_machine.score(edge_docs, machine).collect()
    assert Counter(r.doc_id for r in rows) == Counter(d for d, *_ in edge_rows)
    assert all(0 <= r.score <= 1 for r in rows) and not any(r.held_out for r in rows if r.doc_id is None)
    again = quality_machine.score(edge_docs.repartition(9).drop("n_chars"), machine).collect()
    key = lambda r: (r.doc_id is None, r.doc_id, r.score)
    assert [(r.doc_id, round(r.score, 9)) for r in sorted(rows, key=key)] == [(r.doc_id, round(r.score, 9)) for r in sorted(again, key=key)]
    assert quality_machine.score(no_docs, machine).count() == 0
