"""Personal data by base patterns and a skip-chain conditional random field.

The base patterns find emails, IPs, cards and phones. The field's nodes are a document's
candidates: runs around an @ and numbers as written, in text order. Neighbours form the chain. Occurrences of
the same or a similar value, however distant, are tied through one hub node of their group, so what one
of them proves is two hops from any other. They share their potentials: the hub has the shapes that any
occurrence shows, and a group's neighbourhood counts as that of one node, so that any number of bare repeats can't
outvote a proved one. Loopy sum-product messages run until a document's own ones come to rest. Spans that the field
adds never replace base spans.

Weights come from at most TRAINING distinct whole texts with a base span, an equal share for each kind (those with the least
digests): shapes and chain by the likelihood of a group's label given its neighbours', hub edges by how often
occurrences of a group that prove something agree. Each proved value also gives groups with broken copies, which
are the entity beside a proved one and nothing without.

Null texts are empty texts; null and repeated doc_ids are rows like any other, equal texts train once. Whole texts
of any length are read, other columns are ignored whatever their names. Of overlapping labels base spans stay; ties between
labels go to the one listed first, nothing before the kinds. Without training texts the base spans are all. An empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemill.llm.common import stage, table

KINDS = ("email", "ip", "card", "phone")
LABELS = ("", *KINDS)
TRAINING = 3000
ROUNDS = 500  # a document's messages come to rest long before
REST = 1e-4  # change of a document's messages at which they are taken to rest
DAMPING = 0.3
AGREEING, OTHERWISE = 50.0, 0.25  # counts that the hub edges start from
PENALTY = 1e-4
STEPS = 300
LEAST_DIGITS = 7

Span = tuple[int, int, str]  # start, end, kind

# Fixed values of the base patterns.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

NUMBER = re.compile(r"[0-9](?:[\x20().-]{0,3}[0-9])*+")
DIGIT_RUN = re.compile(r"[0-9][0-9().-]*+")
AT_RUN = re.compile(r"[A-Za-z0-9._%+-]*+@[A-Za-z0-9._%+@-]*+")
NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for n, d in enumerate(reversed(digits)):
        value = int(d) * (1 + n % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _octets(text: str) -> bool:
    return all(len(part) <= 3 and int(part) <= 255 for part in (p.lstrip("0") or "0" for p in text.split(".")))


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches from each @, so that a long run without one isn't tried at every character."""
    last, at = 0, text.find("@")
    while at >= 0:
        found = DOMAIN.match(text, at + 1)
        if found:
            start = at
            while start > last and LOCAL.match(text[start - 1]):
                start -= 1
            if start < at:
                last = found.end()
                yield start, last, "email"
        at = text.find("@", max(at + 1, last))


def base_spans(text: str) -> list[Span]:
    """All base spans by start, then kind as listed."""
    spans = list(_emails(text)) if "@" in text else []
    spans += [(m.start(), m.end(), "ip") for m in IP.finditer(text) if _octets(m[0])]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = NOT_DIGIT.sub("", m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                spans.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                spans.append((m.start(), m.end(), "phone"))
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


@dataclass
class Node:
    start: int
    end: int
    text: str
    before: str  # the characters next to it
    after: str
    core: str  # what the same values have in common
    wide: str  # what similar ones have in common


def _node(text: str, start: int, end: int) -> Node:
    """Similar are emails with the same letters and digits, long numbers with the same beginning and others with the same end."""
    own = text[start:end]
    if "@" in own:
        core = own.lower()
        wide = "@" + "".join(c for c in core if c.isalnum())
    else:
        core = own.lstrip("+")
        digits = NOT_DIGIT.sub("", own)
        wide = "=" + digits[:12] if len(digits) >= 14 else digits[-10:]
    return Node(start, end, own, text[start - 1:start], text[end:end + 1], core, wide)


def candidates(text: str) -> list[Node]:
    """The nodes of a text in order: runs around an @, and numbers long enough to be personal."""
    taken: list[tuple[int, int]] = []
    if "@" in text:
        taken = [(m.start(), len(m[0].rstrip(".-")) + m.start()) for m in AT_RUN.finditer(text)]
        taken = [(s, e) for s, e in taken if e - s > 1]
    nodes = [_node(text, s, e) for s, e in taken]
    for m in NUMBER.finditer(text):
        if m.end() - m.start() < LEAST_DIGITS:
            continue
        digits = len(NOT_DIGIT.sub("", m[0]))
        pieces = [(m.start(), m.end())]
        if digits > 19:  # several numbers side by side
            pieces = [(m.start() + p.start(), m.start() + len(p[0].rstrip("().-")) + p.start()) for p in DIGIT_RUN.finditer(m[0])]
        for start, end in pieces:
            own = text[start:end]
            if len(NOT_DIGIT.sub("", own)) < LEAST_DIGITS and own.count(".") < 3:
                continue
            if text[start - 1:start] == "(" and ")" in own:
                start -= 1
            if text[start - 1:start] == "+":
                start -= 1
            if not any(s < end and start < e for s, e in taken):
                nodes.append(_node(text, start, end))
    return sorted(nodes, key=lambda n: (n.start, n.end))


def shape(node: Node) -> list[float]:
    """The node's own evidence."""
    own, digits = node.text, NOT_DIGIT.sub("", node.text)
    size, dots = len(digits), own.count(".")
    local, at, domain = own.partition("@")
    email = bool(at)
    named = email and bool(local) and bool(DOMAIN.fullmatch(domain)) and domain.count("@") == 0
    four = not email and dots == 3 and bool(IP.fullmatch(own))
    plus = own.startswith("+")
    return [float(v) for v in (
        1, email, named, email and not named, four, four and _octets(own), four and not _octets(own),
        plus and not email, plus and 10 <= size <= 15 and not email, "(" in own, "-" in own and not email,
        " " in own, not email and not four and dots > 0,
        not email and size < 10, not email and 10 <= size <= 13, not email and 14 <= size <= 19, not email and size > 19,
        not email and not four and not plus and 14 <= size <= 19 and luhn(digits),
        not email and not four and not plus and 14 <= size <= 19 and not luhn(digits),
        node.before.isalnum(), node.after.isalnum(),
    )]


SHAPES = len(shape(Node(0, 1, "0", "", "", "0", "0")))
SAME, SIMILAR = 0, 1  # kinds of hub edges


@dataclass
class Graph:
    """Variables of a document: its candidates, then a hub for each group of two or more."""

    x: list[list[float]]  # shapes that a variable's unary potential sees; none for a tied candidate
    chain: list[tuple[int, int, float]]  # neighbours, and by how much their potential counts
    hubs: list[tuple[int, int, int]]  # hub, candidate, kind


def grouped(nodes: list[Node]) -> dict[str, list[int]]:
    groups: dict[str, list[int]] = {}
    for i, node in enumerate(nodes):
        groups.setdefault(node.wide, []).append(i)
    return groups


def any_shape(shapes: list[list[float]]) -> list[float]:
    return [max(column) for column in zip(*shapes)]


def graph_of(nodes: list[Node], skip: bool = True) -> Graph:
    """The graph of a document; without ``skip`` every candidate stands for itself."""
    shapes = [shape(n) for n in nodes]
    x, hubs, size = list(shapes), [], [1] * len(nodes)
    for members in grouped(nodes).values() if skip else ():
        if len(members) > 1:
            cores = [nodes[i].core for i in members]
            for i in members:
                hubs.append((len(x), i, SAME if cores.count(nodes[i].core) > 1 or len(set(cores)) == 1 else SIMILAR))
                x[i], size[i] = [0.0] * SHAPES, len(members)
            x.append(any_shape([shapes[i] for i in members]))
    return Graph(x, [(i, i + 1, 1 / max(size[i], size[i + 1])) for i in range(len(nodes) - 1)], hubs)


@dataclass
class Field:
    unary: np.ndarray  # shapes x labels
    chain: np.ndarray  # labels x labels
    hub: np.ndarray  # kinds of hub edges x labels of the hub x labels of a candidate


def beliefs(field: Field, graphs: list[Graph]) -> list[np.ndarray]:
    """Marginal log-probabilities (up to a constant per variable) of each graph's variables.

    All graphs' messages are computed side by side, but each graph rests by its own messages, so what comes out doesn't
    depend on the graphs beside it.
    """
    first = np.cumsum([0, *[len(g.x) for g in graphs]])
    if not first[-1]:
        return [np.zeros((0, len(LABELS))) for _ in graphs]
    score = np.array([row for g in graphs for row in g.x]) @ field.unary
    ends, tables, owner = [], [], []
    for n, g in enumerate(graphs):
        for a, b, weight in g.chain:
            ends.append((first[n] + a, first[n] + b))
            tables.append(weight * field.chain)
            owner.append(n)
        for hub, i, kind in g.hubs:
            ends.append((first[n] + hub, first[n] + i))
            tables.append(field.hub[kind])
            owner.append(n)
    if ends:
        links, table_ = np.array(ends), np.stack(tables)
        source, target = np.concatenate([links[:, 0], links[:, 1]]), np.concatenate([links[:, 1], links[:, 0]])
        table_ = np.concatenate([table_, table_.transpose(0, 2, 1)])
        owner_ = np.array(owner * 2)
        back = np.concatenate([np.arange(len(links)) + len(links), np.arange(len(links))])
        message = np.zeros((len(source), len(LABELS)))
        active = np.arange(len(source))
        for _ in range(ROUNDS):
            belief = score.copy()
            for label in range(len(LABELS)):
                belief[:, label] += np.bincount(target[active], message[active, label], len(score))
            sent = (belief[source[active]] - message[back[active]])[:, :, None] + table_[active]
            top = sent.max(axis=1)
            fresh = top + np.log(np.exp(sent - top[:, None, :]).sum(axis=1))
            fresh -= fresh.max(axis=1, keepdims=True)
            change = np.zeros(len(graphs))
            np.maximum.at(change, owner_[active], np.abs(fresh - message[active]).max(axis=1))
            message[active] = DAMPING * message[active] + (1 - DAMPING) * fresh
            active = active[change[owner_[active]] >= REST]
            if not len(active):
                break
        for label in range(len(LABELS)):
            score[:, label] += np.bincount(target, message[:, label], len(score))
    return [score[a:b] for a, b in zip(first, first[1:])]


def _label(node: Node, spans: list[Span]) -> int:
    """The base kind that covers most of a node."""
    for start, end, kind in spans:
        overlap = min(end, node.end) - max(start, node.start)
        if 2 * overlap > node.end - node.start and 2 * overlap > end - start:
            return LABELS.index(kind)
    return 0


def broken(text: str, label: int) -> str:
    """A candidate's text so changed that it no longer proves its kind."""
    kind = LABELS[label]
    if kind == "email":
        return text.partition("@")[0] + "@" + text.partition("@")[2].replace(".", "")
    if kind == "ip":
        return text.replace(".", "-")
    if kind == "phone":
        return text.lstrip("+")
    last = NOT_DIGIT.sub("", text)[-1]
    return text[:-1] + str((int(last) + 1) % 10)


def examples(text: str) -> tuple[list[list[float]], list[tuple[int, int, int]]]:
    """What a whole document teaches: rows of (label, shapes of a group, mean labels around it), and the pairs
    (kind, label, label) of its proved occurrences with another of their group."""
    spans = base_spans(text)
    nodes = candidates(text)
    labels = [_label(n, spans) for n in nodes]
    around = np.zeros((len(nodes), len(LABELS)))
    for i in range(len(nodes) - 1):
        around[i, labels[i + 1]] += 1
        around[i + 1, labels[i]] += 1
    rows, pairs = [], []
    for members in grouped(nodes).values():
        shapes = [shape(nodes[i]) for i in members]
        proved = [i for i in members if labels[i]]
        label = labels[proved[0]] if proved else 0
        near = around[members].mean(axis=0).tolist()
        rows.append([label, *any_shape(shapes), *near])
        for i, j in zip(proved, proved[1:]):
            pairs.append((SAME if nodes[i].core == nodes[j].core else SIMILAR, labels[i], labels[j]))
        if label:
            own = nodes[proved[0]].text
            copy = broken(own, label)
            copies = [shape(_node(copy, 0, len(copy)))]
            rows.append([0, *copies[0], *near])
            rows.append([label, *any_shape([shape(nodes[proved[0]]), *copies]), *near])
    return rows, pairs


def fit(rows: np.ndarray, pairs: np.ndarray) -> Field | None:
    """The likelihood of each label given its group's shapes and the labels around, by accelerated gradient descent; rows count as often as they come."""
    if not len(rows) or len(set(rows[:, 0])) < 2:
        return None
    distinct, weight = np.unique(rows, axis=0, return_counts=True)
    y, x = distinct[:, 0].astype(int), distinct[:, 1:]
    weight = np.sqrt(weight) / np.sqrt(weight).sum()  # common shapes shouldn't drown rare ones
    truth = np.eye(len(LABELS))[y]
    step = 1 / (0.5 * float((weight * (x ** 2).sum(axis=1)).sum()) + PENALTY)
    w = ahead = np.zeros((x.shape[1], len(LABELS)))
    for n in range(STEPS):
        p = x @ ahead
        p = np.exp(p - p.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        after = ahead - step * (x.T @ (weight[:, None] * (p - truth)) + PENALTY * ahead)
        ahead = after + n / (n + 3) * (after - w)
        w = after
    chain = w[SHAPES:]
    agree = np.full((2, len(LABELS), len(LABELS)), OTHERWISE) + (AGREEING - OTHERWISE) * np.eye(len(LABELS))
    for kind, one, other in pairs.tolist():
        agree[kind, one, other] += 0.5
        agree[kind, other, one] += 0.5
    # Rows are distributions: a candidate without evidence of its own tells its hub nothing.
    return Field(w[:SHAPES], (chain + chain.T) / 2, np.log(agree / agree.sum(axis=2, keepdims=True)))


def _digest(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def train(docs: DataFrame) -> Field | None:
    """The field from a bounded sample of texts with a base span; only its examples reach the driver, counted."""

    def kinds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [{s[2] for s in base_spans(text.as_py())} for text in batch.column(0)]
            rows = [(d.as_py(), k) for d, own in zip(batch.column(1), found) for k in sorted(own)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], ["digest", "kind"])

    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"), _digest(F.col("text")).alias("digest"))
    proved = stage(texts.mapInArrow(kinds, "digest string, kind string").distinct(), "pii-proved")
    shares = [proved.where(F.col("kind") == k).orderBy("digest").limit(TRAINING // len(KINDS)).select("digest") for k in KINDS]
    sample = stage(reduce(DataFrame.unionByName, shares).distinct(), "pii-sample")  # at most TRAINING rows
    chosen = texts.join(F.broadcast(sample), "digest").groupBy("digest").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [examples(text.as_py()) for text in batch.column(0)]
            rows = [[0.0, *row] for own, _ in found for row in own] + [[1.0, *map(float, p)] for _, own in found for p in own]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64()))], ["row"])

    counted = chosen.select("text").mapInArrow(run, "row array<double>").groupBy("row").count()
    found = counted.orderBy("row").collect()
    def repeated(which: float, width: int) -> np.ndarray:
        rows = [(r.row[1:], r["count"]) for r in found if r.row[0] == which]
        values = np.array([r for r, _ in rows]).reshape(len(rows), width)
        return np.repeat(values, [n for _, n in rows], axis=0)
    return fit(repeated(0.0, 1 + SHAPES + len(LABELS)), repeated(1.0, 3).astype(int))


def field_spans(field: Field, texts: list[str], skip: bool = True) -> list[list[Span]]:
    """Spans that the field labels, for each text."""
    nodes = [candidates(t) for t in texts]
    found = beliefs(field, [graph_of(own, skip) for own in nodes])
    return [
        [(n.start, n.end, LABELS[y]) for n, y in zip(own, b[: len(own)].argmax(axis=1).tolist()) if y]
        for own, b in zip(nodes, found)
    ]


def merged(base: list[Span], added: list[Span]) -> list[Span]:
    """Base spans, and added ones that overlap none of them."""
    out, at, reach = list(base), 0, 0
    for start, end, kind in added:
        while at < len(base) and base[at][0] < end:
            reach = max(reach, base[at][1])
            at += 1
        if reach <= start:
            out.append((start, end, kind))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def find(docs: DataFrame, field: Field | None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans); the counts are those of the base spans."""
    names = ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            base = [base_spans(t) for t in texts]
            added = field_spans(field, texts) if field else [[] for _ in texts]
            counts = [[sum(s[2] == k for s in own) for own in base] for k in KINDS]
            digests = [hashlib.sha256(written(own).encode()).hexdigest() for own in base]
            spans = [written(merged(own, more)) for own, more in zip(base, added)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(digests), pa.array(spans, pa.string())], names
            )

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, schema)


def op10_skip_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return find(docs, train(docs))
