"""Operators on documents against brute force, with the edge cases that their docstrings define."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import xxhash
from tokenizers import Tokenizer

from tastemill.llm import block_names, common, mixing, packing, simhash, token_records
from tastemill.llm.common import fresh_path, stage
from tastemill.llm.crc32c import crc32c
from tests.llm.conftest import SF

BPE = public_tokenizers.path("byte_bpe_50k.json")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def test_crc32c():
    data = np.frombuffer(b"123456789" + bytes(32) + b"a" * 1000, np.uint8)
    assert [hex(c) for c in crc32c(data, np.array([0, 9]), np.array([9, 32]))] == ["0xe3069283", "0x8a9136aa"]


def test_token_records(spark, edge_docs, edge_rows, no_docs):
    path = fresh_path(spark, "records")
    token_records.write_tokens(edge_docs, path, BPE, 2)
    got = token_records.read_tokens(spark, path, ids=True).orderBy("start").collect()
    tokenizer = Tokenizer.from_file(BPE)
    want = Counter((d, *tokenizer.encode(t or "", add_special_tokens=False).ids, 2) for d, t, *_ in edge_rows)
    assert Counter((r.doc_id, *r.ids) for r in got) == want
    order = [(r.doc_id is not None, r.doc_id or 0) for r in got]
    assert order == sorted(order)
    start = 0
    for r in got:
        assert (r.start, r.n_tokens) == (start, len(r.ids))
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        start += r.n_tokens
    empty = fresh_path(spark, "records")
    token_records.write_tokens(no_docs, empty, BPE, 2)
    assert token_records.read_tokens(spark, empty).count() == 0


def test_chunks_encode_as_in_the_text():
    import random

    encoder, draw = token_records.ChunkEncoder(BPE), random.Random(1)
    texts = ["".join(draw.choice(" \n\ta1.,'s²é ́") for _ in range(draw.randint(0, 14))) for _ in range(3000)]
    parts = ["und", "größe", "Ñora", "l", "'s", ".", "***", "(", "\n", "\n", " ", " ", " ", "12", "日本", "Ġ", "×", "\x85", "<|endoftext|>"]
    texts += ["".join(draw.choice(parts) for _ in range(draw.randint(0, 16))) for _ in range(6000)]
    got = [np.frombuffer(b, "<u2").tolist() for b in encoder.encode(texts)]
    assert got == [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_damaged_record(spark, edge_docs):
    import glob

    import pytest

    path = fresh_path(spark, "records")
    token_records.write_tokens(edge_docs.limit(3), path, BPE, 2)
    name = max(glob.glob(path.removeprefix("file:") + "/*.records"))
    with open(name, "r+b") as f:
        f.seek(30)
        byte = f.read(1)
        f.seek(30)
        f.write(bytes([byte[0] ^ 1]))
    with pytest.raises(Exception, match="checksum"):
        token_records.read_tokens(spark, path).collect()


def test_best_fit():
    import random

    draw = random.Random(2)
    for _ in range(100):
        sizes = sorted((draw.randint(1, 60) for _ in range(draw.randint(0, 80))), reverse=True)
        bins, want = [], []
        for size in sizes:
            fit = min(((left, i) for i, left in enumerate(bins) if left >= size), default=None)
            if fit is None:
                bins.append(60)
                fit = (60, len(bins) - 1)
            bins[fit[1]] -= size
            want.append(fit[1])
        assert packing.best_fit(sizes, 60) == want
    assert packing.best_fit([9, 1], 5) == [0, 1]  # over the capacity: a bin of its own
    assert packing.best_fit([3, 3], 5, most=1) is None


def test_shards(spark, edge_docs, edge_rows, no_docs):
    rows = packing.number_slots(packing.shard_by_bytes(edge_docs, 4), 4).collect()
    assert Counter((r.doc_id, r.size) for r in rows) == Counter((d, len((t or "").encode()) + 16) for d, t, *_ in edge_rows)
    homes, slots = defaultdict(set), defaultdict(list)
    for r in rows:
        homes[r.digest].add(r.shard)
        slots[r.shard].append(r.slot)
    assert all(len(s) == 1 for s in homes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert packing.number_slots(packing.shard_by_bytes(no_docs, 4), 4).count() == 0


def test_shards_are_even(spark):
    sizes = Counter()
    for r in packing.op2_shards(spark, SF).collect():
        sizes[r.shard] += r.size
    assert len(sizes) == 40
    biggest = max(len(t.encode()) for t, in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect())
    assert max(sizes.values()) <= max(1.02 * sum(sizes.values()) / 40, biggest + 16)


def exact_want(rows):
    groups = defaultdict(list)
    for d, t, *_ in rows:
        groups[lowered(t)].append(d)
    out = Counter()
    for text, ids in groups.items():
        keep = max((d for d in ids if d is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        out.update((d, keep, len(ids), sha) for d in ids)
    return out


def test_exact_groups(edge_docs, edge_rows, no_docs, monkeypatch):
    for size in (2048, 3):  # 3: every text takes several rounds of pairs
        monkeypatch.setattr(block_names, "BLOCK", size)
        docs = edge_docs if size > 3 else edge_docs.where("length(coalesce(text, '')) < 100")
        rows = [r for r in edge_rows if size > 3 or len(r[1] or "") < 100]
        got = block_names.exact_groups(docs).collect()
        assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == exact_want(rows)
        kept = [r.text_sha256 for r in got if r.kept]
        assert sorted(kept) == sorted({r.text_sha256 for r in got})
    assert block_names.exact_groups(no_docs).count() == 0


def test_drop_exact_copies(edge_docs, edge_rows):
    kept = block_names.drop_exact_copies(edge_docs)
    assert kept.columns == edge_docs.columns
    rows = kept.collect()
    assert sorted(lowered(r.text) for r in rows) == sorted({lowered(r[1]) for r in edge_rows})
    assert {r.doc_id for r in rows if lowered(r.text) == "the same copy here"} == {159}


def fingerprint(text):
    found = words(lowered(text))
    if not found:
        return 0
    pieces = [" ".join(found[i:i + 3]) for i in range(len(found) - 2)] or [" ".join(found)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in pieces]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(prints):
    """The smallest position reachable from each fingerprint over links of two bits or fewer."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return [find(x) for x in range(len(prints))]


def test_simhash_groups(spark, documents, no_docs):
    got = {r.doc_id: r for r in simhash.op8_simhash(spark, SF).collect()}
    prints = [fingerprint(t) for _, t, _ in documents]
    roots = linked(prints)
    for (doc_id, *_), p, root in zip(documents, prints, roots):
        assert (got[doc_id].fingerprint, got[doc_id].component_id) == (f"{p:016x}", documents[root][0])
    assert simhash.near_groups(no_docs).count() == 0


def test_simhash_links_chain_across_segments(spark):
    """Pairs that differ in either half, in both, within and across quarters; and a chain of them."""
    import random

    draw = random.Random(4)
    seeds = [draw.getrandbits(64) for _ in range(40)]
    prints = sorted({s ^ (1 << a) ^ (1 << b) for s in seeds for a, b in [draw.sample(range(64), 2) for _ in range(6)]} | set(seeds))
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    pairs = stage(simhash.links(stage(spark.createDataFrame(signed, "fingerprint long"), "prints")), "pairs")
    want = {
        tuple(sorted((signed[a][0], signed[b][0])))
        for a in range(len(prints)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 2
    }
    assert [tuple(r) for r in pairs.orderBy("a", "b").collect()] == sorted(want)
    labels = {r.node: r.root for r in simhash.components(pairs).collect()}
    roots = linked(prints)
    groups = defaultdict(set)
    for (s,), root in zip(signed, roots):
        groups[root].add(s)
    assert labels == {s: min(g) for g in groups.values() if len(g) > 1 for s in g}


def test_simhash_edge_cases(edge_docs, edge_rows):
    groups = simhash.near_groups(edge_docs).collect()
    assert Counter(r.doc_id for r in groups) == Counter(r[0] for r in edge_rows)
    assert {r.component_id for r in groups if r.fingerprint == 0} == {3}
    kept = simhash.drop_near_copies(edge_docs)
    assert kept.columns == edge_docs.columns
    assert kept.count() == len({r.root for r in groups})


def test_mixing(spark, edge_docs, edge_rows, no_docs):
    sizes = stage(mixing.sized(edge_docs), "sizes")
    rows = mixing.mix(sizes).collect()
    assert Counter((r.doc_id, r["size"]) for r in rows) == Counter((d, len(words(t or ""))) for d, t, *_ in edge_rows)
    assert all(0 <= r.times <= 3 and r.target <= 3 * r.source_size for r in rows)
    total = sum(r["size"] for r in rows)
    assert abs(sum({r.source: r.target for r in rows}.values()) - total) < 1e-6 * total
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mixing.mix(sizes.repartition(7)).collect()), key=str)
    taken = mixing.take_mix(edge_docs)
    assert taken.columns == edge_docs.columns
    assert taken.count() == sum(r.times for r in rows)
    assert mixing.mix(stage(mixing.sized(no_docs), "sizes")).count() == 0


def test_mixing_meets_targets(spark):
    taken, target, largest = Counter(), {}, Counter()
    docs = {r.doc_id: r.source for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in mixing.op9_mixing(spark, SF).collect():
        source = docs[r.doc_id]
        taken[source] += r.taken
        target[source] = r.target
        largest[source] = max(largest[source], r["size"])
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in target)


def test_repeated_rows_are_spelled_out_in_ranges(spark, monkeypatch):
    """A third of the rows are one row without an id; no task spells out more than a range of it."""
    monkeypatch.setattr(common, "COPIES", 7)
    rows = [(None, "")] * 40 + [(i, f"text {i % 30}") for i in range(60)] + [(5, "text 5")] * 20
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = block_names.exact_groups(docs).collect()
    assert Counter((r.doc_id, r.group_size, r.kept) for r in got) == Counter(
        [(None, 40, True)] + [(None, 40, False)] * 39
        + [(i, 22 if i % 30 == 5 else 2, i >= 30) for i in range(60)] + [(5, 22, False)] * 20
    )
    ranges = common.spelled(spark.createDataFrame([(1, 40), (2, 3)], "doc_id long, copies long"), ["doc_id"])
    assert Counter((r.doc_id, r.copy) for r in ranges.collect()) == Counter([(1, n) for n in range(1, 41)] + [(2, n) for n in range(1, 4)])


def test_repeated_rows_have_slots_of_their_own(spark, monkeypatch):
    """One row is half the table; slots are gapless, and the same in any layout."""
    monkeypatch.setattr(common, "COPIES", 7)
    monkeypatch.setattr(packing, "SLOT_ROWS", 5)
    rows = [(None, "")] * 60 + [(i, f"text {i % 40}") for i in range(60)]
    found = []
    for parts in (1, 7):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        slots = packing.number_slots(packing.shard_by_bytes(docs, 4), 4).collect()
        found.append(sorted((r.doc_id is not None, r.doc_id, r.digest, r.shard, r.slot) for r in slots))
    assert found[0] == found[1] and Counter((d, t) for d, t in rows) == Counter((r[1], next(t for _, t in rows if hashlib.sha256(t.encode()).hexdigest() == r[2])) for r in found[0])
    for shard in {r[3] for r in found[0]}:
        own = sorted(r[4] for r in found[0] if r[3] == shard)
        assert own == list(range(len(own)))


def test_records_of_one_repeated_row_are_spread(spark):
    docs = spark.createDataFrame([(None, "same")] * 400 + [(i, f"t {i}") for i in range(100)], "doc_id long, text string")
    path = fresh_path(spark, "records")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        token_records.write_tokens(docs.repartition(5), path, BPE, 2)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    import glob

    sizes = [len(open(p, "rb").read()) for p in glob.glob(path.removeprefix("file:") + "/*.records")]
    assert len(sizes) > 2 and max(sizes) < 0.6 * sum(sizes)
    got = token_records.read_tokens(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None] * 400 + list(range(100))
