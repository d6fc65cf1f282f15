"""The pipeline's stages, each against brute force on its own input."""

from collections import Counter

import corpus_pipeline
from tastemill.llm.common import stage, table
from tastemill.llm.queries import ORACLES
from tests.llm.conftest import SF
from tests.llm.test_documents import fingerprint, linked, lowered
from tests.llm.test_models import TOXIC
from tests.oracle import connect, rows_of


def test_stages(spark):
    docs = table(spark, SF, "documents")
    kept = []
    for name, make in corpus_pipeline.STAGES:
        before, docs = docs, stage(make(spark, docs, SF), name)
        kept.append((name, before.collect(), docs))
    assert [name for name, _, _ in kept] == ["toxicity", "exact_dedup", "simhash", "mixing", "sentencepiece"]
    columns = table(spark, SF, "documents").columns
    assert all(after.columns == columns for _, _, after in kept[:-1])
    rows = [after.collect() for _, _, after in kept]
    dropped = {r.doc_id for r in kept[0][1]} - {r.doc_id for r in rows[0]}
    assert {r.doc_id for r in kept[0][1] if TOXIC.search(r.text.lower())} & dropped
    largest = {}
    for r in kept[1][1]:
        largest[lowered(r.text)] = max(largest.get(lowered(r.text), -1), r.doc_id)
    assert sorted(largest.values()) == sorted(r.doc_id for r in rows[1])
    left = sorted(kept[2][1], key=lambda r: r.doc_id)
    roots = linked([fingerprint(r.text) for r in left])
    assert sorted({left[i].doc_id for i in roots}) == sorted(r.doc_id for r in rows[2])
    assert max(Counter(r.doc_id for r in rows[3]).values()) <= 3
    assert Counter(r.doc_id for r in rows[3]) == Counter(r.doc_id for r in rows[4])
    assert all(r.parity and r.round_trip for r in rows[4])


def test_stages_on_edge_cases(spark, edge_docs, edge_rows, no_docs, tmp_path):
    """Nulls, empty and very long texts, ties, repeated rows and ids, clashing names; then an empty table."""
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 1), (None, 1, 1), (2, None, None)], "doc_id long, quality int, toxic int")
    for name, docs in (("edge", edge_docs), ("none", no_docs)):
        docs.write.parquet(str(tmp_path / name / "documents.parquet"))
        labels.write.parquet(str(tmp_path / name / "labels.parquet"))
    rows = corpus_pipeline.run(spark, str(tmp_path / "edge")).collect()
    texts = {lowered(r[1]) for r in edge_rows}
    left = table(spark, str(tmp_path / "edge"), "documents")
    for _, make in corpus_pipeline.STAGES[:2]:
        left = stage(make(spark, left, str(tmp_path / "edge")), "edge")
        assert left.columns == edge_docs.columns
    assert sorted(lowered(r.text) for r in left.collect()) == sorted(texts)
    assert 0 < len({r.doc_id for r in rows}) <= len(texts)
    assert all(r.parity and r.round_trip and r.n_tokens == len(r.ids) for r in rows)
    assert max(Counter((r.doc_id, tuple(r.ids)) for r in rows).values()) <= 3
    assert 40_000 <= max(r.n_tokens for r in rows)  # the long text is whole
    empty = corpus_pipeline.run(spark, str(tmp_path / "none"))
    assert empty.count() == 0 and empty.columns == ["doc_id", "ids", "n_tokens", "parity", "round_trip"]


def test_oracles(spark):
    from tastemill.llm.queries import QUERIES

    with connect(SF) as con:
        for key, sql in ORACLES.items():
            df = QUERIES[key](spark, SF)
            cur = con.execute(sql)
            assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of([d[0] for d in cur.description], cur.fetchall()), key
