import __spark_entry__ as contract
from oracles import ORACLES
from registry import QUERIES


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["split", "label", "users", "map", "ndcg_at_k", "precision_at_k", "recall_at_k"]
    rows = {(r.split, r.label): (r.users, r.map, r.ndcg_at_k, r.precision_at_k, r.recall_at_k) for r in df.collect()}
    assert rows[("test", "read")] == (146, 0.02484, 0.150198, 0.020548, 0.49155)
    assert rows[("validation", "liked")] == (128, 0.026937, 0.131135, 0.012734, 0.49042)


def test_split_scans_its_source_once(spark, capsys):
    QUERIES["split_train"](spark, "/root/testdata/sf0.001").explain()
    plan = capsys.readouterr().out
    assert plan.count("FileScan parquet") == 2  # the lines and the orders


def test_factor_model_queries(spark):
    for key in sorted(set(QUERIES) - set(ORACLES)):
        assert QUERIES[key](spark, "/root/testdata/sf0.001").limit(5).count() > 0, key
