import random

from pyspark.sql import functions as F

from tastemill.plans import experiments as ex
from tastemill.plans.jobs import Workspace


def write_inputs(tmp_path):
    rng = random.Random(11)
    lines = ["user_id,item_id,is_read,rating,is_reviewed"]
    for user in range(120):
        for item in rng.sample(range(40), rng.randint(3, 25)):
            read = int(rng.random() < 0.7)
            rating = rng.choice([0, 3, 4, 5]) if read else 0
            lines += [f"{user},{item},{read},{rating},{int(rng.random() < 0.3)}"] * (2 if item == 7 else 1)
    csv, ids = tmp_path / "interactions.csv", tmp_path / "users.csv"
    csv.write_text("\n".join(lines) + "\n")
    ids.write_text("id,raw_id\n" + "\n".join(f"{u},user-{u}" for u in range(120)) + "\n")
    return str(csv), str(ids), len(lines) - 1


def test_pipeline(spark, tmp_path):
    csv, ids, n = write_inputs(tmp_path)
    ws = Workspace(spark, str(tmp_path / "base"), sample_pct=80, k=10)
    assert ws.ingest(csv, users=ids).count() == n
    ws.profile()
    report = spark.read.option("header", True).csv(ws.path("reports", "row_count", sampled=False))
    assert report.first().row_count == str(n)
    sample = ws.sample()
    assert 0 < sample.count() < n
    dealt = ws.split()
    sizes = sample.groupBy("user_id").count().where("count >= 5")
    assert dealt.drop("split").exceptAll(sample).count() == 0
    assert dealt.count() == sizes.agg(F.sum("count")).first()[0]
    assert dealt.groupBy("user_id").agg(F.count_distinct("split").alias("n")).where("n < 3").count() == 0
    assert ws.popularity(pool=30).count() == 4
    assert ws.similar_items(min_readers=5, k=20).count() == 20
    grid = ws.grid([ex.explicit_config(r, 0.1, pool=30, sample_pct=80) for r in (2, 4)], [("validation", "liked")])
    assert grid.where("model = 'explicit'").count() == 2
    best = ws.select("explicit")
    assert {r.split for r in best.collect()} == {"validation", "test"} and best.where("rmse is null").count() == 0
    ws.grid([ex.implicit_config(4, pool=40, sample_pct=80)], [("validation", "read"), ("test", "read")])
    ws.report("explicit")
    out = spark.read.option("header", True).csv(ws.path("reports", "explicit_liked_grid")).collect()
    assert len(out) == 2 and float(out[0].ndcg_at_k) >= float(out[1].ndcg_at_k)
    lifts = ex.compare_models(ws.runs, "popularity").collect()
    assert {(r.label, r.model) for r in lifts} == {
        ("read", "popularity"), ("read", "implicit"), ("liked", "popularity"), ("liked", "explicit")}
