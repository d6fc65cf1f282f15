import pytest
from pyspark.sql import functions as F

from tastemill import schemas
from tastemill.operators import profile
from tastemill.operators.sampling import sample_users
from tastemill.sources import tables

HEADER = "user_id,item_id,is_read,rating,is_reviewed"


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_csv_types_and_empty_cells(spark, tmp_path):
    df = tables.read_interactions_csv(spark, write(tmp_path / "a.csv", HEADER, "1,2,1,4.0,0", "3,4,0,,1"))
    assert df.schema == schemas.INTERACTIONS
    assert sorted(map(tuple, df.collect())) == [(1, 2, 1, 4.0, 0), (3, 4, 0, None, 1)]


def test_csv_header_in_another_order_is_an_error(spark, tmp_path):
    path = write(tmp_path / "b.csv", "item_id,user_id,is_read,rating,is_reviewed", "1,2,1,4.0,0")
    with pytest.raises(Exception, match="header"):
        tables.read_interactions_csv(spark, path).collect()


def test_csv_bad_cells(spark, tmp_path):
    path = write(tmp_path / "c.csv", HEADER, "1,2,1,4.0,0", "x,2,1,4.0,0", "1,2,1,bad,0", "1,2,1", "5,6,,,")
    row = tables.malformed_rows(spark, path, schemas.INTERACTIONS).first()
    assert (row.rows, row.malformed) == (5, 3)
    assert tables.read_interactions_csv(spark, path).where("user_id is null").count() == 1
    with pytest.raises(Exception):
        tables.read_interactions_csv(spark, path, mode="FAILFAST").collect()


def test_rejected_lines_and_their_reasons(spark, tmp_path):
    path = write(tmp_path / "r.csv", HEADER, "1,2,1,4.0,0", "x,2,1,4.0,0", "1,2,1,bad,0", "1,2,1", "5,6,,,", "y,6,,z,")
    rows = tables.rejected_rows(spark, path, schemas.INTERACTIONS).collect()
    assert sorted((r.line, r.reason) for r in rows) == [
        ("1,2,1", "cells"), ("1,2,1,bad,0", "rating"), ("x,2,1,4.0,0", "user_id"), ("y,6,,z,", "user_id")]


def test_metrics_are_taken_while_writing(spark, tmp_path):
    rows = [(u, u % 5, u % 2, float(u % 6), 0) for u in range(300)] + [(None, 1, 1, None, 1), (7, 1, 1, 2.5, 1)]
    df = spark.createDataFrame(rows, schemas.INTERACTIONS)
    table = tables.write_bucketed(df, str(tmp_path / "t"), profile.observed_metrics())
    observed = tables.read_table(spark, str(tmp_path / "t") + "-observed")
    row = observed.first()
    assert (row.row_count, row.total_read, row.incomplete, row.rating_3, row.rating_other) == (302, 152, 1, 50, 1)
    assert table.count() == 302 and set(profile.observed_reports(observed)) == {"row_count", "signal_totals"}
    whole = tables.write_bucketed(df.where("rating <> 2.5"), str(tmp_path / "w"), profile.observed_metrics())
    reports = profile.observed_reports(tables.read_table(spark, str(tmp_path / "w") + "-observed"))
    for name, make in (("row_count", profile.row_count), ("rating_histogram", profile.rating_histogram), ("signal_totals", profile.signal_totals)):
        assert reports[name].collect() == make(whole).collect()


def test_samples_read_their_buckets_only(spark, tmp_path, capsys):
    df = spark.createDataFrame([(u, 1, 1, 4.0, 0) for u in range(2000)], schemas.INTERACTIONS)
    table = tables.write_bucketed(df, str(tmp_path / "t"))
    sample = sample_users(table, 3, bucket="bucket")
    assert sorted(sample.collect()) == sorted(sample_users(df, 3).collect())
    sample.explain()
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(bucket" in plan and "(bucket#" in plan


def test_id_map(spark, tmp_path):
    df = tables.read_id_map(spark, write(tmp_path / "m.csv", "id,raw_id", "0,abc", "1,def"))
    assert sorted(map(tuple, df.collect())) == [(0, "abc"), (1, "def")]


def test_export_is_one_file(spark, tmp_path):
    out = tmp_path / "out"
    tables.export_csv(spark.range(100).repartition(7), str(out))
    assert len(list(out.glob("part-*.csv"))) == 1
    assert spark.read.option("header", True).csv(str(out)).count() == 100


def test_write_table_replaces_and_prunes(spark, tmp_path):
    df = spark.range(10).withColumn("split", F.when(F.col("id") < 5, "a").otherwise("b"))
    for _ in range(2):
        back = tables.write_table(df, str(tmp_path / "t"), "split")
    assert back.count() == 10 and set(back.columns) == {"id", "split"}
    assert tables.read_table(spark, str(tmp_path / "t"), df.schema).where("split = 'a'").count() == 5


@pytest.mark.parametrize("buckets", [1, 16, 1024])
def test_encode_ids_is_dense_and_free_of_layout(spark, buckets):
    df = spark.createDataFrame([(f"u{i % 300}",) for i in range(900)] + [(None,)], "raw string")
    base = {r.raw_id: r.id for r in tables.encode_ids(df, "raw", buckets).collect()}
    assert sorted(base.values()) == list(range(300))
    assert base == {r.raw_id: r.id for r in tables.encode_ids(df.repartition(9), "raw", buckets).collect()}
