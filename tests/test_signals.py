import pytest

from tastemill.operators import signals
from tastemill.functions.signals import label_rule

SCHEMA = "user_id int, item_id int, rating float, is_read int, is_reviewed int"
# rating, read, reviewed -> explicit, implicit, combined(1, 2)
ROWS = [
    (5.0, 1, 1, 5, 3, 5), (1.0, 1, 0, 1, 1, 1), (3.0, 0, 0, 3, None, 3), (0.0, 1, 1, None, 3, 2),
    (0.0, 0, 1, None, 2, 2), (0.0, 1, 0, None, 1, 1), (0.0, 0, 0, None, None, None),
    (None, 1, 0, None, 1, 1), (4.0, None, 0, 4, None, 4),
]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame([(1, i, *r[:3]) for i, r in enumerate(ROWS)], SCHEMA)


@pytest.mark.parametrize("make,column", [
    (signals.explicit_signal, 3),
    (signals.implicit_signal, 4),
    (lambda d: signals.combined_signal(d, 1.0, 2.0), 5),
])
def test_scores(df, make, column):
    got = {r.item_id: r.score for r in make(df).collect()}
    assert got == {i: float(r[column]) for i, r in enumerate(ROWS) if r[column] is not None}


def test_dedupe_keeps_the_best_score(spark):
    df = spark.createDataFrame([(1, 1, 2.0, 0, 0), (1, 1, 5.0, 0, 0), (1, 2, 1.0, 0, 0)], SCHEMA)
    assert {(r.item_id, r.score) for r in signals.explicit_signal(df, dedupe=True).collect()} == {(1, 5.0), (2, 1.0)}
    assert signals.explicit_signal(df).count() == 3


def test_labels(df):
    got = {(r.item_id, r.label) for r in signals.build_labels(df, ["read", "liked"], extra=()).collect()}
    read = {(i, "read") for i, r in enumerate(ROWS) if r[1] == 1}
    liked = {(i, "liked") for i, r in enumerate(ROWS) if (r[0] or 0) >= 4}
    assert got == read | liked
    with pytest.raises(ValueError):
        label_rule("wished")


def test_cohort(spark):
    df = spark.createDataFrame([(1, 1, 0.0, 1, 0), (2, 1, 3.0, 0, 0), (2, 2, 0.0, 0, 0)], SCHEMA)
    got = {tuple(r) for r in signals.popularity_cohort(df).collect()}
    assert got == {(1, "read"), (2, "read"), (2, "liked")}
