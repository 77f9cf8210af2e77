import random

import pytest

from starledger import schemas
from starledger.operators import keep_positive, to_lists, top_n

NAN = float("nan")


@pytest.fixture
def scores(spark):
    rows = [(1, p, 1.0 + p) for p in range(25)]
    rows += [(2, p, 1.0 + p) for p in range(20)]
    rows += [(3, 5, 2.0), (3, 4, 2.0), (3, 9, 3.0), (3, 1, 0.0), (3, 2, -1.0), (3, 3, NAN)]
    rows += [(4, 1, 0.0), (4, 2, -5.0), (4, 3, NAN)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "userId int, productId int, score double")


def lists(df):
    return {r.userId: [(x.productId, x.score) for x in r.recs] for r in df.collect()}


def test_keep_positive_is_strict_and_drops_nan(scores):
    kept = keep_positive(scores).where("userId >= 3").collect()
    assert sorted(r.productId for r in kept) == [4, 5, 9]
    assert keep_positive(scores, 2.0).where("userId = 3").first().productId == 9


def test_lists(scores):
    result = to_lists(top_n(scores))
    assert result.schema.simpleString() == f"struct<userId:int,recs:{schemas.RECOMMENDATIONS}>"
    got = lists(result)
    assert set(got) == {1, 2, 3}
    assert got[1] == [(p, 1.0 + p) for p in range(24, 4, -1)]
    assert len(got[2]) == 20
    assert got[3] == [(9, 3.0), (4, 2.0), (5, 2.0)]


def test_unfiltered_keeps_all_pairs_nan_first(scores):
    got = lists(to_lists(top_n(scores, min_score=None)))
    assert [p for p, _ in got[3]] == [3, 9, 4, 5, 1, 2]
    assert [p for p, _ in got[4]] == [3, 1, 2]


def test_ranks_beyond_the_early_cut(spark):
    rows = [(7, p, float(p % 50)) for p in range(3000)]
    df = spark.createDataFrame(rows, "userId int, productId int, score double").repartition(6)
    ranked = top_n(df, n=1500).orderBy("rank").collect()
    want = sorted((r for r in rows if r[2] > 0), key=lambda r: (-r[2], r[1]))[:1500]
    assert [(r.userId, r.productId, r.score) for r in ranked] == want


def test_rows_are_cut_before_the_shuffle(scores):
    plan = top_n(scores)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
