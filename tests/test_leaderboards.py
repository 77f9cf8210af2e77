import pytest
from pyspark.sql import functions as F

from starledger import schemas
from starledger.operators import (
    distinct_products,
    distinct_users,
    leaderboards,
    popular,
    popular_by_month,
    top_rated,
)
from starledger.plans.sql import (
    popular_by_month_sql,
    popular_sql,
    register_ratings,
    top_rated_sql,
)

MARCH, FEBRUARY = 1393632000, 1393631999


@pytest.fixture
def ratings(spark):
    rows = [
        (1, 10, 5.0, MARCH),
        (2, 10, 4.0, FEBRUARY),
        (3, 10, None, FEBRUARY),
        (1, 11, 3.0, MARCH),
        (2, 11, 1.0, MARCH),
        (1, 9, 5.0, None),
        (2, 9, 3.0, MARCH),
        (4, None, 2.0, MARCH),
        (4, 12, None, MARCH),
        (5, 13, 5.0, MARCH),
    ]
    return spark.createDataFrame(rows, schemas.RATING)


POPULAR = [(10, 3), (9, 2), (11, 2), (12, 1), (13, 1), (None, 0)]
MONTHS = [
    (11, 2, 201403), (9, 1, 201403), (10, 1, 201403), (12, 1, 201403), (13, 1, 201403),
    (None, 0, 201403), (10, 2, 201402), (9, 1, None),
]
TOP = [(13, 5.0), (10, 4.5), (9, 4.0), (None, 2.0), (11, 2.0), (12, None)]


def test_popular_counts_non_null_products_and_breaks_ties(ratings):
    assert popular(ratings).collect() == POPULAR
    assert popular(ratings).dtypes == [("productId", "int"), ("count", "bigint")]


def test_popular_by_month(ratings):
    assert popular_by_month(ratings).collect() == MONTHS
    text = popular_by_month(ratings, text_month=True)
    assert text.collect() == [(p, c, m and str(m)) for p, c, m in MONTHS]
    assert text.dtypes[2] == ("yearmonth", "string")
    shanghai = popular_by_month(ratings, tz="Asia/Shanghai")
    assert [r.yearmonth for r in shanghai.collect()] == [201403] * 6 + [None]


def test_top_rated_has_no_minimum_support(ratings):
    # A NULL product sorts first among equal means.
    assert top_rated(ratings).collect() == TOP


def test_one_pass_gives_the_same(ratings):
    boards = leaderboards(ratings)
    assert boards.popular.collect() == POPULAR
    assert boards.popular_by_month.collect() == MONTHS
    assert boards.top_rated.collect() == TOP
    assert boards.popular.dtypes == [("productId", "int"), ("count", "bigint")]
    assert leaderboards(ratings, text_month=True).popular_by_month.dtypes[2][1] == "string"


def test_sql_text(spark, ratings):
    register_ratings(ratings, "rated")
    assert spark.sql(popular_sql("rated")).collect() == POPULAR
    assert spark.sql(popular_by_month_sql("rated")).collect() == MONTHS
    assert spark.sql(popular_by_month_sql("rated", "yyyyMM")).first().yearmonth == "201403"
    assert spark.sql(top_rated_sql("rated")).collect() == TOP


def test_group_by_alias_of_a_month_function(spark, ratings):
    register_ratings(ratings)
    rows = spark.sql(
        "select productId,count(productId) as n,changeDate(timestamp) as m from ratings "
        "group by productId,m order by m desc,n desc"
    )
    assert rows.first() == (11, 2, 201403)


def test_distinct_ids(ratings):
    assert sorted(r[0] for r in distinct_users(ratings).collect()) == [1, 2, 3, 4, 5]
    assert {r[0] for r in distinct_products(ratings).collect()} == {9, 10, 11, 12, 13, None}


def test_a_hot_product_is_combined_before_the_shuffle(spark):
    hot = spark.range(0, 200_000, 1, 8).select(
        F.lit(1).alias("userId"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("int").alias("productId"),
        F.lit(2.0).alias("score"),
        F.lit(MARCH).alias("timestamp"),
    )
    assert popular(hot).first() == (7, 66_668)
    plan = popular_by_month(hot)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "Python" not in plan and "UDF" not in plan
