import numpy as np
import pytest
from pyspark.ml.recommendation import ALS
from pyspark.sql import functions as F

import __spark_entry__ as entry
from starledger.operators import FactorModel, factors, in_buckets, score_pairs, split_als, train, user_lists
from starledger.operators.factors import block_count
from starledger.sources import parse_ratings


@pytest.fixture(scope="module")
def ratings(spark):
    rng = np.random.default_rng(11)
    users, items = rng.normal(size=(60, 2)), rng.normal(size=(40, 2))
    rows = []
    for _ in range(1500):
        u, i = int(rng.integers(60)), int(rng.integers(40))
        rows.append((u + 100, i, float(np.clip(np.round(3 + users[u] @ items[i]), 1, 5)), 0))
    # A hot product, and many copies of one rating.
    rows += [(u + 100, 3, 4.0, 0) for u in range(60) for _ in range(5)]
    rows += [(100, 3, 2.0, 0)] * 400
    return spark.createDataFrame(
        rows, "userId int, productId int, score double, timestamp int"
    ).repartition(4)


@pytest.fixture(scope="module")
def model(ratings):
    return train(ratings, seed=5)


def by_id(df):
    return {row[0]: np.array(row[1]) for row in df.collect()}


def test_every_id_gets_factors(ratings, model):
    users = {r[0] for r in ratings.select("userId").distinct().collect()}
    items = {r[0] for r in ratings.select("productId").distinct().collect()}
    assert set(by_id(model.user_factors)) == users and set(by_id(model.item_factors)) == items
    assert model.user_factors.dtypes == [("userId", "int"), ("features", "array<float>")]
    assert all(len(v) == 5 for v in by_id(model.user_factors).values())


def test_same_seed_same_factors(ratings, model):
    again = by_id(train(ratings, seed=5).user_factors)
    first = by_id(model.user_factors)
    assert all(np.array_equal(first[key], again[key]) for key in first)


def test_fit_is_better_than_the_mean(ratings, model):
    scored = score_pairs(ratings.withColumnRenamed("score", "actual"), model)
    error, spread = scored.agg(
        F.sqrt(F.avg((F.col("score") - F.col("actual")) ** 2)), F.stddev("actual")
    ).first()
    assert error < spread


def test_score_pairs_is_the_dot_product_and_drops_unknown_ids(spark, model):
    u, v = by_id(model.user_factors), by_id(model.item_factors)
    pairs = spark.createDataFrame([(100, 3), (101, 4), (5, 3), (100, 999)], "userId int, productId int")
    got = {(r.userId, r.productId): r.score for r in score_pairs(pairs, model).collect()}
    assert set(got) == {(100, 3), (101, 4)}
    assert got[100, 3] == pytest.approx(np.dot(u[100], v[3]), rel=1e-12)
    rated = spark.createDataFrame([(100, 3, 1.0)], "userId int, productId int, score double")
    assert score_pairs(rated, model).collect() == [(100, 3, got[100, 3])]


def test_user_lists_agree_with_scoring_every_pair(model):
    u, v = by_id(model.user_factors), by_id(model.item_factors)
    rows = user_lists(model, 10).collect()
    assert rows
    for row in rows:
        scores = {i: float(np.dot(u[row.userId].astype(float), v[i].astype(float))) for i in v}
        positive = sorted((s for s in scores.values() if s > 0), reverse=True)[:10]
        assert [r.score for r in row.recs] == pytest.approx(positive)
        assert len({r.productId for r in row.recs}) == len(row.recs) <= 10


@pytest.mark.parametrize("broadcast_values", [split_als.BROADCAST_VALUES, 0])
def test_sums_equal_spark_ml_from_the_same_start(ratings, monkeypatch, broadcast_values):
    monkeypatch.setattr(split_als, "BROADCAST_VALUES", broadcast_values)

    def spark_ml(iterations):
        return ALS(
            rank=3, maxIter=iterations, regParam=0.05, seed=2,
            userCol="userId", itemCol="productId", ratingCol="score",
        ).fit(ratings)

    start = spark_ml(0).userFactors.withColumnRenamed("id", "userId")
    want = spark_ml(2)
    users, items = split_als.train_by_sums(ratings, 3, 2, 0.05, 0, start)
    for got, expected in [(users, want.userFactors), (items, want.itemFactors)]:
        a, b = by_id(got), by_id(expected)
        assert a.keys() == b.keys()
        assert all(np.allclose(a[key], b[key], rtol=1e-4, atol=1e-5) for key in a)


def test_sums_solver_learns(ratings):
    model = train(ratings, seed=5, solver="sums")
    scored = score_pairs(ratings.withColumnRenamed("score", "actual"), model)
    error, spread = scored.agg(
        F.sqrt(F.avg((F.col("score") - F.col("actual")) ** 2)), F.stddev("actual")
    ).first()
    assert error < spread
    assert isinstance(model, FactorModel) and model.user_factors.count() == 60


def test_bounds_do_not_change_the_factors(ratings, monkeypatch):
    def factors_of(solver):
        model = train(ratings, seed=5, iterations=2, solver=solver)
        return by_id(model.user_factors.withColumnRenamed("userId", "id"))

    before = {solver: factors_of(solver) for solver in ("ml", "sums")}
    monkeypatch.setattr(split_als, "BROADCAST_VALUES", 1)
    after = {solver: factors_of(solver) for solver in ("ml", "sums")}
    for solver, want in before.items():
        assert all(np.allclose(after[solver][key], want[key], atol=1e-5) for key in want)


def test_unknown_solvers_and_blocks_of_sums_are_errors(ratings):
    with pytest.raises(ValueError):
        train(ratings, solver="other")
    with pytest.raises(ValueError):
        train(ratings, solver="sums", blocks=3)


@pytest.mark.parametrize("solver", ["ml", "sums"])
@pytest.mark.parametrize("line", ["1,2,NaN,3", None, "user"])
def test_bad_ratings_are_an_error_in_both(spark, solver, line):
    if line == "1,2,NaN,3":
        lines = spark.createDataFrame([("1,1,3.0,1",), (line,)], "value string")
        broken = parse_ratings(lines)
    else:
        row = (1, 2, None) if line is None else (None, 2, 1.0)
        broken = spark.createDataFrame([(1, 1, 3.0), row], "userId int, productId int, score double")
    with pytest.raises(Exception, match="a rating has no"):
        train(broken, solver=solver)


def test_a_model_is_freed(spark, ratings):
    model = train(ratings, iterations=1)
    model.free()
    with pytest.raises(Exception):
        model.user_factors.collect()


def test_missing_ids_are_an_error(spark):
    broken = spark.createDataFrame([(1, None, 2.0)], "userId int, productId int, score double")
    with pytest.raises(Exception):
        train(broken)
    with pytest.raises(Exception, match="no productId"):
        split_als.train_by_sums(broken, 2, 1, 0.1, 0)


def test_hot_products_are_split_when_pairs_are_scored(spark, model):
    """With factor tables too big to broadcast, Spark splits the hot join key at run time."""
    pairs = spark.range(0, 300_000, 1, 8).select(
        (100 + F.col("id") % 60).cast("int").alias("userId"),
        F.when(F.col("id") % 3 < 2, 3).otherwise(F.col("id") % 40).cast("int").alias("productId"),
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        scored = score_pairs(pairs, model)
        assert len(scored.collect()) == 300_000
        assert "skew=true" in scored._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value else spark.conf.unset(key)


def _shuffles_under(plan, table):
    """Whether a shuffle lies between the scan of the table and the join that reads it."""
    lines = plan.splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :|+-"))
    found = []
    for at, line in enumerate(lines):
        if table in line:
            level = depth(line)
            for above in reversed(lines[:at]):
                if depth(above) < level:
                    level = depth(above)
                    if "Join" in above:
                        break
                    found.append("Exchange hash" in above or "ShuffleQueryStage" in above)
    assert found
    return any(found)


@pytest.mark.parametrize("hot", [True, False])
def test_factors_in_buckets_are_never_shuffled(spark, model, hot):
    pairs = spark.range(0, 60_000, 1, 8).select(
        (90 + F.col("id") % 80).cast("int").alias("userId"),
        F.when(F.lit(hot) & (F.col("id") % 3 < 2), 3).otherwise(F.col("id") % 50).cast("int").alias("productId"),
        F.lit(0.5).alias("score"),
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    cut = in_buckets(model, 16)
    want = sorted(map(tuple, score_pairs(pairs, model).collect()))
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        for _ in range(2):
            scored = score_pairs(pairs, cut)
            assert sorted(map(tuple, scored.collect())) == want
            plan = scored._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
            assert not any(_shuffles_under(plan, name) for name in cut.tables)
        odd = spark.createDataFrame([(None, 3), (100, None), (100, 999), (100, 3), (100, 3)], pairs.drop("score").schema)
        assert len(score_pairs(odd, cut).collect()) == 2
        assert score_pairs(odd.limit(0), cut).collect() == []
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value else spark.conf.unset(key)
        cut.free()
    assert not any(spark.catalog.tableExists(name) for name in cut.tables)
    assert model.user_factors.count() == 60


def test_pairs_of_a_hot_id_are_dealt_out(spark, model):
    """Two thirds of the pairs are one pair; no task of the joins gets more than its share."""
    pairs = spark.range(0, 90_000, 1, 64).select(
        F.when(F.col("id") % 3 < 2, 100).otherwise(100 + F.col("id") % 60).cast("int").alias("userId"),
        F.when(F.col("id") % 3 < 2, 3).otherwise(F.col("id") % 40).cast("int").alias("productId"),
    )
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {key: spark.conf.get(key, None) for key in settings}
    cut = in_buckets(model, 8)
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        scored = score_pairs(pairs, cut)
        sizes = [row["n"] for row in scored.groupBy(F.spark_partition_id().alias("at")).agg(F.count("*").alias("n")).collect()]
        assert sum(sizes) == 90_000 and max(sizes) < 90_000 / 3
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value else spark.conf.unset(key)
        cut.free()


def test_blocks_follow_the_measured_load(spark):
    even = spark.range(4000).selectExpr("int(id % 100) as userId", "int(id / 100) as productId", "1.0D as score")
    assert block_count(even) == 8
    assert block_count(even, largest_block=200) >= 20
    # All even ids: with a power of two half of the blocks would stay empty.
    steps = spark.range(4000).selectExpr("int(id % 100) * 64 as userId", "int(id / 100) as productId", "1.0D as score")
    blocks = block_count(steps, largest_block=400)
    loads = steps.groupBy(F.expr(f"userId % {blocks}")).count().agg(F.max("count")).first()[0]
    assert loads <= 400
    assert block_count(even.limit(0)) == 8


def test_blocks_are_as_few_as_their_ratings_allow(spark):
    """A factor is sent to every block, so blocks that grow with the ratings make the shuffle grow twice."""
    even = spark.range(12_000_000).selectExpr("int(id % 3000) as userId", "int(id / 3000) as productId", "1.0D as score")
    assert block_count(even) == 8
    assert 12 <= block_count(even, largest_block=1_000_000) <= 16


def test_an_id_that_fits_no_block_is_named_before_training(spark):
    ratings = spark.range(300).selectExpr("int(id) as userId", "int(if(id < 250, 7, id)) as productId", "1.0D as score")
    with pytest.raises(ValueError, match='productId 7 has 250 ratings.*solver="sums"'):
        train(ratings, largest_block=200)
    model = train(ratings, rank=2, iterations=1, solver="sums", largest_block=200)
    assert model.user_factors.count() == 300


def test_a_half_step_shuffles_neither_pairs_nor_sums(spark, monkeypatch):
    """Only the vectors are sent, to blocks of pairs that are joined and summed where they lie."""
    monkeypatch.setattr(split_als, "BROADCAST_VALUES", 0)
    plans, stored = [], split_als.stored

    def watched(df, path):
        if path.rpartition("/")[2].startswith(("userId-", "productId-")):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, path)

    monkeypatch.setattr(split_als, "stored", watched)
    even = spark.range(3000).selectExpr("int(id % 100) as userId", "int(id / 60) as productId", "double(id % 7) as score")
    users, _ = split_als.train_by_sums(even, 3, 3, 0.05, 0)
    assert users.count() == 100 and len(plans) >= 5
    for plan in plans:
        assert plan.count("Exchange hashpartitioning") == 1 and plan.count("+- Sort [") == 1, plan


def test_pairs_of_hot_ids_are_dealt_over_all_blocks(spark, monkeypatch, tmp_path):
    """A product and a user with about half of all pairs each give the same factors, and fill no block."""
    monkeypatch.setattr(split_als, "BROADCAST_VALUES", 0)
    rng = np.random.default_rng(3)
    rows = [(u, 7, float(rng.integers(1, 6))) for u in range(500)] + [(1, i, float(rng.integers(1, 6))) for i in range(500)]
    rows += [(int(rng.integers(500)), int(rng.integers(500)), float(rng.integers(1, 6))) for _ in range(200)]
    hot = spark.createDataFrame(rows, "userId int, productId int, score double")
    columns = {"userCol": "userId", "itemCol": "productId", "ratingCol": "score"}
    fit = lambda n: ALS(rank=3, maxIter=n, regParam=0.05, seed=2, **columns).fit(hot)
    start, want = fit(0).userFactors.withColumnRenamed("id", "userId"), fit(2)
    found = split_als.train_by_sums(hot, 3, 2, 0.05, 0, start)
    for got, expected in zip(found, (want.userFactors, want.itemFactors)):
        a, b = by_id(got), by_id(expected)
        assert a.keys() == b.keys()
        assert all(np.allclose(a[key], b[key], rtol=1e-3, atol=1e-4) for key in a)
    tables = {"userId": "hot_by_user", "productId": "hot_by_product"}
    try:
        blocks = split_als._write_pairs(hot, str(tmp_path / "pairs"), tables)
        assert blocks.hot == {"userId": [1], "productId": [7]}
        for name in tables.values():
            sizes = [row["count"] for row in spark.table(name).groupBy("block").count().collect()]
            assert len(sizes) == 8 and max(sizes) < sum(sizes) / 4
    finally:
        for name in tables.values():
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_a_vector_is_sent_only_to_blocks_with_its_pairs(spark, monkeypatch):
    """Users with one rating each: every vector goes to one block, not to all."""
    monkeypatch.setattr(split_als, "BROADCAST_VALUES", 0)
    single = spark.range(200).selectExpr("int(id) as userId", "int(id % 50) as productId", "double(id % 5) as score")
    routes, stored = [], split_als.stored

    def watched(df, path):
        found = stored(df, path)
        if path.rpartition("/")[2].startswith("userId-"):
            routes.append([row[0] for row in found.select(F.bit_count("routes")).collect()])
        return found

    monkeypatch.setattr(split_als, "stored", watched)
    split_als.train_by_sums(single, 2, 2, 0.1, 0)
    assert routes == [[1] * 200] * 2


def test_als_by_sums_makes_its_ratings_once(spark, ratings, monkeypatch):
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    monkeypatch.setattr(entry, "ratings_from_orders", lambda *_: ratings.mapInArrow(counted, ratings.schema))
    assert entry.als_by_sums(spark, "").count() == 60
    assert made.value == ratings.count()


def test_blocks_hold_what_is_wanted_and_more_only_for_a_larger_id(spark):
    even = spark.range(4000).selectExpr("int(id % 100) as userId", "int(id / 100) as productId", "1.0D as score")
    assert block_count(even, wanted=200) >= 20
    hot = spark.range(600).selectExpr("int(id) as userId", "int(if(id < 250, 7, id)) as productId", "1.0D as score")
    blocks = block_count(hot, largest_block=300, wanted=100)
    loads = dict(hot.groupBy(F.expr(f"productId % {blocks}")).count().collect())
    assert loads.pop(7 % blocks) <= 300 and max(loads.values()) <= 100
    with pytest.raises(ValueError, match="productId 7 has 250 ratings"):
        block_count(hot, largest_block=200, wanted=100)


def test_blocks_take_no_memory_from_the_tasks(spark, ratings):
    """What Spark ML keeps between its steps is on disk, as its tasks need the heap."""
    kept = lambda: dict(spark.sparkContext._jsc.getPersistentRDDs())
    before = set(kept())
    model = train(ratings, iterations=1)
    new = [rdd.getStorageLevel() for key, rdd in kept().items() if key not in before]
    assert all(level.useDisk() and not level.useMemory() for level in new)
    als = factors.spark_ml(2, 1, 0.1, 0, 3)
    assert (als.getIntermediateStorageLevel(), als.getFinalStorageLevel()) == ("DISK_ONLY", "DISK_ONLY")
    assert (als.getNumUserBlocks(), als.getNumItemBlocks()) == (3, 3)
    model.free()


def test_als_by_sums_counts_its_blocks(spark, ratings, monkeypatch):
    """Spark's own number of blocks does not grow with the ratings."""
    asked, fit = [], factors.spark_ml
    monkeypatch.setattr(entry, "ratings_from_orders", lambda *_: ratings)
    monkeypatch.setattr(entry, "block_count", lambda found, **_: 11 if found.count() == ratings.count() else 0)
    monkeypatch.setattr(entry, "spark_ml", lambda *args: asked.append(args[-1]) or fit(*args))
    assert entry.als_by_sums(spark, "").count() == 60
    assert asked == [11, 11]


def test_als_scores_makes_its_ratings_once(spark, ratings, monkeypatch):
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    monkeypatch.setattr(entry, "ratings_from_orders", lambda *_: ratings.mapInArrow(counted, ratings.schema))
    scored = entry.als_scores(spark, "")
    assert scored.columns == ["userId", "productId", "unknown"]
    assert scored.count() == scored.where("not unknown").count() == ratings.count() == made.value
