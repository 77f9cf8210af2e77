import numpy as np
import pytest

from starledger import schemas
from starledger.operators import FactorModel, best_matches, matching, neighbors, similar_items, user_lists

NAN = float("nan")


def factors(spark, key, vectors, kind="float"):
    rows = [(int(i), [float(x) for x in v]) for i, v in vectors]
    return spark.createDataFrame(rows, f"{key} int, features array<{kind}>")


def lists(df):
    return {r[0]: [(x.productId, x.score) for x in r.recs] for r in df.collect()}


def brute_force(users, items, n, above, skip_same=False):
    out = {}
    for user, u in users:
        scored = []
        for item, v in items:
            score = 0.0
            for a, b in zip(u, v):
                score += float(a) * float(b)
            if (above is None or score > above) and not (skip_same and user == item):
                scored.append((item, score))
        scored.sort(key=lambda pair: (not np.isnan(pair[1]), -pair[1], pair[0]))
        if scored:
            out[user] = scored[:n]
    return out


def same(got, want):
    return repr(sorted(got.items())) == repr(sorted(want.items()))


@pytest.fixture(scope="module")
def random_factors():
    rng = np.random.default_rng(3)
    users = [(i * 7, rng.normal(size=5).astype(np.float32)) for i in range(300)]
    # Lengths differ, so that pruning has something to do; repeated vectors make ties.
    items = [
        (i * 3, (rng.normal(size=5) * rng.exponential()).astype(np.float32)) for i in range(700)
    ]
    items += [(5000 + i, items[i][1]) for i in range(200)]
    items += [(9000 + i, np.zeros(5, np.float32)) for i in range(30)]
    return users, items


@pytest.mark.parametrize("n", [1, 20, 2000])
@pytest.mark.parametrize("above", [0.0, None, 1.5, -0.25])
def test_equals_brute_force(spark, random_factors, n, above):
    users, items = random_factors
    got = best_matches(
        factors(spark, "userId", users), factors(spark, "productId", items), n, above
    )
    assert same(lists(got), brute_force(users, items, n, above))


@pytest.mark.parametrize("per_block, per_shard", [(40, 100), (1000, 50), (10, 10_000)])
def test_blocks_and_shards_do_not_change_the_result(spark, random_factors, per_block, per_shard):
    users, items = random_factors
    got = best_matches(
        factors(spark, "userId", users),
        factors(spark, "productId", items),
        users_per_block=per_block,
        products_per_shard=per_shard,
    )
    assert same(lists(got), brute_force(users, items, 20, 0.0))
    assert got.schema.simpleString() == f"struct<userId:int,recs:{schemas.RECOMMENDATIONS}>"


def test_settled_users_are_not_sent_to_later_shards(spark):
    rng = np.random.default_rng(8)
    users = [(i, rng.normal(size=4)) for i in range(200)]
    # Lengths halve every 100 products, so a few shards settle everybody.
    items = [(i, rng.normal(size=4) * 0.5 ** (i // 100)) for i in range(1600)]
    model = factors(spark, "userId", users, "double"), factors(spark, "productId", items, "double")
    matcher = matching._cell_matcher(5, 0.0, False)
    rounds = matching.by_length(
        model[0].selectExpr("userId", "features as user_vector", "0.0D as needed"),
        model[1].selectExpr("productId", "features as item_vector"),
        5, matcher, 16, 50, 100,
    )
    searched, settled = zip(*((s.select("userId").collect(), done.select("userId").collect()) for s, done in rounds))
    assert len(searched) < 5 and len(searched[0]) == 200 and len(searched[-1]) < 100
    for k in range(1, len(searched)):
        gone = {r.userId for part in settled[:k] for r in part}
        assert gone.isdisjoint(r.userId for r in searched[k]) and len(gone) + len(searched[k]) == 200
    got = best_matches(*model, 5, users_per_block=50, products_per_shard=100)
    assert same(lists(got), brute_force(users, items, 5, 0.0))
    plan = got._jdf.queryExecution().analyzed().toString()
    assert "flatten" not in plan


def clustered_vectors(products, clusters, rank=6):
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(clusters, rank))
    rows = [(i, centers[i % clusters] + 0.02 * rng.normal(size=rank)) for i in range(products)]
    # A cluster with a third of all products, copies among them, and some in no cluster.
    rows += [(products + i, centers[0] + 0.02 * (i % 50) * np.ones(rank)) for i in range(products // 2)]
    return rows + [(2 * products + i, rng.normal(size=rank)) for i in range(40)]


def test_similar_items_visit_few_cells(spark):
    rows = clustered_vectors(1200, 40)
    unit = [(i, v / np.sqrt((v * v).sum())) for i, v in rows]
    vectors = factors(spark, "productId", unit, "double").withColumnRenamed("features", "item_vector")
    pivots = np.array([v for _, v in unit[:60]])
    items = neighbors.in_cells(vectors, pivots).cache()
    own = matching.searched(
        items.selectExpr("productId as userId", "item_vector as user_vector", "double('-inf') as needed", "cell"),
        items, matching._cell_matcher(5, None, True), 10_000, 10_000,
    )
    state = items.selectExpr(
        "productId as userId", "item_vector as user_vector", "double('-inf') as needed", "cell",
        f"cast(array() as {schemas.RECOMMENDATIONS}) as recs",
    )
    state = matching.with_found(state, own, 5)
    visits = neighbors.cells_to_visit(state, items, pivots).count()
    items.unpersist()
    assert visits < 0.2 * len(rows) * 60
    want = brute_force(unit, unit, 5, None, True)
    for cell in (30, 400, None):
        got = lists(similar_items(factors(spark, "productId", rows, "double"), 5, products_per_cell=cell))
        assert got.keys() == want.keys()
        for product, recs in want.items():
            assert [s for _, s in got[product]] == pytest.approx([s for _, s in recs], abs=1e-12)


def test_many_tiles(spark):
    rng = np.random.default_rng(5)
    users = [(i, rng.normal(size=2)) for i in range(3)]
    items = [(i, rng.normal(size=2).round(1)) for i in range(9000)]
    got = best_matches(
        factors(spark, "userId", users, "double"), factors(spark, "productId", items, "double"), 30
    )
    assert same(lists(got), brute_force(users, items, 30, 0.0))


@pytest.mark.parametrize("above", [0.0, None])
@pytest.mark.parametrize("skip_same", [False, True])
def test_many_copies_of_one_product(spark, above, skip_same):
    rng = np.random.default_rng(9)
    copies = rng.normal(size=(2, 3)).astype(np.float32)
    users = [(i, rng.normal(size=3).astype(np.float32)) for i in range(20)]
    ids = rng.permutation(6000)
    items = [(int(i), copies[i % 2] if k < 5000 else rng.normal(size=3).astype(np.float32))
             for k, i in enumerate(ids)]
    items += [(7000 + i, np.zeros(3, np.float32)) for i in range(500)]
    for per_shard in (None, 1500):
        got = best_matches(
            factors(spark, "userId", users), factors(spark, "productId", items), 7, above,
            exclude_same_id=skip_same, products_per_shard=per_shard,
        )
        assert same(lists(got), brute_force(users, items, 7, above, skip_same))


def test_few_candidates_and_users_without_any(spark):
    users = [(1, [1.0, 0.0]), (2, [-1.0, -1.0]), (3, [0.0, 0.0])]
    items = [(10, [1.0, 1.0]), (11, [2.0, 0.0]), (12, [0.0, 5.0])]
    got = lists(best_matches(factors(spark, "userId", users), factors(spark, "productId", items)))
    assert got == {1: [(11, 2.0), (10, 1.0)]}


def test_nan_factors(spark):
    users = [(1, [1.0, 1.0]), (2, [NAN, 1.0])]
    items = [(10, [1.0, 1.0]), (11, [NAN, 0.0]), (12, [float("inf"), 0.0]), (13, [2.0, 2.0])]
    u, i = factors(spark, "userId", users), factors(spark, "productId", items)
    for shards in (1, 4):
        for above in (0.0, None):
            got = best_matches(u, i, 3, above, products_per_shard=4 // shards)
            assert same(lists(got), brute_force(users, items, 3, above))


def test_empty_inputs(spark):
    none = factors(spark, "userId", [])
    items = factors(spark, "productId", [(1, [1.0])])
    assert best_matches(none, items).collect() == []
    users = factors(spark, "userId", [(1, [1.0])])
    assert best_matches(users, factors(spark, "productId", [])).collect() == []


def test_candidates_can_be_narrowed(spark, random_factors):
    users, items = random_factors
    model = FactorModel(factors(spark, "userId", users), factors(spark, "productId", items), 5)
    some_users = spark.createDataFrame([(7,), (14,), (999_999,)], "userId int")
    some_items = spark.createDataFrame([(3,), (6,), (9,), (12,)], "productId int")
    got = lists(user_lists(model, 2, None, some_users, some_items))
    want = brute_force(
        [u for u in users if u[0] in (7, 14)], [i for i in items if i[0] in (3, 6, 9, 12)], 2, None
    )
    assert same(got, want)


def test_similar_items(spark):
    items = [(1, [1.0, 0.0]), (2, [5.0, 0.0]), (3, [1.0, 1.0]), (4, [-2.0, 0.0]), (5, [0.0, 0.0])]
    result = similar_items(factors(spark, "productId", items), 2)
    assert result.columns == ["productId", "recs"]
    got = lists(result)
    assert set(got) == {1, 2, 3, 4}
    assert got[1][0] == (2, 1.0) and got[1][1][0] == 3
    assert got[1][1][1] == pytest.approx(0.5**0.5)
    assert [p for p, _ in got[3]] == [1, 2]
    assert all(product != other for product, recs in got.items() for other, _ in recs)


def test_pairs_are_never_formed(spark, random_factors):
    users, items = random_factors
    lists_df = best_matches(factors(spark, "userId", users), factors(spark, "productId", items))
    plan = lists_df._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Broadcast" not in plan


def test_products_are_sent_to_runs_of_cells(spark):
    """Vectors in no clusters: nearly all cells are worth a visit, and still few rows are sent."""
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=12)) for i in range(400)]
    unit = [(i, v / np.sqrt((v * v).sum())) for i, v in rows]
    vectors = factors(spark, "productId", unit, "double").withColumnRenamed("features", "item_vector")
    pivots = np.array([v for _, v in unit[:80]])
    items = neighbors.in_cells(vectors, pivots).cache()
    state = items.selectExpr("productId as userId", "item_vector as user_vector", "0.3D as needed", "cell")
    run = np.arange(80) // 40
    sent = neighbors.cells_to_visit(state, items, pivots, run).select("userId", "home", "cell").collect()
    alone = {(r.userId, run[r.cell]) for r in neighbors.cells_to_visit(state, items, pivots).collect()}
    items.unpersist()
    assert len(sent) <= 800 and {(r.userId, r.cell) for r in sent} == alone
    got = lists(similar_items(factors(spark, "productId", rows, "double"), 6, products_per_cell=5))
    want = brute_force(unit, unit, 6, None, True)
    assert {i: [p for p, _ in recs] for i, recs in got.items()} == {i: [p for p, _ in recs] for i, recs in want.items()}


def test_blocks_and_shards_share_tasks(spark, random_factors):
    """However small the blocks and shards, tasks are as few as their users need."""
    users, items = random_factors
    visits = factors(spark, "userId", users).selectExpr("userId", "features as user_vector", "0.0D as needed", "0 as cell")
    visited = factors(spark, "productId", items).selectExpr("productId", "features as item_vector", "0 as cell")
    found = matching.searched(visits, visited, matching._cell_matcher(20, 0.0, False), 3, 4)
    assert found.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    assert same(lists(found), brute_force(users, items, 20, 0.0))


def test_copies_that_no_list_can_reach_are_left_out(spark):
    items = [(i, [float(i % 3), 1.0]) for i in range(300)] + [(300, [NAN, 0.0]), (301, [NAN, 0.0]), (302, [NAN, 0.0])]
    vectors = factors(spark, "productId", items).withColumnRenamed("features", "item_vector")
    kept = sorted(row.productId for row in matching.without_copies(vectors, 2).collect())
    assert kept == [0, 1, 2, 3, 4, 5, 300, 301]


def test_products_reach_a_task_in_a_stream(spark, random_factors):
    """No task holds all products of a block, and no lists are merged after."""
    users, items = random_factors
    got = best_matches(factors(spark, "userId", users), factors(spark, "productId", items), 400, None)
    plan = got._jdf.queryExecution().analyzed().toString()
    assert "MapInArrow" in plan and "CoGroup" not in plan and "collect_list" not in plan
