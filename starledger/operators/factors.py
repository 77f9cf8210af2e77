"""Learned user and product factors, and scores of given pairs."""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame, functions as F

from starledger.operators.split_als import checked, train_by_sums
from starledger.shared import delete_folder, ensure_checkpoint_dir, new_folder, stored

# Every half-step sends a factor to each block that has a rating with it, so what is shuffled grows with
# ids times blocks: there are as few blocks as a task's number of ratings allows.
_MIN_BLOCKS = 8

#: Ratings of a block. While a block is made, a rating takes about 50 bytes of the heap, which the tasks of
#: an executor share.
WANTED_BLOCK = 10_000_000

#: Ratings of a block with an id that alone has more than are wanted.
LARGEST_BLOCK = 20_000_000

#: Ids of a side whose factors go to every task, where pairs meet tables in buckets.
HOT_IDS = 1000


@dataclass(frozen=True)
class FactorModel:
    """``user_factors(userId, features)`` and ``item_factors(productId, features)``.

    ``tables`` are the names of both in the catalog, if they are kept in buckets by id.
    """

    user_factors: DataFrame
    item_factors: DataFrame
    rank: int
    folder: str | None = None
    tables: tuple[str, ...] = ()

    def free(self) -> None:
        """Delete the stored factors; the model is of no use afterwards."""
        spark = self.user_factors.sparkSession
        for name in self.tables:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        if self.folder:
            delete_folder(spark, self.folder)


def train(
    ratings: DataFrame,
    rank: int = 5,
    iterations: int = 10,
    reg: float = 0.01,
    seed: int = 0,
    blocks: int | None = None,
    solver: str = "ml",
    largest_block: int = LARGEST_BLOCK,
) -> FactorModel:
    """Explicit-feedback alternating least squares over (userId, productId, score).

    ``solver="ml"`` is Spark ML's. It splits the ratings into ``blocks`` on either side, by
    default as many as ``block_count`` finds from the ratings alone, so that a seed gives the same
    factors on any cluster. It keeps all ratings of an id in one block: an id with more than
    ``largest_block`` ratings is an error, found before training.
    ``solver="sums"`` solves the same systems by grouped sums that combine before the
    shuffle; no id is too large for it, but it is slower, starts elsewhere for the same
    seed, and has no blocks. The size of the data never changes the solver.

    A rating with a null or NaN score, or a null id, is an error with either.

    The factors are stored in the shared folder: what scores with them later never trains
    again, even when executors are lost. ``FactorModel.free`` deletes them.
    """
    spark = ratings.sparkSession
    ratings = checked(ratings)
    if solver == "sums":
        if blocks is not None:
            raise ValueError("the sums solver has no blocks")
        users, items = train_by_sums(ratings, rank, iterations, reg, seed)
        return _stored_model(users, items, rank)
    if solver != "ml":
        raise ValueError(f"no solver {solver!r}")
    ensure_checkpoint_dir(spark)
    if blocks is None:
        blocks = block_count(ratings, largest_block)
    model = spark_ml(rank, iterations, reg, seed, blocks).fit(ratings)
    users = model.userFactors.withColumnRenamed("id", "userId")
    return _stored_model(users, model.itemFactors.withColumnRenamed("id", "productId"), rank)


def spark_ml(rank: int, iterations: int, reg: float, seed: int, blocks: int) -> ALS:
    """Spark ML's solver, with its blocks on the executors' disks.

    A task holds what it works on outside the memory that Spark counts, so blocks kept there as well
    would take the heap from it.
    """
    return ALS(
        rank=rank,
        maxIter=iterations,
        regParam=reg,
        seed=seed,
        userCol="userId",
        itemCol="productId",
        ratingCol="score",
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        checkpointInterval=5,
        coldStartStrategy="drop",
        intermediateStorageLevel="DISK_ONLY",
        finalStorageLevel="DISK_ONLY",
    )


def block_count(ratings: DataFrame, largest_block: int = LARGEST_BLOCK, wanted: int = WANTED_BLOCK) -> int:
    """Blocks of ids modulo their number, of which none has more ratings than a block may.

    It may have those that are ``wanted``, and up to the largest only if one id alone has more than that.
    The ratings of every id are counted once, combined before the shuffle; the load of the blocks is
    summed from these counts for one number of blocks after the other, until all fit.
    """
    wanted = min(wanted, largest_block)
    sides = F.explode(F.array(
        F.struct(F.lit("userId").alias("side"), F.col("userId").alias("id")),
        F.struct(F.lit("productId").alias("side"), F.col("productId").alias("id")),
    ))
    folder = new_folder(ratings.sparkSession, "loads")
    loads = ratings.select(sides.alias("key")).groupBy("key.side", "key.id").agg(F.count(F.lit(1)).alias("n"))
    loads = stored(loads, folder)
    try:
        total, worst = loads.agg(F.sum("n") / 2, F.max(F.struct("n", "side", "id"))).first()
        if not total:
            return _MIN_BLOCKS
        if worst.n > largest_block:
            raise ValueError(
                f"{worst.side} {worst.id} has {worst.n} ratings, and a block holds {largest_block}: "
                'use solver="sums", or executors for a greater largest_block'
            )
        blocks = max(_MIN_BLOCKS, math.ceil(total / wanted))
        allowed = F.when(F.col("most") > wanted, largest_block).otherwise(wanted)
        while True:
            block = F.pmod("id", F.lit(blocks)).alias("block")
            load = loads.groupBy("side", block).agg(F.sum("n").alias("n"), F.max("n").alias("most"))
            if load.agg(F.every(F.col("n") <= allowed)).first()[0]:
                return blocks
            blocks = blocks + blocks // 4 | 1  # odd, so that ids in steps of two part as well
    finally:
        delete_folder(ratings.sparkSession, folder)


def _stored_model(users: DataFrame, items: DataFrame, rank: int) -> FactorModel:
    folder = new_folder(users.sparkSession, "factors")
    return FactorModel(stored(users, f"{folder}/users"), stored(items, f"{folder}/items"), rank, folder)


def in_buckets(model: FactorModel, buckets: int | None = None) -> FactorModel:
    """The same factors, cut by id once: no later scoring sends them through a shuffle.

    Both tables are sorted in ``buckets`` by id, by default as many as the session has shuffle
    partitions, in files of the shared folder that two tables of the session's catalog name.
    ``free`` of the new model drops them and leaves the old one as it is.
    """
    spark = model.user_factors.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = new_folder(spark, "buckets")
    names = []
    for factors, key in ((model.user_factors, "userId"), (model.item_factors, "productId")):
        names.append(f"factors_{key.lower()}_{uuid.uuid4().hex}")
        by_id = factors.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
        by_id.option("path", f"{folder}/{key}").saveAsTable(names[-1])
    return FactorModel(*map(spark.table, names), model.rank, folder, tuple(names))


def score_pairs(pairs: DataFrame, model: FactorModel) -> DataFrame:
    """Add the predicted ``score`` to (userId, productId) pairs, in place of any they have.

    Pairs with an unknown id are dropped.

    Two equi-joins with one row per key on the factor side: Spark broadcasts a factor
    table it has measured as small, and otherwise splits hot keys at run time.

    With a model ``in_buckets`` only pairs are shuffled. Spark splits no keys of such joins, so
    one pass over the pairs finds the most frequent ids of either side first; the factors of
    at most ``HOT_IDS`` go to every task, and their pairs are dealt out evenly. Ids of other
    types than the factors have are compared all the same, but shuffle the factors.
    """
    if model.tables:
        known = _joined_in_buckets(pairs, model)
    else:
        # Users last: lists of a user's pairs, or sums over them, then need no further shuffle.
        known = pairs.join(
            model.item_factors.withColumnRenamed("features", "item_features"), "productId"
        ).join(model.user_factors.withColumnRenamed("features", "user_features"), "userId")
    score = dot_product(F.col("user_features"), F.col("item_features"), model.rank)
    kept = [name for name in pairs.columns if name != "score"]
    return known.select(*kept, score.alias("score"))


def _joined_in_buckets(pairs: DataFrame, model: FactorModel) -> DataFrame:
    frequent = lambda key: F.expr(f"approx_top_k({key}, {HOT_IDS}, {8 * HOT_IDS})").alias(key)
    hot = pairs.agg(F.count(F.lit(1)).alias("n"), frequent("userId"), frequent("productId")).first()
    sides = ((model.user_factors, "userId", "user_features"), (model.item_factors, "productId", "item_features"))
    # The place of a hot id's pairs is that of any id: what they meet there is not used. Equal pairs
    # part by the task that reads them, which a rerun does not change.
    pairs = pairs.withColumn("_spread", F.hash("userId", "productId", F.spark_partition_id()))
    for factors, key, name in sides:
        # An id with fewer pairs than this is no load for the task that gets its bucket.
        ids = [x["item"] for x in hot[key] or () if x["item"] is not None and x["count"] * HOT_IDS > hot.n]
        known = factors.where(F.col(key).isin(ids)) if ids else factors.limit(0)
        known = known.select(F.col(key).alias("_hot_id"), F.col("features").alias("_hot_features"))
        pairs = pairs.join(F.broadcast(known), F.col(key) == F.col("_hot_id"), "left")
        place = F.when(F.col("_hot_id").isNull(), F.col(key)).otherwise(F.col("_spread").cast(factors.schema[key].dataType))
        pairs = pairs.withColumn("_place", place)
        cold = factors.select(F.col(key).alias("_cold_id"), F.col("features").alias("_cold_features"))
        pairs = pairs.join(cold, F.col("_place") == F.col("_cold_id"), "left")
        pairs = pairs.withColumn(name, F.coalesce("_hot_features", "_cold_features")).where(F.col(name).isNotNull())
        pairs = pairs.drop("_hot_id", "_hot_features", "_place", "_cold_id", "_cold_features")
    return pairs


def dot_product(left: Column, right: Column, rank: int) -> Column:
    """Sum of products in double precision, in index order, written out for codegen."""
    terms = [
        F.get(left, F.lit(k)).cast("double") * F.get(right, F.lit(k)).cast("double")
        for k in range(rank)
    ]
    return reduce(lambda total, term: total + term, terms)
