"""The batch jobs, from files to stored tables to stored results.

They run on the session they are given; table names and paths are arguments.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import SparkSession, functions as F

from starledger import schemas
from starledger.operators import Leaderboards, leaderboards, similar_items, train, user_lists
from starledger.operators.leaderboards import boards_of, merged_counts, monthly_counts
from starledger.shared import delete_folder, list_files, new_folder, stored
from starledger.sources import (
    Store,
    parse_products,
    parse_ratings,
    read_table,
    rejects,
    scan_lines,
    write_table,
)


def load(
    spark: SparkSession,
    store: Store,
    products_path: str,
    ratings_path: str,
    *,
    product_table: str = "Product",
    rating_table: str = "Rating",
    rejected_table: str = "RejectedLines",
    trim: bool = True,
    mode: str = "strict",
    indexed: bool = True,
    max_rejected: int | None = None,
) -> None:
    """Parse both text sources and replace both tables.

    ``indexed`` lays products and ratings out by product and makes ratings findable by
    user; without it, or in a store that keeps no layout, the rows are written as they come,
    in one pass. In mode
    ``permissive`` the lines that cannot be read are stored as well, as (source, value, file,
    block_start). With more than ``max_rejected`` of them the load fails, after storing them and
    before it replaces another table.
    """
    located = mode == "permissive"
    products = parse_products(scan_lines(spark, products_path, located), trim, mode)
    ratings = parse_ratings(scan_lines(spark, ratings_path, located), mode)
    parsed = new_folder(spark, "parsed")
    if mode == "permissive":  # parsed once for the tables and for the rejected lines
        products, ratings = stored(products, f"{parsed}/p"), stored(ratings, f"{parsed}/r")
        products, bad_products = rejects(products)
        ratings, bad_ratings = rejects(ratings)
        rejected = bad_products.select(F.lit("products").alias("source"), "*").union(
            bad_ratings.select(F.lit("ratings").alias("source"), "*")
        )
        write_table(rejected, store, rejected_table)
        if max_rejected is not None and (found := rejected.count()) > max_rejected:
            where = rejected.groupBy("file").count().orderBy(F.desc("count"), "file").first()
            delete_folder(spark, parsed)
            raise ValueError(f"{found} lines rejected, {where['count']} of them in {where['file']}")
    indexed = indexed and store.keeps_layout
    key = "productId" if indexed else None
    write_table(products, store, product_table, cluster_by=key)
    write_table(
        ratings, store, rating_table, cluster_by=key, lookup_keys=["userId"] if indexed else []
    )
    delete_folder(spark, parsed)


def statistics(
    spark: SparkSession,
    store: Store,
    *,
    rating_table: str = "Rating",
    popular_table: str = "RateMoreProducts",
    monthly_table: str = "RateMoreRecentlyProducts",
    top_rated_table: str = "AverageProducts",
    tz: str | None = None,
    text_month: bool = False,
    files: int | None = None,
) -> None:
    """Compute the three leaderboards in one pass over the ratings and store them."""
    ratings = read_table(spark, store, rating_table, schemas.RATING)
    boards = leaderboards(ratings, tz, text_month)
    _write_boards(boards, store, popular_table, monthly_table, top_rated_table, files)
    boards.free()


def refresh_statistics(
    spark: SparkSession,
    store: Store,
    ratings_path: str,
    *,
    counts_table: str = "RatingCounts",
    popular_table: str = "RateMoreProducts",
    monthly_table: str = "RateMoreRecentlyProducts",
    top_rated_table: str = "AverageProducts",
    mode: str = "strict",
    tz: str | None = None,
    text_month: bool = False,
    files: int | None = None,
) -> list[str]:
    """Bring the leaderboards up to date with rating files that were not counted yet.

    Counts and sums per product and month are kept in ``counts_table`` with the names of the files
    that they are of, committed together. Only files that are not among them are read, and their
    paths are returned; counts of both are merged, and the boards follow from the counts.

    A counted file that has changed, or another ``tz`` than before, is an error: delete the
    table of counts to start over. A file that is gone stays counted. The store needs a root.
    """
    if store.root is None:
        raise ValueError("refreshing needs a store with a root")
    known = None
    counted: dict = {}
    if store.exists(spark, counts_table):
        known = read_table(spark, store, counts_table, schemas.COUNTED_FILES)
        for row in known.where("file is not null").select("file", "size", "modified", "zone").collect():
            counted[row.file] = (row.size, row.modified)
            if row.zone != tz:
                raise ValueError(f"counted with months of {row.zone or 'UTC'}")
    new = []
    for path, size, modified in list_files(spark, ratings_path):
        if path not in counted:
            new.append((path, size, modified, tz))
        elif counted[path] != (size, modified):
            raise ValueError(f"{path} has changed since it was counted")
    if new:
        counts = monthly_counts(parse_ratings(scan_lines(spark, [path for path, *_ in new]), mode), tz)
        names = spark.createDataFrame(new, "file string, size bigint, modified bigint, zone string")
        if known is not None:
            counts = merged_counts(known.where("file is null").select(counts.columns), counts)
            names = names.unionByName(known.where("file is not null").select(names.columns))
        together = counts.unionByName(names, allowMissingColumns=True)
        write_table(together.repartition("productId", "file"), store, counts_table)
    if new or known is not None:
        counts = read_table(spark, store, counts_table, schemas.COUNTED_FILES).where("file is null")
        _write_boards(boards_of(counts, text_month), store, popular_table, monthly_table, top_rated_table, files)
    return [path for path, *_ in new]


def _write_boards(
    boards: Leaderboards, store: Store, popular_table: str, monthly_table: str, top_rated_table: str, files: int | None
) -> None:
    orders = {
        popular_table: (boards.popular, [F.desc("count"), "productId"]),
        monthly_table: (
            boards.popular_by_month,
            [F.desc("yearmonth"), F.desc("count"), "productId"],
        ),
        top_rated_table: (boards.top_rated, [F.desc("avg"), "productId"]),
    }
    for name, (board, order) in orders.items():
        write_table(board, store, name, order_by=order, files=files)


def product_lists(
    spark: SparkSession,
    store: Store,
    *,
    rating_table: str = "Rating",
    user_table: str = "UserRecs",
    product_table: str | None = None,
    n: int = 20,
    min_score: float | None = 0.0,
    rank: int = 5,
    iterations: int = 10,
    reg: float = 0.01,
    seed: int = 0,
    cache: bool = False,
    files: int | None = None,
    solver: str = "ml",
) -> None:
    """Train factors, store each user's best products and, if named, similar products.

    Training reads the ratings to count them and to fit; ``cache`` keeps them on the
    executors' disks, for a source that is costly to read again. Their memory is left to training.
    """
    ratings = read_table(spark, store, rating_table, schemas.RATING)
    if cache:
        ratings = ratings.persist(StorageLevel.DISK_ONLY)
    try:
        model = train(ratings, rank, iterations, reg, seed, solver=solver)
        lists = user_lists(model, n, min_score)
        write_table(lists, store, user_table, files=files)
        if product_table:
            write_table(similar_items(model.item_factors, n), store, product_table)
        model.free()
    finally:
        if cache:
            ratings.unpersist()
