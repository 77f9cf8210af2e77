
from __future__ import annotations

import warnings
from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession, functions as F

from starledger import schemas
from starledger.functions import multi_value
from starledger.operators import (
    FactorModel,
    best_matches,
    distinct_products,
    distinct_users,
    in_buckets,
    keep_positive,
    leaderboards,
    popular,
    popular_by_month,
    score_pairs,
    similar_items,
    to_lists,
    top_n,
    top_rated,
    train,
    user_lists,
)
from starledger.operators.factors import block_count, spark_ml
from starledger.operators.pages import page, ranked, write_ranked
from starledger.operators.split_als import train_by_sums
from starledger.plans import jobs
from starledger.plans.derived import (
    factors_from_embeddings,
    products_from_part,
    ratings_from_orders,
    table,
)
from starledger.plans.sql import (
    popular_by_month_sql,
    popular_sql,
    register_ratings,
    top_rated_sql,
)
from starledger.shared import new_folder, stored
from starledger.sources.film import ratings_from_film
from starledger.sources import (
    Store,
    first_line,
    parse_products,
    parse_ratings,
    read_table,
    rejects,
    scan_lines,
    write_table,
)

SEED = 42


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the most rated products."""
    return popular(ratings_from_orders(spark, "/root/testdata/sf0.001"))


# --- text files ---------------------------------------------------------------------


def _product_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as seven-field lines, with blanks and a tab around the name."""
    products = products_from_part(spark, sf)
    name = F.concat(F.lit("  "), "name", F.lit(" \t"))
    return products.select(
        F.concat_ws(
            "^",
            F.col("productId").cast("string"),
            name,
            F.lit("1,2,3"),
            F.lit("B000000000"),
            "imageUrl",
            "categories",
            "tags",
        ).alias("value")
    )


def _rating_fields() -> list:
    return [F.col(name).cast("string") for name in ("userId", "productId", "score", "timestamp")]


def _rating_lines(spark: SparkSession, sf: str) -> DataFrame:
    return ratings_from_orders(spark, sf).select(
        F.concat_ws(",", *_rating_fields()).alias("value")
    )


def _damaged_rating_lines(spark: SparkSession, sf: str, *more) -> DataFrame:
    """Rating lines, with more columns if asked for, where scores of 1, 2 and 3 mark three kinds of damage."""
    user, product, score, seconds = _rating_fields()
    line = (
        F.when(F.col("score") == 1, F.concat_ws(",", user, F.lit("abc"), score, seconds))
        .when(F.col("score") == 2, F.concat_ws(",", F.concat(user, F.lit(".0")), product, score, seconds))
        .when(F.col("score") == 3, F.concat_ws(",", user, product, score))
        .otherwise(F.concat_ws(",", user, product, score, seconds))
    )
    return ratings_from_orders(spark, sf).select(line.alias("value"), *more)


def _as_text_file(lines: DataFrame) -> str:
    folder = new_folder(lines.sparkSession, "lines")
    lines.write.text(folder)
    return folder


def scan_products(spark: SparkSession, sf: str, trim: bool = True) -> DataFrame:
    path = _as_text_file(_product_lines(spark, sf))
    return parse_products(scan_lines(spark, path), trim=trim)


def scan_products_untrimmed(spark: SparkSession, sf: str) -> DataFrame:
    return scan_products(spark, sf, trim=False)


def scan_ratings(spark: SparkSession, sf: str) -> DataFrame:
    path = _as_text_file(_rating_lines(spark, sf))
    return parse_ratings(scan_lines(spark, path))


def scan_kept(spark: SparkSession, sf: str) -> DataFrame:
    return parse_ratings(_damaged_rating_lines(spark, sf), mode="drop")


def scan_rejects(spark: SparkSession, sf: str) -> DataFrame:
    _, bad = rejects(parse_ratings(_damaged_rating_lines(spark, sf), mode="permissive"))
    return bad


def scan_rejects_by_file(spark: SparkSession, sf: str) -> DataFrame:
    """Rejected lines of two files, with the file that each is from."""
    folder = new_folder(spark, "lines")
    newer = F.col("timestamp") >= 883_612_800
    part = F.when(newer, "newer").when(~newer, "older").alias("part")
    # Both in one pass, so that the ratings are joined once; one without a time is in neither.
    dated = _damaged_rating_lines(spark, sf, part).where("part is not null")
    dated.write.partitionBy("part").text(folder)
    lines = scan_lines(spark, f"{folder}/part=*", located=True)
    _, bad = rejects(parse_ratings(lines, mode="permissive"))
    return bad.select("value", F.regexp_extract("file", "/part=([a-z]+)/", 1).alias("part"))


def raw_first_line(spark: SparkSession, sf: str) -> DataFrame:
    ordered = products_from_part(spark, sf).orderBy("productId")
    line = F.concat_ws("^", F.col("productId").cast("string"), "name")
    return first_line(spark, _as_text_file(ordered.select(line.alias("value"))))


def multi_value_tags(spark: SparkSession, sf: str) -> DataFrame:
    return products_from_part(spark, sf).select(
        "productId", F.explode(multi_value(F.col("tags"))).alias("tag")
    )


# --- tables -------------------------------------------------------------------------


def _store(spark: SparkSession) -> Store:
    return Store(root=new_folder(spark, "store"))


def store_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    store = _store(spark)
    write_table(ratings_from_orders(spark, sf), store, "Rating")
    return read_table(spark, store, "Rating", schemas.RATING)


def store_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """A table replaced by a query that reads it."""
    store = _store(spark)
    write_table(ratings_from_orders(spark, sf), store, "Rating")
    better = read_table(spark, store, "Rating", schemas.RATING).where("score >= 3")
    write_table(better, store, "Rating")
    return read_table(spark, store, "Rating", schemas.RATING)


def store_clustered(spark: SparkSession, sf: str) -> DataFrame:
    store = _store(spark)
    write_table(
        ratings_from_orders(spark, sf),
        store,
        "Rating",
        cluster_by="productId",
        lookup_keys=["userId"],
    )
    return read_table(spark, store, "Rating", schemas.RATING)


def store_interleaved(spark: SparkSession, sf: str) -> DataFrame:
    store = _store(spark)
    write_table(ratings_from_orders(spark, sf), store, "Rating", cluster_by=["userId", "productId"])
    return read_table(spark, store, "Rating", schemas.RATING)


def store_single_file(spark: SparkSession, sf: str) -> DataFrame:
    store = _store(spark)
    board = popular(ratings_from_orders(spark, sf))
    order = [F.desc("count"), "productId"]
    write_table(board, store, "RateMoreProducts", order_by=order, files=1)
    return read_table(spark, store, "RateMoreProducts", schemas.POPULAR)


# --- leaderboards -------------------------------------------------------------------


def popular_products(spark: SparkSession, sf: str) -> DataFrame:
    return popular(ratings_from_orders(spark, sf))


def popular_products_sql(spark: SparkSession, sf: str) -> DataFrame:
    register_ratings(ratings_from_orders(spark, sf))
    return spark.sql(popular_sql("ratings"))


def popular_null_key(spark: SparkSession, sf: str) -> DataFrame:
    product = F.when(F.col("score") < 5, F.col("productId"))
    return popular(ratings_from_orders(spark, sf).withColumn("productId", product))


def popular_month(spark: SparkSession, sf: str) -> DataFrame:
    return popular_by_month(ratings_from_orders(spark, sf))


def popular_month_sql(spark: SparkSession, sf: str) -> DataFrame:
    register_ratings(ratings_from_orders(spark, sf))
    return spark.sql(popular_by_month_sql("ratings"))


def popular_month_text(spark: SparkSession, sf: str) -> DataFrame:
    return popular_by_month(ratings_from_orders(spark, sf), text_month=True)


def popular_month_text_sql(spark: SparkSession, sf: str) -> DataFrame:
    register_ratings(ratings_from_orders(spark, sf))
    return spark.sql(popular_by_month_sql("ratings", "yyyyMM"))


def popular_month_zone(spark: SparkSession, sf: str) -> DataFrame:
    return popular_by_month(ratings_from_orders(spark, sf), tz="America/New_York")


def popular_month_zone_sql(spark: SparkSession, sf: str) -> DataFrame:
    register_ratings(ratings_from_orders(spark, sf), tz="America/New_York")
    return spark.sql(popular_by_month_sql("ratings"))


def top_rated_products(spark: SparkSession, sf: str) -> DataFrame:
    return top_rated(ratings_from_orders(spark, sf))


def top_rated_products_sql(spark: SparkSession, sf: str) -> DataFrame:
    register_ratings(ratings_from_orders(spark, sf))
    return spark.sql(top_rated_sql("ratings"))


def one_pass_popular(spark: SparkSession, sf: str) -> DataFrame:
    return leaderboards(ratings_from_orders(spark, sf)).popular


def one_pass_popular_month(spark: SparkSession, sf: str) -> DataFrame:
    return leaderboards(ratings_from_orders(spark, sf)).popular_by_month


def one_pass_top_rated(spark: SparkSession, sf: str) -> DataFrame:
    return leaderboards(ratings_from_orders(spark, sf)).top_rated


def users(spark: SparkSession, sf: str) -> DataFrame:
    return distinct_users(ratings_from_orders(spark, sf))


def products(spark: SparkSession, sf: str) -> DataFrame:
    return distinct_products(ratings_from_orders(spark, sf))


def rating_triples(spark: SparkSession, sf: str) -> DataFrame:
    return ratings_from_orders(spark, sf).select("userId", "productId", "score")


# --- scores and rankings ------------------------------------------------------------


def _embedding_model(spark: SparkSession, sf: str) -> FactorModel:
    """Embeddings stand in for both factor tables, so that scores have an oracle."""
    return FactorModel(
        user_factors=factors_from_embeddings(spark, sf, "userId"),
        item_factors=factors_from_embeddings(spark, sf, "productId"),
        rank=64,
    )


def _label_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Every vector with the one that its label names: few, very hot products."""
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("int").alias("userId"), F.col("label").alias("productId")
    )


def _label_scores(spark: SparkSession, sf: str) -> DataFrame:
    return score_pairs(_label_pairs(spark, sf), _embedding_model(spark, sf))


def scored_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return _label_scores(spark, sf).withColumn("score", F.round("score", 6))


def scored_pairs_in_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """The same from factor tables that are cut by id once."""
    scored = score_pairs(_label_pairs(spark, sf), in_buckets(_embedding_model(spark, sf)))
    return scored.withColumn("score", F.round("score", 6))


def positive_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return keep_positive(_label_scores(spark, sf)).withColumn("score", F.round("score", 6))


def top_n_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return top_n(rating_triples(spark, sf))


def top_n_lists(spark: SparkSession, sf: str) -> DataFrame:
    lists = to_lists(top_n(rating_triples(spark, sf)))
    return lists.select("userId", _list_text("recs").alias("recs"))


def _list_text(recs: str):
    entry = lambda rec: F.concat_ws(
        ":", rec["productId"].cast("string"), rec["score"].cast("int").cast("string")
    )
    return F.array_join(F.transform(recs, entry), ",")


def _flat(lists: DataFrame, key: str) -> DataFrame:
    ranked = lists.select(key, F.posexplode("recs").alias("position", "rec"))
    return ranked.select(
        key,
        (F.col("position") + 1).alias("rank"),
        F.col("rec.productId").alias("productId" if key == "userId" else "similarId"),
        F.round("rec.score", 6).alias("score"),
    )


def matched_lists(spark: SparkSession, sf: str) -> DataFrame:
    model = _embedding_model(spark, sf)
    return _flat(user_lists(model), "userId")


def matched_lists_unfiltered(spark: SparkSession, sf: str) -> DataFrame:
    model = _embedding_model(spark, sf)
    return _flat(user_lists(model, n=400, min_score=None), "userId")


def matched_lists_sharded(spark: SparkSession, sf: str) -> DataFrame:
    """The same lists with blocks and shards small enough that several meet."""
    model = _embedding_model(spark, sf)
    lists = best_matches(
        model.user_factors, model.item_factors, users_per_block=200, products_per_shard=150
    )
    return _flat(lists, "userId")


def _sized(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Vectors of very different lengths: customers by orders, parts by size and price."""
    orders = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.floor(F.sum("o_totalprice") / 100_000).alias("total")
    )
    number = lambda name: F.col(name).cast("float")
    users = orders.select(
        F.col("o_custkey").cast("int").alias("userId"), F.array(number("n"), number("total")).alias("features")
    )
    price = F.floor(F.col("p_retailprice") / 100).cast("float")
    items = table(spark, sf, "part").select(
        F.col("p_partkey").cast("int").alias("productId"), F.array(number("p_size"), price).alias("features")
    )
    return users, items


def matched_lists_pruned(spark: SparkSession, sf: str) -> DataFrame:
    """Whole lists where the search of each user ends early, over several shards."""
    return _flat(best_matches(*_sized(spark, sf), n=10, products_per_shard=700), "userId")


def similar_products(spark: SparkSession, sf: str) -> DataFrame:
    lists = similar_items(factors_from_embeddings(spark, sf, "productId"), n=10)
    return _flat(lists, "productId")


def similar_products_in_cells(spark: SparkSession, sf: str) -> DataFrame:
    """The same lists with cells so small that there are many pivots."""
    factors = factors_from_embeddings(spark, sf, "productId")
    return _flat(similar_items(factors, n=10, products_per_cell=40), "productId")


def als_users(spark: SparkSession, sf: str) -> DataFrame:
    return train(ratings_from_orders(spark, sf), seed=SEED).user_factors.select("userId")


def als_items(spark: SparkSession, sf: str) -> DataFrame:
    return train(ratings_from_orders(spark, sf), seed=SEED).item_factors.select("productId")


def als_scores(spark: SparkSession, sf: str) -> DataFrame:
    # Made once, as they are counted, trained with and scored.
    ratings = stored(rating_triples(spark, sf), new_folder(spark, "ratings"))
    scored = score_pairs(ratings.drop("score"), train(ratings, seed=SEED))
    return scored.select("userId", "productId", F.isnan("score").alias("unknown"))


def als_sums_lists_checked(spark: SparkSession, sf: str) -> DataFrame:
    """The same from the solver that sums, from its own start."""
    model = train(ratings_from_orders(spark, sf), seed=SEED, solver="sums")
    return _checked_lists(user_lists(model), model)


def als_lists_checked(spark: SparkSession, sf: str) -> DataFrame:
    """What must hold of each user's list, whatever the factors are."""
    model = train(ratings_from_orders(spark, sf), seed=SEED)
    return _checked_lists(user_lists(model), model)


def _checked_lists(lists: DataFrame, model: FactorModel) -> DataFrame:
    entry = F.explode("recs").alias("rec")
    listed = lists.select("userId", entry).select(
        "userId", F.col("rec.productId").alias("productId"), F.col("rec.score").alias("listed")
    )
    exact = (
        score_pairs(listed, model)
        .groupBy("userId")
        .agg(F.every(F.col("score") == F.col("listed")).alias("exact"))
    )
    scores = F.col("recs.score")
    return lists.join(exact, "userId").select(
        "userId",
        "exact",
        (F.sort_array(scores, asc=False) == scores).alias("in_order"),
        (F.array_min(scores) > 0).alias("positive"),
        (F.size(F.array_distinct("recs.productId")) == F.size("recs")).alias("distinct_products"),
        (F.size("recs") <= 20).alias("at_most_n"),
    )


def als_by_sums(spark: SparkSession, sf: str) -> DataFrame:
    """Both solvers from the same start: whether they agree on each user's factors."""
    # Made once, as three trainings read them.
    ratings = stored(ratings_from_orders(spark, sf), new_folder(spark, "ratings"))
    blocks = block_count(ratings, largest_block=2**31 - 1)  # an id of any size is tried with both

    def by_spark_ml(iterations: int) -> DataFrame:
        model = spark_ml(5, iterations, 0.01, SEED, blocks).fit(ratings)
        return model.userFactors.withColumnRenamed("id", "userId")

    users, _ = train_by_sums(ratings, 5, 10, 0.01, SEED, user_factors=by_spark_ml(0))
    gaps = F.zip_with("features", "expected", lambda a, b: F.abs(a - b))
    expected = by_spark_ml(10).withColumnRenamed("features", "expected")
    return users.join(expected, "userId").select(
        "userId", (F.array_max(gaps) < 1e-3).alias("agree")
    )


# --- whole jobs ---------------------------------------------------------------------


def _loaded(spark: SparkSession, sf: str) -> Store:
    store = _store(spark)
    jobs.load(
        spark,
        store,
        _as_text_file(_product_lines(spark, sf)),
        _as_text_file(_rating_lines(spark, sf)),
    )
    return store


def job_load(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, _loaded(spark, sf), "Product", schemas.PRODUCT)


def job_statistics(spark: SparkSession, sf: str) -> DataFrame:
    store = _loaded(spark, sf)
    jobs.statistics(spark, store)
    return read_table(spark, store, "RateMoreRecentlyProducts", schemas.POPULAR_BY_MONTH)


def job_load_ratings(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, _loaded(spark, sf), "Rating", schemas.RATING)


def job_statistics_popular(spark: SparkSession, sf: str) -> DataFrame:
    store = _loaded(spark, sf)
    jobs.statistics(spark, store)
    return read_table(spark, store, "RateMoreProducts", schemas.POPULAR)


def job_statistics_top_rated(spark: SparkSession, sf: str) -> DataFrame:
    store = _loaded(spark, sf)
    jobs.statistics(spark, store)
    return read_table(spark, store, "AverageProducts", schemas.TOP_RATED)


def job_lists(spark: SparkSession, sf: str) -> DataFrame:
    """What must hold of the stored lists."""
    store = _loaded(spark, sf)
    jobs.product_lists(spark, store, seed=SEED)
    lists = read_table(spark, store, "UserRecs", schemas.USER_RECS)
    ratings = read_table(spark, store, "Rating", schemas.RATING)
    return _checked_lists(lists, train(ratings, seed=SEED))


def job_lists_cached(spark: SparkSession, sf: str) -> DataFrame:
    """The same with the ratings kept on the executors while factors are trained."""
    store = _loaded(spark, sf)
    jobs.product_lists(spark, store, seed=SEED, cache=True)
    lists = read_table(spark, store, "UserRecs", schemas.USER_RECS)
    ratings = read_table(spark, store, "Rating", schemas.RATING)
    return _checked_lists(lists, train(ratings, seed=SEED))


def _refreshed(spark: SparkSession, sf: str) -> Store:
    """Statistics of older ratings, brought up to date when the files of newer ones are there."""
    store, folder = _store(spark), new_folder(spark, "lines")
    newer = F.col("timestamp") >= 883_612_800  # 1998
    for part in (~newer, newer):
        lines = ratings_from_orders(spark, sf).where(part).select(F.concat_ws(",", *_rating_fields()).alias("value"))
        lines.write.mode("append").text(folder)
        jobs.refresh_statistics(spark, store, folder)
    return store


def refreshed_popular(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, _refreshed(spark, sf), "RateMoreProducts", schemas.POPULAR)


def refreshed_month(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, _refreshed(spark, sf), "RateMoreRecentlyProducts", schemas.POPULAR_BY_MONTH)


def refreshed_top_rated(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, _refreshed(spark, sf), "AverageProducts", schemas.TOP_RATED)


def _monthly_order() -> list:
    return [F.desc("yearmonth"), F.desc("count"), "productId"]


def ranked_months(spark: SparkSession, sf: str) -> DataFrame:
    """Every row of the monthly board with its rank in the whole board."""
    return ranked(popular_by_month(ratings_from_orders(spark, sf)), _monthly_order())


def board_page(spark: SparkSession, sf: str) -> DataFrame:
    """Fifty rows from the middle of a stored board."""
    store = _store(spark)
    write_ranked(popular_by_month(ratings_from_orders(spark, sf)), _monthly_order(), store, "Ranked")
    return page(spark, store, "Ranked", 2001, 2050)


def film_ratings(spark: SparkSession, sf: str) -> DataFrame:
    """Film ratings under their own names, taken over as ratings."""
    films = ratings_from_orders(spark, sf).withColumnsRenamed({"userId": "uid", "productId": "mid"})
    return ratings_from_film(films)


def _training_data():
    """The training-data subpackage's queries and its pipeline, if they can be imported."""
    modules = []
    for name in ("starledger.llm.queries", "corpus_pipeline"):
        try:
            modules.append(import_module(name))
        except ImportError as missing:
            warnings.warn(f"queries of {name} are left out: {missing}", stacklevel=2)
    return modules


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {
        query.__name__: query
        for query in (
            scan_products,
            scan_products_untrimmed,
            scan_ratings,
            scan_kept,
            scan_rejects,
            scan_rejects_by_file,
            raw_first_line,
            multi_value_tags,
            store_roundtrip,
            store_overwrite,
            store_clustered,
            store_interleaved,
            store_single_file,
            popular_products,
            popular_products_sql,
            popular_null_key,
            popular_month,
            popular_month_sql,
            popular_month_text,
            popular_month_text_sql,
            popular_month_zone,
            popular_month_zone_sql,
            top_rated_products,
            top_rated_products_sql,
            one_pass_popular,
            one_pass_popular_month,
            one_pass_top_rated,
            users,
            products,
            rating_triples,
            scored_pairs,
            scored_pairs_in_buckets,
            positive_pairs,
            top_n_pairs,
            top_n_lists,
            matched_lists,
            matched_lists_unfiltered,
            matched_lists_sharded,
            matched_lists_pruned,
            similar_products,
            similar_products_in_cells,
            als_users,
            als_items,
            als_scores,
            als_sums_lists_checked,
            als_lists_checked,
            als_by_sums,
            job_load,
            job_statistics,
            job_load_ratings,
            job_statistics_popular,
            job_statistics_top_rated,
            job_lists,
            job_lists_cached,
            refreshed_popular,
            refreshed_month,
            refreshed_top_rated,
            ranked_months,
            board_page,
            film_ratings,
        )
    }
    for module in _training_data():
        found |= module.queries()
    return found


# --- oracles ------------------------------------------------------------------------

_RATINGS = """
    ratings AS (
        SELECT CAST(o_custkey AS INT) AS "userId", CAST(l_partkey AS INT) AS "productId",
               CAST(ceil(l_quantity / 10) AS DOUBLE) AS score,
               CAST(epoch(o_orderdate) AS INT) AS "timestamp"
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey
    )"""

_PRODUCTS = """
    SELECT CAST(p_partkey AS INT) AS "productId", {name} AS name, p_brand AS "imageUrl",
           p_type AS categories, replace(p_name, ' ', '|') AS tags
    FROM part"""

_POPULAR = """
    SELECT "productId", count("productId") AS count FROM ratings GROUP BY "productId" """

_TOP_RATED = """
    SELECT "productId", avg(score) AS avg FROM ratings GROUP BY "productId" """

_MONTH = "strftime(make_timestamp(CAST(\"timestamp\" AS BIGINT) * 1000000), '%Y%m')"
_ZONE_MONTH = (
    "strftime(timezone('America/New_York', "
    "timezone('UTC', make_timestamp(CAST(\"timestamp\" AS BIGINT) * 1000000))), '%Y%m')"
)


def _by_month(month: str) -> str:
    return f"""
        WITH {_RATINGS}
        SELECT "productId", count("productId") AS count, {month} AS yearmonth
        FROM ratings GROUP BY "productId", yearmonth"""


_DAMAGED = """
            CASE CAST(score AS INT)
                WHEN 1 THEN concat_ws(',', "userId", 'abc', score, "timestamp")
                WHEN 2 THEN concat_ws(',', "userId" || '.0', "productId", score, "timestamp")
                ELSE concat_ws(',', "userId", "productId", score) END"""

_TOP_N = """
    top_pairs AS (
        SELECT "userId", "productId", score,
               CAST(row_number() OVER (
                   PARTITION BY "userId" ORDER BY score DESC, "productId") AS INT) AS rank
        FROM ratings WHERE score > 0 QUALIFY rank <= 20
    )"""

_LABEL_PAIRS = """
    pairs AS (
        SELECT CAST(u.vec_id AS INT) AS "userId", u.label AS "productId",
               list_inner_product(u.embedding::DOUBLE[], p.embedding::DOUBLE[]) AS score
        FROM embeddings u JOIN embeddings p ON p.vec_id = u.label
    )"""


def _matched(n: int, where: str) -> str:
    return f"""
        WITH pairs AS (
            SELECT CAST(u.vec_id AS INT) AS "userId", CAST(p.vec_id AS INT) AS "productId",
                   list_inner_product(u.embedding::DOUBLE[], p.embedding::DOUBLE[]) AS score
            FROM embeddings u CROSS JOIN embeddings p
        ), ranked AS (
            SELECT *, CAST(row_number() OVER (
                PARTITION BY "userId" ORDER BY score DESC, "productId") AS INT) AS rank
            FROM pairs {where}
        )
        SELECT "userId", rank, "productId", round(score, 6) AS score
        FROM ranked WHERE rank <= {n}"""


_SIMILAR = """
    WITH pairs AS (
        SELECT CAST(a.vec_id AS INT) AS "productId", CAST(b.vec_id AS INT) AS "similarId",
               list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS score
        FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id
    ), ranked AS (
        SELECT *, CAST(row_number() OVER (
            PARTITION BY "productId" ORDER BY score DESC, "similarId") AS INT) AS rank
        FROM pairs
    )
    SELECT "productId", rank, "similarId", round(score, 6) AS score
    FROM ranked WHERE rank <= 10"""


_PRUNED = """
    WITH users AS (
        SELECT o_custkey, count(*)::DOUBLE AS n, floor(sum(o_totalprice) / 100000)::DOUBLE AS total
        FROM orders GROUP BY o_custkey
    ), scored AS (
        SELECT CAST(o_custkey AS INT) AS "userId", CAST(p_partkey AS INT) AS "productId",
            n * p_size + total * floor(p_retailprice / 100) AS score
        FROM users, part
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY "userId" ORDER BY score DESC, "productId") AS rank
        FROM scored WHERE score > 0
    )
    SELECT "userId", CAST(rank AS INT) AS rank, "productId", round(score, 6) AS score
    FROM ranked WHERE rank <= 10"""


def oracle_sql() -> dict[str, str]:
    rows = f"WITH {_RATINGS} SELECT * FROM ratings"
    popular_rows = f"WITH {_RATINGS} {_POPULAR}"
    top_rated_rows = f"WITH {_RATINGS} {_TOP_RATED}"
    month = _by_month(f"CAST({_MONTH} AS INT)")
    month_text = _by_month(_MONTH)
    ranked_rows = f"""
        WITH board AS ({month})
        SELECT *, row_number() OVER (ORDER BY yearmonth DESC, count DESC, "productId") AS rank FROM board"""
    matched = _matched(20, "WHERE score > 0")
    scored = f"""
        WITH {_LABEL_PAIRS}
        SELECT "userId", "productId", round(score, 6) AS score FROM pairs"""
    trimmed = _PRODUCTS.format(name="p_name")
    checked_lists = f"""
        WITH {_RATINGS}
        SELECT DISTINCT "userId", true AS exact, true AS in_order, true AS positive,
               true AS distinct_products, true AS at_most_n
        FROM ratings"""
    found = {
        "scan_products": trimmed,
        "scan_products_untrimmed": _PRODUCTS.format(name="'  ' || p_name || ' ' || chr(9)"),
        "scan_ratings": rows,
        "scan_kept": f"{rows} WHERE score > 3",
        "scan_rejects": f"WITH {_RATINGS} SELECT {_DAMAGED} AS value FROM ratings WHERE score <= 3",
        "scan_rejects_by_file": f"""
            WITH {_RATINGS}
            SELECT {_DAMAGED} AS value, CASE WHEN "timestamp" >= 883612800 THEN 'newer' ELSE 'older' END AS part
            FROM ratings WHERE score <= 3""",
        "raw_first_line": """
            SELECT p_partkey || '^' || p_name AS value
            FROM part WHERE p_partkey = (SELECT min(p_partkey) FROM part)""",
        "multi_value_tags": """
            SELECT CAST(p_partkey AS INT) AS "productId", unnest(string_split(p_name, ' ')) AS tag
            FROM part""",
        "store_roundtrip": rows,
        "store_overwrite": f"{rows} WHERE score >= 3",
        "store_clustered": rows,
        "store_interleaved": rows,
        "store_single_file": popular_rows,
        "popular_products": popular_rows,
        "popular_products_sql": popular_rows,
        "popular_null_key": f"""
            WITH {_RATINGS}, keyed AS (
                SELECT CASE WHEN score < 5 THEN "productId" END AS "productId" FROM ratings
            )
            SELECT "productId", count("productId") AS count FROM keyed GROUP BY "productId" """,
        "popular_month": month,
        "popular_month_sql": month,
        "popular_month_text": month_text,
        "popular_month_text_sql": month_text,
        "popular_month_zone": _by_month(f"CAST({_ZONE_MONTH} AS INT)"),
        "top_rated_products": top_rated_rows,
        "top_rated_products_sql": top_rated_rows,
        "one_pass_popular": popular_rows,
        "one_pass_popular_month": month,
        "one_pass_top_rated": top_rated_rows,
        "users": f'WITH {_RATINGS} SELECT DISTINCT "userId" FROM ratings',
        "products": f'WITH {_RATINGS} SELECT DISTINCT "productId" FROM ratings',
        "rating_triples": f'WITH {_RATINGS} SELECT "userId", "productId", score FROM ratings',
        "scored_pairs": scored,
        "scored_pairs_in_buckets": scored,
        "positive_pairs": f"""
            WITH {_LABEL_PAIRS}
            SELECT "userId", "productId", round(score, 6) AS score FROM pairs WHERE score > 0""",
        "top_n_pairs": f"WITH {_RATINGS}, {_TOP_N} SELECT * FROM top_pairs",
        "top_n_lists": f"""
            WITH {_RATINGS}, {_TOP_N}
            SELECT "userId", string_agg("productId" || ':' || CAST(score AS INT), ',' ORDER BY rank)
                AS recs
            FROM top_pairs GROUP BY "userId" """,
        "matched_lists": matched,
        "matched_lists_unfiltered": _matched(400, ""),
        "matched_lists_sharded": matched,
        "similar_products": _SIMILAR,
        "similar_products_in_cells": _SIMILAR,
        "als_users": f'WITH {_RATINGS} SELECT DISTINCT "userId" FROM ratings',
        "als_items": f'WITH {_RATINGS} SELECT DISTINCT "productId" FROM ratings',
        "als_scores": f"""
            WITH {_RATINGS} SELECT "userId", "productId", false AS unknown FROM ratings""",
        "als_lists_checked": checked_lists,
        "als_sums_lists_checked": checked_lists,
        "job_lists": checked_lists,
        "job_lists_cached": checked_lists,
        "refreshed_popular": popular_rows,
        "refreshed_month": month,
        "refreshed_top_rated": top_rated_rows,
        "ranked_months": ranked_rows,
        "board_page": f"{ranked_rows} QUALIFY rank BETWEEN 2001 AND 2050",
        "job_load_ratings": rows,
        "job_statistics_popular": popular_rows,
        "job_statistics_top_rated": top_rated_rows,
        "film_ratings": rows,
        "popular_month_zone_sql": _by_month(f"CAST({_ZONE_MONTH} AS INT)"),
        "matched_lists_pruned": _PRUNED,
        "als_by_sums": f'WITH {_RATINGS} SELECT DISTINCT "userId", true AS agree FROM ratings',
        "job_load": trimmed,
        "job_statistics": month,
    }
    for module in _training_data():
        found |= module.oracle_sql()
    return found
