"""Ratings and products in the engine's own layout, derived from the TPC-H-like tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ratings_from_orders(spark: SparkSession, folder: str) -> DataFrame:
    """A rating per order line: customer, part, a score of 1 to 5 by quantity, order date."""
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate"
    )
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return lines.join(orders, "l_orderkey").select(
        F.col("o_custkey").cast("int").alias("userId"),
        F.col("l_partkey").cast("int").alias("productId"),
        F.ceil(F.col("l_quantity") / 10).cast("double").alias("score"),
        _epoch_seconds("o_orderdate").alias("timestamp"),
    )


def products_from_part(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").cast("int").alias("productId"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("imageUrl"),
        F.col("p_type").alias("categories"),
        F.translate("p_name", " ", "|").alias("tags"),
    )


def factors_from_embeddings(spark: SparkSession, folder: str, key: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").cast("int").alias(key), F.col("embedding").alias("features")
    )


def _epoch_seconds(name: str):
    """Seconds of a zone-less timestamp, whatever the session's zone."""
    day = F.unix_date(F.col(name).cast("date"))
    time = F.hour(name) * 3600 + F.minute(name) * 60 + F.second(name)
    return (day * 86400 + time).cast("int")
