"""Film ratings in the product-rating layout, so that every operator applies to them."""

from __future__ import annotations

from pyspark.sql import DataFrame


def ratings_from_film(film_ratings: DataFrame) -> DataFrame:
    return film_ratings.withColumnsRenamed({"uid": "userId", "mid": "productId"})
