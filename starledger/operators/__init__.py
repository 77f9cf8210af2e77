from starledger.operators.factors import FactorModel, in_buckets, score_pairs, train
from starledger.operators.leaderboards import (
    Leaderboards,
    distinct_products,
    distinct_users,
    leaderboards,
    popular,
    popular_by_month,
    top_rated,
)
from starledger.operators.matching import best_matches
from starledger.operators.ranking import keep_positive, to_lists, top_n
from starledger.operators.product_lists import similar_items, user_lists

__all__ = [
    "FactorModel",
    "Leaderboards",
    "best_matches",
    "distinct_products",
    "distinct_users",
    "in_buckets",
    "keep_positive",
    "leaderboards",
    "popular",
    "popular_by_month",
    "score_pairs",
    "similar_items",
    "to_lists",
    "top_n",
    "top_rated",
    "train",
    "user_lists",
]
