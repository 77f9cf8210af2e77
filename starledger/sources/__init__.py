from starledger.sources.film import ratings_from_film
from starledger.sources.store import Store, read_table, write_table
from starledger.sources.text import (
    CORRUPT,
    first_line,
    parse_products,
    parse_ratings,
    rejects,
    scan_lines,
)

__all__ = [
    "CORRUPT",
    "Store",
    "first_line",
    "parse_products",
    "parse_ratings",
    "ratings_from_film",
    "read_table",
    "rejects",
    "scan_lines",
    "write_table",
]
