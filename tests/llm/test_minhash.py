import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from oracle import connect, difference
from starledger.llm import minhash
from starledger.llm.minhash import near_duplicates
from starledger.llm.queries import op11_minhash, oracle_sql
from tests.llm.test_simhash import groups

SF = "/root/testdata/sf0.001"


def shingles(text, n=3):
    words = (text or "").encode().lower().split()
    if len(words) < n:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def expected(rows, percent=85):
    """All pairs of different sets compared."""
    sets = [shingles(text) for _, text in rows]
    near = lambda a, b: len(a) * 100 >= percent * len(b) and len(b) * 100 >= percent * len(a) and 100 * len(a & b) >= percent * len(a | b)
    root = groups(dict.fromkeys(s for s in sets if s), near)
    least = {}
    for (i, _), s in zip(rows, sets):
        if s and i is not None:
            least[root[s]] = min(i, least.get(root[s], i))
    out = []
    for (i, _), s in zip(rows, sets):
        component = least.get(root[s]) if s else i
        out.append((i, len(s), component, i is not None and i == component))
    return sorted(out, key=str)


def got(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_query_equals_sql(spark):
    assert difference(op11_minhash(spark, SF), connect(SF), oracle_sql()["op11_minhash"]) is None


@pytest.mark.parametrize("folder", [SF, "/root/testdata/sf0.01"])
def test_query_equals_brute_force(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert got(op11_minhash(spark, folder)) == expected([tuple(r) for r in rows])


def test_nulls_empty_long_repeated_clashing(spark):
    long = " ".join(f"w{i}" for i in range(70_000))
    prose = " ".join(f"p{i}" for i in range(60))
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "a b"), (4, "A B"), (5, long), (5, long), (6, "x"), (None, "z"), (None, "z"),
            (7, long + " end"), (8, prose), (9, prose.upper()), (10, prose + " more"), (0, "É a"), (11, "é a"), (None, None)]
    docs = spark.createDataFrame([(*r, 1, "k", "s") for r in rows], "doc_id long, text string, n_shingles int, key string, id string")
    assert got(near_duplicates(docs)) == expected(rows)
    renamed = docs.select(F.col("doc_id").cast("string").alias("name"), F.col("text").alias("body"))
    assert near_duplicates(renamed, "name", "body").columns == ["name", "n_shingles", "component_id", "kept"]
    assert near_duplicates(docs.limit(0)).count() == 0


def edited(draw, words, edits):
    copy = list(words)
    for _ in range(edits):
        copy[draw.randrange(len(copy))] = f"e{draw.randrange(10**6)}"
    return copy


def test_large_groups_of_near_copies_in_blocks(spark):
    draw = random.Random(5)
    rows = []
    for group in range(3):
        base = [f"g{group}w{i}" for i in range(150)]
        for _ in range(150):
            rows.append(edited(draw, base, draw.randrange(10)))
        chain = base
        for _ in range(40):  # each near the one before, the last far from the first
            chain = edited(draw, chain, 3)
            rows.append(chain)
    draw.shuffle(rows)
    rows = [(i, " ".join(words)) for i, words in enumerate(rows)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = expected(rows)
    assert 3 < len({r[2] for r in want}) < 400
    assert got(near_duplicates(docs)) == want
    assert got(near_duplicates(docs, block_rows=16, block_shingles=2000)) == want


def test_signatures_estimate_similarity():
    draw = np.random.Generator(np.random.PCG64(1))
    factors = draw.integers(0, 1 << 64, 192, np.uint64) | np.uint64(1)
    offsets = draw.integers(0, 1 << 64, 192, np.uint64)
    for share in (0.5, 0.85, 0.95):
        estimates = []
        for _ in range(60):
            both = draw.integers(0, 1 << 64, 2000, np.uint64)
            cut = round(2000 * (1 - share) / 2)
            a, b = (minhash._minima(part, factors, offsets) for part in (both[cut:], both[: 2000 - cut]))
            estimates.append((a == b).mean())
        assert abs(np.mean(estimates) - share) < 0.02 and min(estimates) > share - minhash.MARGIN


def test_a_group_is_connected_without_all_its_pairs():
    keys = [bytes([i]) for i in range(200)]
    same = minhash._similar(keys, [b"x" * 192] * 200, 134)
    assert len(list(same)) == 199
    packed = [np.arange(100 + i % 3, dtype=np.uint64).tobytes() for i in range(200)]
    assert len(list(minhash._linked(keys, packed, percent=85))) == 199
