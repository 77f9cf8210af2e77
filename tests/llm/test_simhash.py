import random

import pytest
import xxhash
from pyspark.sql import functions as F

from starledger.llm import components, simhash
from starledger.llm.queries import op2_simhash
from starledger.llm.simhash import near_duplicates

SF = "/root/testdata/sf0.001"


def fingerprint(text, n=4):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(nodes, near):
    root = {n: n for n in nodes}
    nodes = list(nodes)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if near(a, b):
                root[find(a)] = find(b)
    return {n: find(n) for n in nodes}


def expected(rows, max_bits=4):
    prints = [(i, fingerprint(t)) for i, t in rows]
    root = groups({p for _, p in prints}, lambda a, b: (a ^ b).bit_count() <= max_bits)
    least = {}
    for i, p in prints:
        if i is not None:
            least[root[p]] = min(i, least.get(root[p], i))
    return sorted(((i, f"{p:016x}", least.get(root[p])) for i, p in prints), key=str)


def got(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert got(op2_simhash(spark, SF)) == expected(map(tuple, rows))


def test_nulls_empty_long_repeated(spark):
    long = " ".join(f"w{i}" for i in range(70_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "a b"), (4, "A B"), (5, long), (5, long), (6, "x")]
    docs = spark.createDataFrame([(*r, "t") for r in rows], "doc_id long, text string, print string")
    assert got(near_duplicates(docs)) == expected(rows)
    assert got(near_duplicates(docs.limit(0))) == []


@pytest.mark.parametrize("max_bits", [1, 2, 3, 4])
@pytest.mark.parametrize("block_rows", [4, 1 << 15])
def test_links_connect_what_is_near(spark, max_bits, block_rows):
    draw = random.Random(max_bits)
    prints = set()
    for _ in range(20):
        centre = draw.getrandbits(64)
        for _ in range(30):
            prints.add(centre ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 4))))
    signed = {p - (1 << 64) if p >> 63 else p: p for p in prints}
    frame = spark.createDataFrame([(p,) for p in signed], "print long")
    links = [(signed[r.a], signed[r.b]) for r in simhash.links(frame, max_bits, block_rows).collect()]
    assert all((a ^ b).bit_count() <= max_bits for a, b in links)
    linked = {frozenset(x) for x in links}
    want = groups(prints, lambda a, b: (a ^ b).bit_count() <= max_bits)
    have = groups(prints, lambda a, b: frozenset((a, b)) in linked)
    classes = lambda roots: {frozenset(x for x in roots if roots[x] == r) for r in roots.values()}
    assert classes(want) == classes(have)


def test_components(spark):
    draw = random.Random(1)
    pairs = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)]
    pairs += [(1000 + i, 1001 + i) for i in range(60)] + [(None, 3), (7, 7)]
    frame = spark.createDataFrame(pairs, "a long, b long")
    roots = dict(map(tuple, components.components(frame).collect()))
    linked = {frozenset(p) for p in pairs if None not in p and len(set(p)) == 2}
    nodes = {x for pair in linked for x in pair}
    want = groups(nodes, lambda a, b: frozenset((a, b)) in linked)
    least = {r: min(x for x in want if want[x] == r) for r in want.values()}
    assert roots == {x: least[r] for x, r in want.items()}
    assert components.components(frame.limit(0)).count() == 0


def test_rows_keep_columns_of_any_name(spark):
    names = ["print", "root", "component_id", "bytes", "_print", "_root", "node", "row"]
    docs = spark.createDataFrame([(1, "a b c d e", *names), (2, "A b c d e", *names)],
                                 f"doc_id long, text string, {', '.join(f'{n} string' for n in names)}")
    kept = simhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [(1, "a b c d e", *names)]
