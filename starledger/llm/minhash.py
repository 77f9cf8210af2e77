"""Near-duplicates by MinHash: bands find candidates, whole sets of shingles confirm links.

Each different set of shingles gets the minima of many universal hash functions. Sets that share
all minima of a band are candidates; those whose signatures agree too little are dropped, and
connected components of the rest bring the sets that have to be compared together, so a set of
shingles is shuffled once, and hardly any without a candidate. There links are confirmed on
the whole sets, and components of the links, by alternating stars, are the result.

Texts with equal sets are one entry, so exact copies cost nothing further. Neither candidates
nor links of a group are all put out: a task keeps those that connect the group. A bucket of too
many signatures is cut into blocks whose pairs are groups of their own. A component with too
many shingles for a task is cut into blocks that are first linked within themselves, with some
sets that all blocks share; then only the sets outside of the largest part so far have to meet
all others.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from starledger.llm.common import as_bytes, stored
from starledger.llm.components import components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Sets of the least similarity for a link miss each other in all bands once in millions
#: (0.85: 3e-7), and those of less than a third rarely meet.
BANDS, BAND_ROWS = 32, 6
#: A signature of two linked sets has so much less agreement than their similarity once in tens
#: of millions at most: 5.7 standard deviations of 192 minima at 0.85.
MARGIN = 0.15
#: Signatures, and shingles, that a task compares with each other.
BLOCK_ROWS, BLOCK_SHINGLES = 1 << 15, 1 << 21

_SEED = 42
_PIECE = 2048
_MEMO = 1 << 19
#: Bits that tell which sets have candidates: 8 MB.
_FILTER_BITS = 1 << 26
#: One of so many sets of a component in blocks goes to each block.
_SHARED = 64


def near_duplicates(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    shingle_words: int = 3,
    percent: int = 85,
    bands: int = BANDS,
    band_rows: int = BAND_ROWS,
    block_rows: int = BLOCK_ROWS,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """``id``, ``n_shingles``, ``component_id`` and ``kept`` of every row.

    Rows are linked if their sets of different shingles, of words in lower case (A-Z), have
    ``percent`` of their union in common; the bands suit 80 and more, lower ones need more bands. Fewer than ``shingle_words`` words are one shingle; a
    text without words, empty or null, is linked with nothing. Shingles count as equal if
    64 bits of hash are, sets if 128 are. The component is the smallest id that links lead to;
    ``kept`` says that it is the row's own. Repeated rows are repeated, and all kept if their id
    is the component's; a null id is no component unless all ids in it are null, and never kept.
    Other columns are not read; an empty table gives no rows.
    """
    rows = docs.select(F.col(id).alias("id"), as_bytes(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_shingles long, key binary, signature binary, buckets array<long>"
    sets = rows.mapInArrow(lambda batches: _sets(batches, shingle_words, bands, band_rows), schema)
    sets = stored(sets, "minhash-sets")
    one = sets.where("key is not null").groupBy("key").agg(
        F.min("id").alias("first"),
        *(F.first(name).alias(name) for name in ("n_shingles", "signature", "buckets")),
    )
    one = stored(one, "minhash-signatures")
    agreement = int((percent / 100 - MARGIN) * bands * band_rows)
    near = components(candidates(one, agreement, block_rows))
    near = stored(near.withColumnsRenamed({"node": "key", "root": "near"}), "minhash-candidates")
    bodies = _bodies(rows, near, shingle_words)
    linked = components(_confirmed(bodies, one, near, percent, block_shingles))
    rooted = one.join(linked, one["key"] == linked["node"], "left").select(
        "key", "first", F.coalesce("root", "key").alias("root")
    )
    rooted = stored(rooted, "minhash-roots")
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = rooted.join(least, "root").select("key", "component_id")
    found = sets.select("id", "n_shingles", "key").join(classes, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return found.select(F.col("id").alias(id), "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col(id) == F.col("component_id"), F.lit(False))
    )


class _Hashes(dict):
    """64-bit hash of each word, remembered; forgets all when it has grown too large."""

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        if len(self) >= _MEMO:
            self.clear()
        value = self[word] = xxh64_intdigest(word, _SEED)
        return value


def _sets(batches: Iterator[pa.RecordBatch], shingle_words: int, bands: int, band_rows: int) -> Iterator[pa.RecordBatch]:
    draw = np.random.Generator(np.random.PCG64(_SEED))
    odd = lambda n: draw.integers(0, 1 << 64, n, np.uint64) | np.uint64(1)
    factors, band_factors = odd(bands * band_rows), odd(band_rows)
    offsets = draw.integers(0, 1 << 64, bands * band_rows, np.uint64)
    band_names = draw.integers(0, 1 << 64, bands, np.uint64)
    for ids, found in _pieces(batches, shingle_words):
        signatures, buckets = [], []
        for one in found:
            if not len(one):
                signatures.append(None)
                buckets.append(None)
                continue
            least = _minima(one, factors, offsets)
            signatures.append(least.astype(np.uint8).tobytes())
            banded = least.reshape(bands, band_rows)
            buckets.append((_mixed((banded * band_factors).sum(axis=1)) + band_names).view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(map(len, found), pa.int64()), pa.array(map(_key, found), pa.binary()),
             pa.array(signatures, pa.binary()), pa.array(buckets, pa.list_(pa.int64()))],
            ["id", "n_shingles", "key", "signature", "buckets"],
        )


def _pieces(batches: Iterator[pa.RecordBatch], shingle_words: int) -> Iterator[tuple[pa.Array, list]]:
    """Ids and sets of shingles of a few rows at a time."""
    memo = _Hashes()
    for rows in batches:
        for at in range(0, rows.num_rows, 256):
            piece = rows.slice(at, 256)
            texts = ((text.as_py() or b"").lower().split() for text in piece.column(1))
            yield piece.column(0), [_shingles(words, shingle_words, memo) for words in texts]


def _key(shingles: np.ndarray) -> bytes | None:
    from xxhash import xxh3_128_digest

    return xxh3_128_digest(shingles.tobytes()) if len(shingles) else None


def _bodies(rows: DataFrame, near: DataFrame, shingle_words: int) -> DataFrame:
    """``key`` and ``shingles`` of all rows whose key may be in ``near``, and of few others.

    Sets are made of the texts once more, as that is less than storing them. Which keys there
    are is told to the tasks by a table of bits, whose size does not grow; where it is full, all
    sets go into the join that follows.
    """
    number = F.conv(F.hex(F.substring("key", 1, 4)), 16, 10).cast("long") % _FILTER_BITS
    bit = F.expr("shiftleft(1L, cast(number % 64 as int))")
    words = near.select(number.alias("number")).groupBy(F.floor(F.col("number") / 64).alias("word"))
    table = words.agg(F.bit_or(bit).alias("bits")).toArrow()
    bits = np.zeros(_FILTER_BITS // 64, np.int64)
    bits[table.column("word").to_numpy()] = table.column("bits").to_numpy()
    shared = rows.sparkSession.sparkContext.broadcast(bits.view(np.uint8))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for _, found in _pieces(batches, shingle_words):
            keys, shingles = [], []
            for one in found:
                key = _key(one)
                if key is not None:
                    number = int.from_bytes(key[:4], "big") % _FILTER_BITS
                    if known[number >> 3] >> (number & 7) & 1:
                        keys.append(key)
                        shingles.append(one.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(shingles, pa.binary())], ["key", "shingles"])

    return rows.mapInArrow(work, "key binary, shingles binary")


def _shingles(words: list[bytes], n: int, memo: _Hashes) -> np.ndarray:
    """The different shingles as sorted hashes."""
    if len(words) < n:
        words = [b" ".join(words)] if words else []
        n = 1
    hashes = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    count = max(0, len(words) - n + 1)
    total = np.zeros(count, np.uint64)
    for k in range(n):
        total = _mixed(total + hashes[k : k + count])
    return np.unique(total)


def _mixed(values: np.ndarray) -> np.ndarray:
    return (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)


def _minima(shingles: np.ndarray, factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Of each hash function, multiplication, addition and shift, the least of 32 bits."""
    least = np.full(len(factors), np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(shingles), _PIECE):
        keys = shingles[at : at + _PIECE] >> np.uint64(32)
        values = np.multiply.outer(factors, keys)
        values += offsets[:, None]
        np.minimum(least, values.min(axis=1), out=least)
    return least >> np.uint64(32)


def candidates(signatures: DataFrame, agreement: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Pairs ``a``, ``b`` that connect the keys whose signatures share a bucket and so many minima.

    ``signatures`` has ``key``, ``signature`` and ``buckets``, each key once.
    """
    entries = signatures.select("key", F.explode("buckets").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # Stored, so that its size is known when the join is planned.
    shared = stored(shared, "minhash-buckets")
    # Signatures join the entries that are left: most buckets have one.
    members = entries.join(shared, "bucket")
    # Block i of a large bucket meets every other block j in group (i, j), i < j, which holds both.
    blocks = F.ceil(F.col("n") / block_rows).cast("long")
    block = F.pmod(F.xxhash64("key"), blocks)
    other = F.explode(F.when(blocks == 1, F.array(F.lit(0).cast("long"))).otherwise(
        F.filter(F.sequence(F.lit(0).cast("long"), blocks - 1), lambda o: o != block)
    ))
    members = members.select("bucket", "key", blocks.alias("blocks"), block.alias("block"), other.alias("other"))
    pair = F.least("block", "other") * F.col("blocks") + F.greatest("block", "other")
    members = members.select("bucket", pair.alias("pair"), "key").join(signatures.select("key", "signature"), "key")
    members = members.select("bucket", "pair", "key", "signature")
    grouped = members.repartition("bucket", "pair").sortWithinPartitions("bucket", "pair")
    similar = lambda run: _similar(run[0], run[1], agreement)
    found = grouped.mapInArrow(lambda batches: _by_run(batches, 2, similar), "a binary, b binary")
    return found.distinct()


def _confirmed(bodies: DataFrame, one: DataFrame, near: DataFrame, percent: int, block_shingles: int) -> DataFrame:
    """Links ``a``, ``b`` confirmed on whole sets that connect all sets that links connect.

    ``bodies`` has the ``shingles`` of each ``key``, copies included; ``near`` has the ``key`` of
    each set with a candidate, and the component of candidates.
    """
    sized = near.join(one.select("key", "n_shingles"), "key")
    blocks = F.ceil(F.sum("n_shingles") / block_shingles).cast("long")
    blocks = stored(sized.groupBy("near").agg(blocks.alias("blocks")), "minhash-blocks")
    placed = near.join(blocks, "near").withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")))
    bodies = bodies.join(placed, "key")
    # Copies combine before the shuffle. Hot components are split by block.
    bodies = bodies.groupBy("near", "blocks", "block", "key").agg(F.first("shingles").alias("shingles"))
    large = placed.where("blocks > 1")
    if large.isEmpty():
        return _links(bodies.select("near", F.lit(0).cast("long").alias("group"), "key", "shingles"), percent)
    bodies = stored(bodies, "minhash-compared")
    shared = F.pmod(F.xxhash64("key", F.lit(1)), F.lit(_SHARED)) == 0
    every = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    groups = F.explode(F.when(shared, every).otherwise(F.array("block")))
    first = stored(_links(bodies.select("near", groups.alias("group"), "key", "shingles"), percent), "minhash-links")
    # The largest part of each large component, and the sets outside of it.
    parts = components(first).withColumnsRenamed({"node": "key", "root": "part"})
    parts = large.join(parts, "key", "left").withColumn("part", F.coalesce("part", "key"))
    parts = stored(parts, "minhash-parts")
    biggest = parts.groupBy("near", "part").agg(F.count(F.lit(1)).alias("n"))
    biggest = biggest.groupBy("near").agg(F.max_by("part", F.struct("n", "part")).alias("biggest"))
    outside = parts.join(biggest, "near").where("part != biggest").join(one.select("key", "n_shingles"), "key")
    cuts = F.ceil(F.sum("n_shingles") / block_shingles).cast("long")
    cuts = stored(outside.groupBy("near").agg(cuts.alias("cuts")), "minhash-cuts")
    cut = F.pmod(F.xxhash64("key", F.lit(2)), F.col("cuts"))
    whole = bodies.join(parts.select("key", "part"), "key").join(cuts, "near")
    left = whole.join(outside.select("key"), "key", "left_semi")
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    group = F.col("block") * F.col("cuts") + F.col("cut")
    columns = ["near", group.alias("group"), "key", "shingles", "part", "outside"]
    whole = whole.select("*", upto(F.col("cuts")).alias("cut"), F.lit(False).alias("outside")).select(columns)
    left = left.withColumn("cut", cut).drop("block").select("*", upto(F.col("blocks")).alias("block"), F.lit(True).alias("outside"))
    return first.union(_links(whole.union(left.select(columns)), percent))


def _links(groups: DataFrame, percent: int) -> DataFrame:
    """Links that connect what is linked within each ``near`` and ``group``.

    With ``part`` and ``outside``, links of the sets outside with those of other parts.
    """
    grouped = groups.repartition("near", "group").sortWithinPartitions("near", "group")
    confirm = lambda run: _linked(*run, percent=percent)
    found = grouped.mapInArrow(lambda batches: _by_run(batches, 2, confirm), "a binary, b binary")
    return found.distinct()


def _by_run(batches: Iterator[pa.RecordBatch], keys: int, find: Callable) -> Iterator[pa.RecordBatch]:
    """Pairs that ``find`` makes of the columns after the first ``keys`` ones, for each run of equal keys."""
    held: list = []
    current = None
    for rows in batches:
        names = list(zip(*(column.to_pylist() for column in rows.columns[:keys])))
        cuts = [i for i in range(1, len(names)) if names[i] != names[i - 1]]
        pairs: tuple = ([], [])
        for begin, end in zip([0, *cuts], [*cuts, len(names)]):
            if begin == end:
                continue
            if current is not None and names[begin] != current:
                _extend(pairs, find, held)
                held = []
            current = names[begin]
            held.append([column.slice(begin, end - begin) for column in rows.columns[keys:]])
        if pairs[0]:
            yield _pairs(pairs)
    if held:
        pairs = ([], [])
        _extend(pairs, find, held)
        if pairs[0]:
            yield _pairs(pairs)


def _extend(pairs: tuple, find: Callable, held: list) -> None:
    if sum(len(columns[0]) for columns in held) > 1:
        for a, b in find([[value for part in column for value in part.to_pylist()] for column in zip(*held)]):
            pairs[0].append(a)
            pairs[1].append(b)


def _pairs(pairs: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(side, pa.binary()) for side in pairs], ["a", "b"])


def _similar(keys: list[bytes], signatures: list[bytes], agreement: int) -> Iterator[tuple]:
    """Each key once, with the one that first reaches it by so many equal minima."""
    table = np.frombuffer(b"".join(signatures), np.uint8).reshape(len(keys), -1)
    rest = np.arange(len(keys))
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            near = (table[rest] == table[x]).sum(axis=1) >= agreement
            for y in rest[near].tolist():
                yield keys[x], keys[y]
                queue.append(y)
            rest = rest[~near]


def _linked(
    keys: list[bytes], shingles: list[bytes], parts: list[bytes] | None = None, outside: list[bool] | None = None, *, percent: int
) -> Iterator[tuple]:
    """Confirmed links: of all keys, or of those outside with the keys of other parts."""
    sizes = np.array([len(packed) // 8 for packed in shingles])
    flat = np.unique(np.frombuffer(b"".join(shingles), np.uint64), return_inverse=True)[1]
    ends = np.cumsum(sizes)
    bodies = _Bodies(flat.astype(np.int32), ends - sizes, sizes, percent)
    if parts is not None:
        yield from _links_outside(keys, parts, outside, bodies)
        return
    rest = np.arange(len(keys))
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            linked = bodies.linked(x, rest)
            for y in rest[linked].tolist():
                yield keys[x], keys[y]
                queue.append(y)
            rest = rest[~linked]


def _links_outside(keys: list[bytes], parts: list[bytes], outside: list[bool], bodies: _Bodies) -> Iterator[tuple]:
    root = {part: part for part in parts}

    def find(part):
        while root[part] != part:
            root[part] = part = root[root[part]]
        return part

    inside = np.flatnonzero(~np.array(outside))
    for x in np.flatnonzero(outside).tolist():
        for y in inside[bodies.linked(x, inside)].tolist():
            a, b = find(parts[x]), find(parts[y])
            if a != b:
                root[a] = b
                yield keys[x], keys[y]


class _Bodies:
    """Sets as numbers of their shingles, one after the other."""

    def __init__(self, flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, percent: int):
        self.flat, self.starts, self.sizes, self.percent = flat, starts, sizes, percent
        self.mark = np.zeros(int(flat.max()) + 1 if len(flat) else 0, np.int32)
        self.gathered, self.members = flat, np.arange(len(sizes))
        self.at = starts

    def linked(self, x: int, others: np.ndarray) -> np.ndarray:
        """Whether each of the others (ascending) has enough in common with ``x``."""
        if 2 * len(others) < len(self.members):  # fewer are left: gather those only
            self.gathered = np.concatenate([self.flat[self.starts[o] : self.starts[o] + self.sizes[o]] for o in others])
            self.members = others
            self.at = np.cumsum(self.sizes[others]) - self.sizes[others]
        own = self.flat[self.starts[x] : self.starts[x] + self.sizes[x]]
        self.mark[own] = 1
        common = np.add.reduceat(self.mark[self.gathered], self.at)
        self.mark[own] = 0
        common = common[np.searchsorted(self.members, others)]
        return 100 * common >= self.percent * (self.sizes[x] + self.sizes[others] - common)
