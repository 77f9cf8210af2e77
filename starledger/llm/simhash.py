"""Near-duplicates by SimHash, found through deletion-variant signatures.

Fingerprints that differ in at most ``max_bits`` bits are cut into ``max_bits // 2 + 1``
segments, of which one then differs in one bit at most. Of each segment every variant with one
bit blanked out is indexed; two fingerprints whose segment differs in one bit or none share
a variant. An equality grouping on the variants brings candidates together, and counting the
differing bits of the whole fingerprints verifies them.

Texts with equal fingerprints are one entry of the index, so exact copies cost nothing.
A bucket of more than ``block_rows`` fingerprints is cut into blocks whose pairs are separate
groups, and inside a group only links that connect it are put out: neither memory nor output
grows with the square of a group of near copies.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from starledger.llm.common import as_bytes, stored, unused
from starledger.llm.components import components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BITS = 64
_SEED = 42
_PIECE = 1 << 16
_ALL_PAIRS = 8


def near_duplicates(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    shingle_words: int = 4,
    max_bits: int = 4,
    block_rows: int = 1 << 15,
) -> DataFrame:
    """``id``, ``fingerprint`` (16 hexadecimal digits) and ``component_id`` of every row.

    The component is the smallest id among all rows that links lead to. A text of fewer than
    ``shingle_words`` words is one shingle; a text without words, empty or null, has the
    fingerprint zero, which is linked like any other. Rows with a null id keep their row, and
    their id is no component unless all ids of the component are null. Repeated rows stay
    repeated. Other columns are not read; an empty table gives no rows.
    """
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    prints = stored(_with_prints(rows, "text", shingle_words).drop("text"), "fingerprints")
    classes = _classes(prints, max_bits, block_rows)
    return prints.join(classes, "print").select(
        F.col("id").alias(id),
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def without_near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle_words: int = 4, max_bits: int = 4,
    block_rows: int = 1 << 15,
) -> DataFrame:
    """One row of each component, all its columns: that whose id is the component's.

    If several rows have this id, or all ids are null, the least row stays, by its columns in
    their order. See ``near_duplicates``.
    """
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    prints = stored(_with_prints(rows, "text", shingle_words).drop("text"), "fingerprints")
    own, root, component = unused(docs, "print"), unused(docs, "root"), unused(docs, "component_id")
    classes = _classes(prints, max_bits, block_rows).withColumnsRenamed(
        {"print": own, "root": root, "component_id": component}
    )
    named = _with_prints(docs, text, shingle_words, own)
    first = named.join(classes, own).where(F.col(id).eqNullSafe(F.col(component)))
    # Repeated rows combine before the shuffle.
    least = F.min(F.struct(*(F.col(f"`{name}`") for name in docs.columns))).alias("row")
    return first.groupBy(root).agg(least).select("row.*")


def _classes(prints: DataFrame, max_bits: int, block_rows: int) -> DataFrame:
    """``print``, ``root`` (a print of the component) and ``component_id`` of rows of id and print."""
    distinct = stored(prints.groupBy("print").agg(F.min("id").alias("first")), "prints")
    linked = components(links(distinct.select("print"), max_bits, block_rows))
    rooted = distinct.join(linked, distinct["print"] == linked["node"], "left").select(
        "print", "first", F.coalesce("root", "print").alias("root")
    )
    rooted = stored(rooted, "roots")
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.join(least, "root").select("print", "root", "component_id")


def _with_prints(docs: DataFrame, text: str, shingle_words: int, name: str = "print") -> DataFrame:
    """The rows with the 64 bits of their text as a long."""
    rows = docs.select(*(F.col(f"`{c}`") for c in docs.columns), as_bytes(text).alias(unused(docs, "bytes")))
    names = [*docs.columns, name]
    fields = [*docs.schema.fields, StructField(name, LongType())]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            texts = rows.columns[-1]
            prints = [_fingerprint(text.as_py() or b"", shingle_words) for text in texts]
            prints = pa.array(np.array(prints, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*rows.columns[:-1], prints], names)

    return rows.mapInArrow(work, StructType(fields))


# Entry (v, b): bit b of byte v.
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
_BYTE_BITS = _BYTE_BITS.astype(np.int64)


def _fingerprint(text: bytes, shingle_words: int) -> int:
    from xxhash import xxh64_intdigest

    words = text.lower().split()  # of bytes: A-Z only, and the six ASCII white-space characters
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    first = np.concatenate(([0], ends[:-1] + 1))
    last = ends[min(shingle_words, len(words)) - 1 :]
    totals, shingles = np.zeros(BITS, np.int64), len(last)
    for at in range(0, shingles, _PIECE):
        bounds = zip(first[at : at + _PIECE].tolist(), last[at : at + _PIECE].tolist())
        hashes = np.array([xxh64_intdigest(joined[a:b], _SEED) for a, b in bounds], np.uint64)
        places = hashes.view(np.uint8).reshape(-1, 8) + 256 * np.arange(8)
        seen = np.bincount(places.ravel(), minlength=2048).reshape(8, 256)
        totals += (seen @ _BYTE_BITS).ravel()
    return int(np.packbits(2 * totals > shingles, bitorder="little").view(np.uint64)[0])


def segments(max_bits: int) -> list[tuple[int, int]]:
    """First bit and width of each segment; two at least, so that none is wider than 32."""
    bounds = np.linspace(0, BITS, max(2, max_bits // 2 + 1) + 1).astype(int).tolist()
    return [(a, b - a) for a, b in zip(bounds, bounds[1:])]


def links(prints: DataFrame, max_bits: int = 4, block_rows: int = 1 << 15) -> DataFrame:
    """Links ``a``, ``b`` that connect the distinct fingerprints in column ``print``.

    All of them differ in ``max_bits`` bits or less, and whichever two fingerprints do so are
    connected by them, directly or through others.
    """
    cuts = segments(max_bits)
    keys = prints.select("print").mapInArrow(
        lambda batches: _variants(batches, cuts), "bucket long, pair long, print long"
    )
    blocks = _hot_buckets(prints, cuts, block_rows)
    if not blocks.isEmpty():
        # Block i meets every other block j in group (i, j), i < j, which holds both.
        blocks = stored(blocks, "hot-buckets")
        block = F.pmod(F.xxhash64("print"), F.col("blocks")).alias("block")
        hot = keys.join(blocks, "bucket").select("bucket", "print", "blocks", block)
        hot = hot.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        pair = F.least("block", "other") * F.col("blocks") + F.greatest("block", "other")
        hot = hot.where("block != other").select("bucket", pair.alias("pair"), "print")
        keys = keys.join(blocks, "bucket", "left_anti").union(hot)
    grouped = keys.repartition("bucket", "pair").sortWithinPartitions("bucket", "pair")
    found = grouped.mapInArrow(lambda batches: _links(batches, max_bits), "a long, b long")
    return found.distinct()


def _variants(batches: Iterator[pa.RecordBatch], cuts: list[tuple[int, int]]):
    """Each fingerprint under the number of each of its variants: blanked bit, segment."""
    for rows in batches:
        prints = rows.column(0).to_numpy()
        bits, pair = prints.view(np.uint64), pa.array(np.zeros(len(prints), np.int64))
        for at, width in cuts:
            value = (bits >> np.uint64(at)) & np.uint64((1 << width) - 1)
            for blank in range(width):
                bucket = (value & ~np.uint64(1 << blank)) | np.uint64(at + blank << 32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket.view(np.int64)), pair, pa.array(prints)],
                    ["bucket", "pair", "print"],
                )


def _hot_buckets(prints: DataFrame, cuts: list[tuple[int, int]], block_rows: int) -> DataFrame:
    """``bucket`` and ``blocks``, two or more, of buckets that may exceed ``block_rows``.

    A bucket without bit p holds two values of its segment. So only values with half a block
    of fingerprints matter; counting values combines before the shuffle.
    """
    found = None
    for at, width in cuts:
        value = F.shiftrightunsigned("print", at).bitwiseAND(F.lit((1 << width) - 1))
        values = prints.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("n"))
        buckets = F.array(
            *(
                F.col("value").bitwiseAND(F.lit(~(1 << p))) + F.lit(at + p << 32)
                for p in range(width)
            )
        )
        hot = values.where(F.col("n") > block_rows // 2).select(
            F.explode(buckets).alias("bucket"), "n"
        )
        found = hot if found is None else found.union(hot)
    rows = F.sum("n") + block_rows // 2  # the other value, if it is not hot itself
    blocks = F.ceil(rows / block_rows).cast("long")
    return found.groupBy("bucket").agg(blocks.alias("blocks")).where("blocks > 1")


def _links(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Links inside each run of rows with equal bucket and pair."""
    held = None
    for rows in batches:
        columns = [column.to_numpy() for column in rows.columns]
        if held is not None:
            columns = [np.concatenate(pair) for pair in zip(held, columns)]
        same = (columns[0] == columns[0][-1]) & (columns[1] == columns[1][-1])
        cut = len(same) - int(same.sum())  # the last run may go on in the next batch
        held = [column[cut:] for column in columns]
        yield from _run_links([column[:cut] for column in columns], max_bits)
    if held is not None:
        yield from _run_links(held, max_bits)


def _run_links(columns: list, max_bits: int) -> Iterator[pa.RecordBatch]:
    bucket, pair, prints = columns
    if len(prints) < 2:
        return
    bits = prints.view(np.uint64)
    changes = (bucket[1:] != bucket[:-1]) | (pair[1:] != pair[:-1])
    starts = np.concatenate(([0], np.flatnonzero(changes) + 1))
    sizes = np.diff(np.append(starts, len(bits)))
    a, b = [], []
    for step in range(1, _ALL_PAIRS):  # runs of a few rows, all at once
        some = (sizes > step) & (sizes <= _ALL_PAIRS)
        if not some.any():
            break
        for shift in range(_ALL_PAIRS - step):
            i = starts[some & (sizes > step + shift)] + shift
            near = np.bitwise_count(bits[i] ^ bits[i + step]) <= max_bits
            a.append(bits[i[near]])
            b.append(bits[i[near] + step])
    for run in np.flatnonzero(sizes > _ALL_PAIRS):
        for x, found in _spanning(bits[starts[run] : starts[run] + sizes[run]], max_bits):
            a.append(np.full(len(found), x))
            b.append(found)
    if a:
        ends = [pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)]
        yield pa.RecordBatch.from_arrays(ends, ["a", "b"])


def _spanning(rest, max_bits: int):
    """Each value once, with the value that first reaches it."""
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            near = np.bitwise_count(rest ^ x) <= max_bits
            if near.any():
                found, rest = rest[near], rest[~near]
                queue.extend(found)
                yield x, found
