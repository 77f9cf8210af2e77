"""Benchmark decontamination: rare word triples as seeds, local alignment as the judge.

Seeds are triples of words in their order, next to each other or with one word between, of test
items and of documents alike. So a copy has a seed in common with its item wherever three words
are left with one edit between them, be it a word replaced, added or left out. The documents
count how common each seed is, and only those that are rare for their item are joined: a phrase
that everybody uses says nothing, while in a passage that many documents share no seed is more
common than the others. Documents and items that meet are aligned by Smith-Waterman, in the
passages where a bound on the score allows a copy.

Documents are scanned once for seeds and once for the texts that met an item, whatever the number
of items; copies of a text are searched and aligned once. All that grows is joined by Spark; what
is sent to all tasks are tables of bits that say which seeds there are, and which texts met an
item, of a fixed size.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from starledger.llm.common import TABLE_BITS, as_bytes, bit_table, digest_number, stored, unused

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEED_WORDS = 3
#: A seed of an item is rare if it is in no more documents than this, or than so many times the
#: median of the item's seeds that are in any document.
RARE_SHARE, RARE_AT_LEAST, RARE_TIMES = 1e-4, 10, 4
#: Alignment scores of a word: equal, replaced, added or left out.
MATCH, OTHER, GAP = 2, -1, -1
#: A passage is a copy if it scores like this share of the item, or like so many words in a
#: row, whichever is less.
SHARE, RUN_WORDS = 0.6, 13

_CHUNK = 4 << 20
_MEMO = 1 << 19
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
#: Places of a seed's words, from its first one.
_SHAPES = ((0, 1, 2), (0, 1, 3), (0, 2, 3))


def contaminated(
    docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``id``, ``item_id``, ``score``, ``start`` and ``end`` of each copy of an item in a row.

    ``score`` is the alignment's as a share of the item's best, ``start`` and ``end`` count the
    row's words (letters, marks and numbers of any script between anything else, compared in
    lower case). Of several copies in a row the best is returned, the first if equal. Each of
    repeated rows has its copies; null ids are returned as such. Null or empty texts and items, and items
    of less than ``SEED_WORDS`` words, have no copies; nor has a row an item's with which it
    shares no rare seed. Equal items are all returned. Other columns are not read.
    """
    rows = docs.select(F.col(id).alias("id"), _key(text).alias("key"), as_bytes(text).alias("text"))
    numbered, found = _found(rows, items.select(F.col(item_id).alias("item_id"), as_bytes(item_text).alias("body")))
    named = found.join(numbered.select("number", "item_id"), "number")
    ids = rows.select("id", "key").join(named, "key")
    return ids.select(F.col("id").alias(id), F.col("item_id").alias(item_id), "score", "start", "end")


def without_copies(docs: DataFrame, items: DataFrame, text: str = "text", item_text: str = "text") -> DataFrame:
    """The rows, all their columns, that hold no copy of an item; see ``contaminated``."""
    rows = docs.select(_key(text).alias("key"), as_bytes(text).alias("text"))
    _, found = _found(rows, items.select(F.lit(0).alias("item_id"), as_bytes(item_text).alias("body")))
    key = unused(docs, "key")
    # Stored, so that Spark knows whether the keys are few enough to be sent to all tasks.
    keys = stored(found.select(F.col("key").alias(key)).distinct(), "contaminated")
    return docs.withColumn(key, _key(text)).join(keys, key, "left_anti").select([f"`{name}`" for name in docs.columns])


def _key(text: str):
    return F.unhex(F.md5(as_bytes(text)))


def _found(rows: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Items with a ``number``; ``key``, ``number``, ``score``, ``start``, ``end`` of copies."""
    numbered = stored(items.withColumn("number", F.monotonically_increasing_id()), "benchmark")
    asked = numbered.select("number", "body").mapInArrow(_item_seeds, "number long, seed long")
    asked = stored(asked, "benchmark-seeds")
    spread = rows.sparkSession.sparkContext.broadcast
    shared = spread(bit_table(F.shiftrightunsigned("seed", 64 - TABLE_BITS), asked))
    hits = rows.select("key", "text").mapInArrow(
        lambda batches: _known_seeds(batches, shared.value), "key binary, seeds array<long>"
    )
    hits = stored(hits, "benchmark-hits")
    rare = stored(rare_seeds(hits, asked), "benchmark-rare")
    one = hits.groupBy("key").agg(F.first("seeds").alias("seeds"))  # copies have the same
    pairs = one.select("key", F.explode("seeds").alias("seed")).join(rare, "seed").select("key", "number").distinct()
    pairs = stored(pairs, "benchmark-pairs")
    met = spread(bit_table(digest_number("key"), pairs))
    texts = rows.select("key", "text").mapInArrow(lambda batches: _met(batches, met.value), "key binary, text binary")
    texts = texts.groupBy("key").agg(F.first("text").alias("body"))
    # A text, then the items to align it with, one by one.
    together = texts.select("key", F.lit(-1).cast("long").alias("number"), "body").union(
        pairs.join(numbered, "number").select("key", "number", "body")
    )
    ordered = together.repartition("key").sortWithinPartitions("key", "number")
    found = ordered.mapInArrow(_aligned, "key binary, number long, score double, start long, end long")
    return numbered, stored(found, "benchmark-copies")


def rare_seeds(hits: DataFrame, asked: DataFrame) -> DataFrame:
    """``seed`` and ``number`` of the items' seeds that are rare enough to be searched for.

    ``hits`` has the ``seeds`` of each document, ``asked`` the ``seed`` and ``number`` of items.
    """
    found = hits.select(F.explode("seeds").alias("seed")).groupBy("seed").agg(F.count(F.lit(1)).alias("n"))
    known = asked.join(found, "seed")
    known = known.withColumn("median", F.percentile("n", 0.5).over(Window.partitionBy("number")))
    few = max(RARE_SHARE * hits.count(), RARE_AT_LEAST)
    return known.where((F.col("n") <= few) | (F.col("n") <= RARE_TIMES * F.col("median"))).select("seed", "number")


def _item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memo = _Hashes()
    for rows in batches:
        for number, body in zip(rows.column(0), rows.column(1)):
            seeds = np.unique(_seeds(_hashed([body.as_py() or b""], memo)[0])).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(seeds), number.as_py(), np.int64)), pa.array(seeds)], ["number", "seed"]
            )


def _known_seeds(batches: Iterator[pa.RecordBatch], bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Key and different seeds, those of ``bits`` and few others, of each text."""
    memo = _Hashes()
    shift, byte, bit = np.uint64(64 - TABLE_BITS), np.uint64(3), np.uint64(7)
    for rows in batches:
        at = 0
        for chunk in _chunks(rows.column(1)):
            found = []
            for words in _hashed(chunk, memo):
                seeds = _seeds(words)
                place = seeds >> shift
                known = bits[place >> byte] >> (place & bit).astype(np.uint8) & 1
                found.append(np.unique(seeds[known.astype(bool)]).view(np.int64))
            keys = rows.column(0).slice(at, len(chunk))
            at += len(chunk)
            yield pa.RecordBatch.from_arrays([keys, pa.array(found, pa.list_(pa.int64()))], ["key", "seeds"])


def _met(batches: Iterator[pa.RecordBatch], bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The texts whose keys are in ``bits``."""
    for rows in batches:
        heads = [int.from_bytes(key[:4], "big") >> 32 - TABLE_BITS if key else -1 for key in rows.column(0).to_pylist()]
        yield rows.filter(pa.array([head >= 0 and bool(bits[head >> 3] >> (head & 7) & 1) for head in heads], pa.bool_()))


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memo, items = _Hashes(), {}
    seen: dict = {}  # passages that many texts share are aligned once
    current, words = None, None
    for rows in batches:
        copies = []
        for key, number, body in zip(*(column.to_pylist() for column in rows.columns)):
            if number < 0:
                current, words = key, _hashed([body or b""], memo)[0]
            elif key == current:
                if number not in items:
                    if len(items) >= _MEMO // 16:
                        items.clear()
                    item = _hashed([body or b""], memo)[0]
                    items[number] = item, np.unique(item)
                best = _best_copy(number, *items[number], words, seen)
                if best is not None:
                    copies.append((key, number, *best))
        if copies:
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(
                    zip(*copies), (pa.binary(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
                )],
                ["key", "number", "score", "start", "end"],
            )


def _best_copy(number: int, item: np.ndarray, known: np.ndarray, words: np.ndarray, seen: dict) -> tuple | None:
    """Score, start and end of the best copy of the item, the first if equal."""
    best = None
    for begin, end in _passages(known, words, _needed(item)):
        passage = words[begin:end]
        name = (number, passage.tobytes())
        if name not in seen:
            if len(seen) >= _MEMO // 16:
                seen.clear()
            seen[name] = _judged(item, passage)
        if seen[name] is not None:
            score, a, b = seen[name]
            if best is None or score > best[0]:
                best = (score, begin + a, begin + b)
    return best


class _Hashes(dict):
    """64-bit hash of each word, remembered; forgets all when it has grown too large."""

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        if len(self) >= _MEMO:
            self.clear()
        value = self[word] = xxh64_intdigest(word)
        return value


#: ASCII characters but letters and digits part words.
_PARTS = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def _other_parts(text: str) -> list[str]:
    """The other characters of the text that part words: all but letters, marks and numbers."""
    return [c for c in set(text) if c > "\x7f" and unicodedata.category(c)[0] not in "LMN"]


def _hashed(texts: list[bytes], memo: _Hashes) -> list[np.ndarray]:
    out = []
    for text in texts:
        text = text.decode("utf-8", "replace").lower()
        if not text.isascii():
            for part in _other_parts(text):
                text = text.replace(part, " ")
        words = text.encode().translate(_PARTS).split()
        out.append(np.fromiter(map(memo.__getitem__, words), np.uint64, len(words)))
    return out


def _seeds(words: np.ndarray) -> np.ndarray:
    """Hashes of all seeds of a text; the same for each of the shapes."""
    parts = []
    for shape in _SHAPES:
        n = max(0, len(words) - shape[-1])
        total = np.zeros(n, np.uint64)
        for place, multiplier in zip(shape, _MULTIPLIERS):
            total += words[place : place + n] * np.uint64(multiplier)
        parts.append(total ^ (total >> np.uint64(29)))
    return np.concatenate(parts)


def _chunks(texts: pa.Array) -> Iterator[list[bytes]]:
    chunk, held = [], 0
    for text in texts:
        chunk.append(text.as_py() or b"")
        held += len(chunk[-1])
        if held >= _CHUNK:
            yield chunk
            chunk, held = [], 0
    if chunk:
        yield chunk


def _passages(known: np.ndarray, text: np.ndarray, need: float) -> Iterator[tuple[int, int]]:
    """Passages of the text outside of which no alignment with the item scores ``need``.

    An alignment scores no more than the sum over its words of the text, ``MATCH`` for each that
    the item has at all. The best one sums to more than zero from its first word to any other,
    so it is within one stretch between two places where the running sum, held at zero or more,
    is zero.
    """
    place = np.minimum(np.searchsorted(known, text), len(known) - 1)
    total = np.zeros(len(text) + 1, np.int64)
    np.cumsum(np.where(known[place] == text, MATCH, max(OTHER, GAP)), out=total[1:])
    total -= np.minimum.accumulate(total)
    enough = np.flatnonzero(total >= need)
    if len(enough):
        zeros = np.append(np.flatnonzero(total == 0), len(text))
        for k in np.unique(np.searchsorted(zeros, enough)).tolist():
            yield int(zeros[k - 1]), int(zeros[k])


def _needed(item: np.ndarray) -> float:
    """Least score of a copy of the item."""
    return MATCH * min(SHARE * len(item), RUN_WORDS)


def _judged(item: np.ndarray, passage: np.ndarray) -> tuple[float, int, int] | None:
    """Score, start and end of the best alignment if it makes the passage a copy."""
    score, i, j = align(item, passage)
    if score < _needed(item):
        return None
    _, _, back = align(item[: i + 1][::-1], passage[: j + 1][::-1])
    return score / (MATCH * len(item)), j - back, j + 1


def align(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    """Smith-Waterman: the best local score and the last places in ``a`` and ``b``."""
    best = (0, 0, 0)
    steps = np.arange(len(b) + 1) * GAP
    row = np.zeros(len(b) + 1, np.int64)
    for i, word in enumerate(a):
        new = np.maximum(row + GAP, 0)
        np.maximum(new[1:], row[:-1] + np.where(b == word, MATCH, OTHER), out=new[1:])
        row = np.maximum.accumulate(new - steps) + steps  # words of b left out
        top = int(row.argmax())
        if row[top] > best[0]:
            best = (int(row[top]), i, top - 1)
    return best
