"""Removal of repeated passages by prefix-partitioned suffix trees over words.

A passage of ``window`` words or more that documents share is a node of the suffix tree of
all documents at that depth. The tree is never held whole:

* Suffixes are taken where every window has one: each window of a document names the suffix
  that starts at its smallest ``prefix``-gram (by hash, the last if equal), so equal windows
  name equal suffixes at the same place.
* Suffixes whose prefix is in one document only have no inner nodes and are left out.
* The others are grouped by their prefix. A group of up to ``group_rows`` suffixes fits a
  task's memory; its subtree is grown word by word to both sides, and nodes of ``window``
  words or more that several documents reach are its repeats.
* If a prefix has more suffixes, it is lengthened step by step (8, 16, 30 words of a window of 50)
  until its groups fit. All windows of a group have the words of its prefix, so those that
  begin closely before the suffix lengthen it to the right, and the others to the left.
* Only a prefix of which the longest form still has more suffixes, so a passage of 30 words in more
  documents than a group holds, is split by all words of its windows: the smallest document
  of each window is then found by grouping, combined before the shuffle.

A repeat is known by its words, not by a hash, but in that last case, where 128 bits decide.
"""

from __future__ import annotations

import sys
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from starledger.llm.common import TABLE_BITS, as_bytes, batch, bit_table, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(sys.modules["starledger.llm.common"])

WINDOW = 50
PREFIX = 8
GROUP_ROWS = 1 << 15

#: How often an oversized prefix is lengthened.
_DEEPER = 2
_PLACE = np.uint64((1 << 24) - 1)
_PIECE = 1 << 22
_STRETCH = 1 << 18
_RUN = 1 << 20
_BASE = 0x94D049BB133111EB
_FLUSH = 4 << 20
_LAST = (1 << 63) - 1

_SLICES = pa.schema(
    [
        ("prefix", pa.int64()),
        ("id", pa.int64()),
        ("hash", pa.int64()),
        ("low", pa.int32()),
        ("high", pa.int32()),
        ("inside", pa.int32()),
        ("words", pa.binary()),
    ]
)
_REMOVED = pa.schema(
    [
        ("id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_removed", pa.int64()),
        ("kept", pa.binary()),
        ("removed", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
    ]
)


def without_repeats(
    docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW,
    prefix: int = PREFIX, group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """``id``, ``n_words``, ``n_removed``, ``kept`` and ``removed`` of every row.

    Removed is each word that is covered by a window whose words also start in a row with a
    smaller id; ``kept`` are the other words joined by one space, ``removed`` the spans taken
    out, as starts and ends (exclusive) of words. Words are what is between the six ASCII
    white-space characters. A null text has no words. A null id is larger than all others.
    Rows with equal ids do not affect each other; a repeated row gets the same result each
    time. Ids are integers; other columns are not read.
    """
    rows = docs.select(F.col(id).cast("long").alias("id"), as_bytes(text).alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text"))
    starts = rows.mapInArrow(
        lambda batches: _starts(batches, window, prefix),
        "id long, hash long, prefix long, place int, low int, high int",
    )
    # Stored, so that Spark can split the rows of a hot prefix in the join.
    shared = stored(_shared(starts, "prefix"), "prefixes")
    oversized = shared.where(F.col("n") > group_rows)
    if oversized.isEmpty():
        fitting, large = starts.join(shared.drop("n"), "prefix"), None
    else:
        fitting, large = _lengthened(rows, shared, window, prefix, group_rows)
    groups = _slices(rows, fitting, window)
    groups = groups.repartition("prefix").sortWithinPartitions("prefix")
    found = groups.mapInArrow(
        lambda batches: _repeats(batches, window, prefix, group_rows),
        "id long, hash long, low int, high int",
    )
    if large is not None:
        found = found.union(_large_repeats(_slices(rows, large, window), window))
    spans = found.groupBy("id", "hash").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    joined = _with_rows(rows, spans)
    return joined.mapInArrow(
        lambda batches: _removed(batches, window),
        "id long, n_words long, n_removed long, kept binary, removed array<struct<start: int, end: int>>",
    ).select(F.col("id").alias(id), "n_words", "n_removed", F.col("kept").cast("string").alias("kept"), "removed")


def _shared(starts: DataFrame, key: str) -> DataFrame:
    """Prefixes that several documents have, with the number ``n`` of their suffixes."""
    rank = F.coalesce("id", F.lit(_LAST))
    found = starts.groupBy(key).agg(
        F.min(rank).alias("least"), F.max(rank).alias("most"), F.count(F.lit(1)).alias("n")
    )
    return found.where("least < most").select(key, "n")


def _lengthened(
    rows: DataFrame, shared: DataFrame, window: int, prefix: int, group_rows: int
) -> tuple[DataFrame, DataFrame | None]:
    """The suffixes under prefixes that fit, lengthened where they have to be; and those left, if any.

    Texts are split once for all lengths: suffixes are stored, those of oversized prefixes parted
    by side, with their ``longer`` prefixes. A table of bits of fixed size tells tasks which to part;
    a suffix that is parted for nothing is two of the same prefix.
    """
    bits = bit_table(F.col("prefix").bitwiseAND((1 << TABLE_BITS) - 1), shared.where(F.col("n") > group_rows))
    hot = rows.sparkSession.sparkContext.broadcast(bits.tobytes())
    starts = rows.mapInArrow(
        lambda batches: _starts(batches, window, prefix, hot),
        "id long, hash long, prefix long, place int, low int, high int, longer array<long>",
    )
    suffixes = stored(starts.join(shared, "prefix"), "suffixes")
    fitting = suffixes.where(F.col("n") <= group_rows).drop("n", "longer")
    deep = suffixes.where(F.col("n") > group_rows).drop("n")
    for step in range(_DEEPER):
        deep = deep.withColumn("prefix", F.get("longer", F.lit(step)))
        shared = stored(_shared(deep, "prefix"), "prefixes")
        deep = deep.join(shared, "prefix")
        fitting = fitting.unionByName(deep.where(F.col("n") <= group_rows).drop("n", "longer"))
        deep = deep.where(F.col("n") > group_rows).drop("n")
    left = not shared.where(F.col("n") > group_rows).isEmpty()
    return fitting, deep.drop("longer") if left else None


def _with_rows(rows: DataFrame, lists: DataFrame, how: str = "left") -> DataFrame:
    """Rows with the list of their id and hash; the same shuffle of texts serves every call."""
    lists = lists.withColumnsRenamed({"id": "its_id", "hash": "its_hash"})
    same = rows["id"].eqNullSafe(lists["its_id"]) & (rows["hash"] == lists["its_hash"])
    return rows.join(lists, same, how).drop("its_id", "its_hash")


class _Words:
    """64-bit hashes of the words of a text, found for all words at once.

    A word's bytes are the digits of a number; sums over the whole text give it for each word, and
    words are equal wherever they stand. The text is taken in stretches of fixed size.
    """

    def __init__(self, stretch: int = _STRETCH) -> None:
        self.stretch = stretch
        self.space = np.zeros(256, bool)
        self.space[list(b" \t\n\r\v\f")] = True
        self.digits = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
        self.powers, self.inverses = (
            np.cumprod(np.full(stretch, x, np.uint64)) for x in (_BASE, pow(_BASE, -1, 1 << 64))
        )

    def __call__(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The hash of each word and the place of its first byte; the text begins and ends with space."""
        data = np.frombuffer(text, np.uint8)
        places, sums, factors = [], [], []
        total, power, inverse = 0, 1, 1
        for at in range(0, len(data) - 1, self.stretch):
            piece = data[at : at + self.stretch + 1]  # a byte more, which the next begins with
            space, n = self.space[piece], len(piece) - 1
            edges = np.flatnonzero(space[1:] != space[:-1])
            summed = np.cumsum(self.digits[piece[:-1]] * self.powers[:n])
            starts = edges[space[edges]]
            places.append(starts + (at + 1))
            sums.append(summed[edges] * np.uint64(power) + np.uint64(total))
            factors.append(self.inverses[starts] * np.uint64(inverse))
            total = (total + power * int(summed[-1])) % (1 << 64)
            power = power * int(self.powers[-1]) % (1 << 64)
            inverse = inverse * int(self.inverses[-1]) % (1 << 64)
        if not places:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        # Edges are by turns the start and the end of a word.
        places, sums, factors = map(np.concatenate, (places, sums, factors))
        return _mixed((sums[1::2] - sums[::2]) * factors), places


def _mixed(numbers: np.ndarray) -> np.ndarray:
    numbers = (numbers ^ (numbers >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return numbers ^ (numbers >> np.uint64(32))


def _runs(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Texts that follow each other, about ``_RUN`` bytes at a time, with the row of the first."""
    held, size = [], 0
    for row, text in enumerate(texts):
        held.append(text.as_py() or b"")
        size += len(held[-1])
        if size >= _RUN:
            yield row + 1 - len(held), held
            held, size = [], 0
    if held:
        yield len(texts) - len(held), held


def _starts(
    batches: Iterator[pa.RecordBatch], window: int, prefix: int, hot=None
) -> Iterator[pa.RecordBatch]:
    """The suffixes that the windows of each text name, with the first and last such window.

    Texts are taken many at a time: a window that begins in one and ends in another is none.
    Where ``hot``, a table of bits, has a prefix, its suffixes have a row per side and longer prefixes.
    """
    table = None if hot is None else np.frombuffer(hot.value, np.uint8)
    hashed = _Words()
    for rows in batches:
        for row, texts in _runs(rows.column(1)):
            hashes, places = hashed(b" ".join([b"", *texts, b""]))
            ends = np.searchsorted(places, np.cumsum([len(x) + 1 for x in texts]))
            begins = np.concatenate(([0], ends[:-1]))
            windows = np.maximum(ends - begins - window + 1, 0)
            whole = np.zeros(len(hashes) + 1, np.int8)  # 1 where a text's windows begin, -1 after them
            some = windows > 0
            whole[begins[some]] += 1
            whole[(begins + windows)[some]] -= 1
            whole = np.cumsum(whole[:-1], dtype=np.int8) > 0
            out, lists = [], []
            # Pieces overlap by a window less a word, so each window is in one of them.
            for at in range(0, len(hashes) - window + 1, _PIECE):
                piece = hashes[at : at + _PIECE + window - 1]
                named = _named(piece, window, prefix, whole[at : at + _PIECE])
                if table is not None:
                    number = named[0] & np.uint64((1 << TABLE_BITS) - 1)
                    oversized = (table[(number >> np.uint64(3)).astype(np.int64)] >> (number & np.uint64(7)).astype(np.uint8) & 1) > 0
                    parted, longer = _longer(piece, tuple(x[oversized] for x in named), window, prefix)
                    named = tuple(np.concatenate((x[~oversized], y)) for x, y in zip(named, parted))
                    lists.append((np.count_nonzero(~oversized), longer))
                out.append((named[0], *(x + at for x in named[1:])))
            if not out:
                continue
            columns = [np.concatenate(x) for x in zip(*out)]
            owner = np.searchsorted(ends, columns[2], "right")
            of = pa.array(owner + row)
            columns = [
                rows.column(0).take(of), rows.column(2).take(of), pa.array(columns[0].view(np.int64)),
                *(pa.array((x - begins[owner]).astype(np.int32)) for x in columns[1:]),
            ]
            if table is not None:
                sizes = np.concatenate([np.repeat([0, _DEEPER], [n, len(x)]) for n, x in lists])
                bounds = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
                longer = np.concatenate([x for _, x in lists]).view(np.int64)
                columns.append(pa.ListArray.from_arrays(bounds, pa.array(longer.ravel())))
            names = ["id", "hash", "prefix", "place", "low", "high", "longer"]
            yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])


def _longer(hashes: np.ndarray, named: tuple, window: int, prefix: int) -> tuple[tuple, np.ndarray]:
    """Named suffixes by side, and the hashes of their prefixes lengthened to that side.

    Windows that begin at most ``half`` words before the suffix have as many words after its
    prefix as the right side is lengthened by; the others have those that the left side takes.
    """
    half = (window - prefix) // 2
    grams, place, low, high = named
    sides, hashed = [], []
    for right in (True, False):
        first = np.maximum(low, place - half) if right else low
        last = high if right else np.minimum(high, place - half - 1)
        some = np.flatnonzero(first <= last)
        most = window - prefix - half if right else half + 1
        key = grams[some] ^ np.uint64(right)
        steps, done = [], 0
        for step in range(_DEEPER):
            # Twice the words at each step, at the last as many as all windows of the side have.
            until = most if step == _DEEPER - 1 else min(most, prefix * ((2 << step) - 1))
            for k in range(done, until):
                at = place[some] + (prefix + k if right else -1 - k)
                key = (key ^ (key >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + hashes[at]
            done = until
            steps.append(key)
        sides.append((grams[some], place[some], first[some], last[some]))
        hashed.append(np.stack(steps, axis=1) if steps else np.zeros((len(some), 0), np.uint64))
    return tuple(map(np.concatenate, zip(*sides))), np.concatenate(hashed)


def _named(hashes: np.ndarray, window: int, prefix: int, whole: np.ndarray) -> tuple:
    """Prefix hash and place of each suffix that ``whole`` windows name, its first and its last window."""
    n = len(hashes) - prefix + 1
    grams = np.zeros(n, np.uint64)
    for k in range(prefix):
        grams *= np.uint64(0x9E3779B97F4A7C15)
        grams += hashes[k : k + n]
    grams = _mixed(grams)
    least = (grams & ~_PLACE) | (_PLACE - np.arange(n, dtype=np.uint64))
    width, wanted = 1, window - prefix + 1
    while width < wanted:  # minima of ever longer stretches
        step = min(width, wanted - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    place = (_PLACE - (least & _PLACE)).astype(np.int64)
    place[~whole[: len(place)]] = -1  # windows of two texts name nothing
    bounds = np.flatnonzero(place[1:] != place[:-1]) + 1
    low, after = np.concatenate(([0], bounds)), np.append(bounds, len(place))
    named = place[low] >= 0
    low, high = low[named], after[named] - 1
    return grams[place[low]], place[low], low, high


def _slices(rows: DataFrame, starts: DataFrame, window: int) -> DataFrame:
    """The words of all windows that name a suffix, with the suffix's place among them."""
    named = starts.groupBy("id", "hash").agg(
        F.collect_list(F.struct("prefix", "place", "low", "high")).alias("named")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            ids, texts, hashes, lists = rows.columns
            sizes = lists.value_lengths().to_numpy()
            of = pa.array(np.repeat(np.arange(len(sizes)), sizes))
            prefix, place, low, high = lists.flatten().flatten()
            inside = pa.array(place.to_numpy() - low.to_numpy())
            whole = [ids.take(of), hashes.take(of), low, high, inside]
            bounds = zip(low.to_pylist(), high.to_pylist())
            out, held, at = [], 0, 0
            for text, size in zip(texts, sizes.tolist()):
                words = text.as_py().split()
                for first, last in islice(bounds, size):
                    part = b" ".join(words[first : last + window])
                    out.append(part)
                    held += len(part)
                    if held >= _FLUSH:
                        yield batch(_SLICES, [x.slice(at, len(out)) for x in (prefix, *whole)] + [out])
                        out, held, at = [], 0, at + len(out)
            if out:
                yield batch(_SLICES, [x.slice(at, len(out)) for x in (prefix, *whole)] + [out])

    joined = _with_rows(rows, named, "inner").select("id", "text", "hash", "named")
    return joined.mapInArrow(
        cut, "prefix long, id long, hash long, low int, high int, inside int, words binary"
    )


def _repeats(
    batches: Iterator[pa.RecordBatch], window: int, prefix: int, group_rows: int
) -> Iterator[pa.RecordBatch]:
    """Repeated windows of rows ordered by prefix; groups are taken together, never cut."""
    held: list[pa.RecordBatch] = []
    for rows in batches:
        held.append(rows)
        if sum(x.num_rows for x in held) >= group_rows:
            table = pa.Table.from_batches(held).combine_chunks()
            prefixes = table.column("prefix").to_numpy()
            cut = int(np.argmax(prefixes == prefixes[-1]))  # the last group may go on
            yield from _subtrees(table.slice(0, cut), window, prefix)
            held = table.slice(cut).to_batches()
    if held:
        yield from _subtrees(pa.Table.from_batches(held), window, prefix)


def _subtrees(table: pa.Table, window: int, prefix: int) -> Iterator[pa.RecordBatch]:
    """Grow the subtrees of all groups of the table, and find their repeats."""
    n = table.num_rows
    if n < 2:
        return
    roots = np.unique(table.column("prefix").to_numpy(), return_inverse=True)[1]
    ids = table.column("id").fill_null(_LAST).to_numpy()
    low, high, inside = (table.column(c).to_numpy().astype(np.int64) for c in ("low", "high", "inside"))
    # Words as numbers: after the suffix's place to the right, before it to the left.
    numbers: defaultdict = defaultdict()
    numbers.default_factory = numbers.__len__
    sizes = []

    def numbered(words: pa.Scalar) -> Iterator[int]:
        line = words.as_py().split()
        sizes.append(len(line))
        return map(numbers.__getitem__, line)

    line = np.fromiter(chain.from_iterable(map(numbered, table.column("words"))), np.int64)
    ends = np.cumsum(sizes)
    begins = np.concatenate(([0], ends[:-1]))
    right = np.full((window, n), -1, np.int64)
    left = np.full((window - prefix, n), -1, np.int64)
    for depth in range(window):
        some = np.flatnonzero(begins + inside + depth < ends)
        right[depth, some] = line[(begins + inside)[some] + depth]
    for depth in range(window - prefix):
        some = np.flatnonzero(inside > depth)
        left[depth, some] = line[(begins + inside)[some] - depth - 1]
    rights, lefts = _grown(roots, right, len(numbers)), _grown(roots, left, len(numbers))
    # A window that starts ``back`` words before the suffix is a node to the left at that
    # depth and one to the right at the rest.
    repeated = np.zeros((window - prefix + 1, n), bool)
    for back in range(window - prefix + 1):
        some = np.flatnonzero((inside >= back) & (inside - back <= high - low))
        nodes = rights[window - back][some] * (n + 1) + lefts[back][some]
        node = np.unique(nodes, return_inverse=True)[1]
        least = np.full(len(some), _LAST)
        np.minimum.at(least, node, ids[some])
        repeated[back, some] = ids[some] > least[node]
    back, row = np.nonzero(repeated)
    start = (low + inside)[row] - back
    order = np.lexsort((start, row))
    row, start = row[order], start[order]
    if len(row):
        first = np.concatenate(([True], (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)))
        last = np.append(first[1:], True)
        of = pa.array(row[first])
        yield pa.RecordBatch.from_arrays(
            [table.column("id").combine_chunks().take(of), table.column("hash").combine_chunks().take(of),
             pa.array(start[first].astype(np.int32)), pa.array(start[last].astype(np.int32))],
            ["id", "hash", "low", "high"],
        )


def _grown(roots: np.ndarray, words: np.ndarray, distinct: int) -> list[np.ndarray]:
    """The node of each row at every depth, from the roots on; a node has one number."""
    nodes = [roots.astype(np.int64)]
    for depth in words:
        nodes.append(np.unique(nodes[-1] * (distinct + 1) + depth + 1, return_inverse=True)[1])
    return nodes


def _large_repeats(slices: DataFrame, window: int) -> DataFrame:
    """Repeated windows of rows whose prefix has too many suffixes for a task."""
    whole = lambda i: F.slice("words", i + 1, window)
    windows = F.transform(
        F.sequence(F.lit(0), F.col("high") - F.col("low")),
        lambda i: F.struct(
            (F.col("low") + i).alias("at"), F.xxhash64(whole(i)).alias("a"), F.xxhash64(F.lit(1), whole(i)).alias("b")
        ),
    )
    rows = slices.withColumn("words", F.split(F.col("words").cast("string"), " "))
    rows = rows.select("id", "hash", F.explode_outer(windows).alias("w"))
    rows = rows.select("id", "hash", "w.*", F.coalesce("id", F.lit(_LAST)).alias("rank"))
    least = rows.groupBy("a", "b").agg(F.min("rank").alias("least"))
    return rows.join(least, ["a", "b"]).where("rank > least").select(
        "id", "hash", F.col("at").alias("low"), F.col("at").alias("high")
    )


def _removed(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        out, held = [], 0
        ids, texts, _, lists = rows.columns
        for id, text, spans in zip(ids.to_pylist(), texts, lists):
            words, removed, gone = (text.as_py() or b"").split(), [], 0
            for low, high in sorted((s["low"], s["high"] + window) for s in spans.as_py() or ()):
                if removed and low <= removed[-1]["end"]:
                    removed[-1]["end"] = max(removed[-1]["end"], high)
                else:
                    removed.append({"start": low, "end": high})
            kept, at = [], 0
            for span in removed:
                kept += words[at : span["start"]]
                at, gone = span["end"], gone + span["end"] - span["start"]
            kept = b" ".join(kept + words[at:])
            out.append((id, len(words), gone, kept, removed))
            held += len(kept) + 100
            if held >= _FLUSH:
                yield batch(_REMOVED, zip(*out))
                out, held = [], 0
        if out:
            yield batch(_REMOVED, zip(*out))
