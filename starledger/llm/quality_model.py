"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

Each feature has a weight and a short vector, and every pair of features of a document adds
the product of its vectors. The sum over all pairs is half the square of the summed vectors
less the sum of their squares, so scoring takes time in proportion to a document's words.

The model has a fixed size. It is fitted by one task on at most ``sample_rows`` labelled
documents, those whose ids hash lowest; all documents are scored, whole.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from starledger.llm.common import as_bytes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Size of the model: buckets of words, bins of each statistic, length of the vectors.
WORDS = 1 << 15
BINS = 16
RANK = 8
_STATS = 12
_FEATURES = WORDS + _STATS * BINS

#: Most labelled documents that a model is fitted on.
SAMPLE_ROWS = 10_000

_EPOCHS, _STEP, _RATE, _DECAY = 8, 128, 0.1, 1e-4
_CHUNK = 4 << 20
_MEMO = 1 << 19


class Model(NamedTuple):
    bias: float
    weights: np.ndarray
    vectors: np.ndarray


def held_out(id: str | Column) -> Column:
    """Whether crc32 of the id as text leaves 0 modulo 5; a null id is held out."""
    column = F.col(id) if isinstance(id, str) else id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    size: str | None = "n_chars",
    label: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> Model:
    """A model of ``label`` (0 or 1) from the rows that are not held out.

    Ids that are null or have contradicting labels, and null labels, teach nothing; neither do
    labels without a document. Without any labelled document every score is 0.5.
    """
    known = labels.select(F.col(id).alias("id"), F.col(label).cast("double").alias("label"))
    known = known.where("label in (0, 1) and id is not null").where(~held_out("id"))
    known = known.groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("most"))
    known = known.where("label = most").drop("most")
    known = known.join(docs.select(F.col(id).alias("id")).distinct(), "id", "left_semi")
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    rows = docs.select(F.col(id).alias("id"), *_inputs(docs, text, size))
    # The chosen rows are bounded by the parameter, whatever the tables hold.
    rows = rows.join(F.broadcast(chosen), "id")
    rows = rows.groupBy("id", "label").agg(F.min(F.struct("text", "size")).alias("doc"))
    rows = rows.select("id", "label", "doc.text", "doc.size")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(batches)
        if whole.num_rows:
            whole = whole.sort_by("id")
            parts = [p for b in whole.to_batches() for p in _features(b.column("text"), b.column("size"))]
            model = _train(parts, whole.column("label").to_numpy())
            arrays = [np.float64(model.bias), model.weights, model.vectors]
            fields = [pa.array([a.tobytes()], pa.binary()) for a in arrays]
            yield pa.RecordBatch.from_arrays(fields, ["bias", "weights", "vectors"])

    made = rows.repartition(1).mapInArrow(train, "bias binary, weights binary, vectors binary").collect()
    if not made:
        return Model(0.0, np.zeros(_FEATURES, np.float32), np.zeros((_FEATURES, RANK), np.float32))
    weights, vectors = (np.frombuffer(x, np.float32) for x in made[0][1:])
    return Model(float(np.frombuffer(made[0][0])[0]), weights, vectors.reshape(_FEATURES, RANK))


def score(docs: DataFrame, model: Model, text: str = "text", size: str | None = "n_chars") -> DataFrame:
    """The rows with their ``score``, 0 to 1; a column of that name is replaced.

    A null text is an empty one; an empty text has a score, too. A null size, or none, is a
    statistic of its own. Equal texts with equal sizes have equal scores.
    """
    kept = [F.col(f"`{name}`") for name in docs.columns if name != "score"]
    rows = docs.select(*kept, *_inputs(docs, text, size, "_fm_"))
    # As a plain tuple: broadcasts are unpickled where this package need not be installed.
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            texts, sizes = rows.columns[-2:]
            parts = [_margins(Model(*shared.value), *part) for part in _features(texts, sizes)]
            margin = np.concatenate(parts) if parts else np.zeros(0)
            scores = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [*rows.columns[:-2], pa.array(scores, pa.float64())], [*rows.schema.names[:-2], "score"]
            )

    schema = rows.schema
    fields = schema.fields[:-2]
    return rows.mapInArrow(work, type(schema)([*fields, _score_field()]))


def _score_field():
    from pyspark.sql.types import DoubleType, StructField

    return StructField("score", DoubleType())


def _inputs(docs: DataFrame, text: str, size: str | None, prefix: str = "") -> list[Column]:
    number = F.col(size).cast("double") if size in docs.columns else F.lit(None).cast("double")
    return [as_bytes(text).alias(f"{prefix}text"), number.alias(f"{prefix}size")]


class _Buckets(dict):
    """Bucket of each word, remembered; forgets all when it has grown too large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MEMO:
            self.clear()
        bucket = self[word] = zlib.crc32(word.lower()) % WORDS
        return bucket


def _kinds() -> np.ndarray:
    """Which byte values count as symbols, capitals, digits, exclamation marks and lines."""
    kinds = np.zeros((256, 5), np.float64)
    for kind, members in enumerate((b"#*$%&|<>", range(65, 91), range(48, 58), b"!", b"\n")):
        kinds[list(members), kind] = 1
    return kinds


def _features(texts: pa.Array, sizes: pa.Array) -> Iterator[tuple]:
    """For chunks of rows: each row's features as (first places, features, values)."""
    buckets, kinds = _Buckets(), _kinds()
    chunk, numbers, held = [], [], 0
    for text, size in zip(texts, sizes.to_pylist()):
        chunk.append(text.as_py() or b"")
        numbers.append(size)
        held += len(chunk[-1])
        if held >= _CHUNK:
            yield _chunk_features(chunk, numbers, buckets, kinds)
            chunk, numbers, held = [], [], 0
    if chunk:
        yield _chunk_features(chunk, numbers, buckets, kinds)


def _chunk_features(chunk: list[bytes], sizes: list, buckets: _Buckets, kinds: np.ndarray) -> tuple:
    rows = len(chunk)
    found = [np.fromiter(map(buckets.__getitem__, words), np.int64, len(words))
             for words in map(bytes.split, chunk)]
    n = np.array([len(x) for x in found])
    words = np.concatenate(found)
    owner = np.repeat(np.arange(rows), n)
    places, counts = np.unique(owner * WORDS + words, return_counts=True)
    of = places // WORDS
    distinct = np.bincount(of, minlength=rows)
    most = np.zeros(rows)
    np.maximum.at(most, of, counts)
    again = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
    again = np.bincount(owner[1:][again], minlength=rows)
    length = np.array([len(text) for text in chunk])
    seen = [np.bincount(np.frombuffer(text, np.uint8), minlength=256) for text in chunk]
    symbols, capitals, digits, marks, lines = (np.array(seen) @ kinds).T
    some, some_bytes = np.maximum(n, 1), np.maximum(length, 1)
    share = lambda part, whole: np.sqrt(part / whole)
    known = np.array([-1.0 if s is None or s != s or s < 0 else np.log2(s + 1) / 24 for s in sizes])
    stats = [
        np.log2(length + 1) / 24,
        np.log2(n + 1) / 24,
        known,
        share(symbols, some_bytes),
        share(capitals, some_bytes),
        share(digits, some_bytes),
        share(marks, some_bytes),
        length / some / 20,
        share(again, some),
        distinct / some,
        share(most, some),
        share(lines, some),
    ]
    slots = [
        WORDS + stat * BINS + np.clip(np.floor(value * (BINS - 2)) + 1, 0, BINS - 1).astype(np.int64)
        for stat, value in enumerate(stats)
    ]
    # A row's words weigh as one statistic together.
    feature = np.concatenate([places % WORDS, *slots])
    row = np.concatenate([of, *[np.arange(rows)] * len(slots)])
    value = np.concatenate([counts / some[of], np.ones(rows * len(slots))])
    order = np.argsort(row, kind="stable")
    first = np.cumsum(distinct + len(slots)) - (distinct + len(slots))
    return first, feature[order], value[order].astype(np.float32)


def _parts(model: Model, first, feature, value):
    """Margins by the sum-of-squares identity, each row's vector, and each feature's share."""
    shares = model.vectors[feature] * value[:, None]
    total = np.add.reduceat(shares, first, axis=0)
    squares = np.add.reduceat(shares * shares, first, axis=0)
    linear = np.add.reduceat(model.weights[feature] * value, first)
    return model.bias + linear + 0.5 * (total * total - squares).sum(axis=1), total, shares


def _margins(model: Model, first, feature, value):
    return _parts(model, first, feature, value)[0]


def _train(chunks: list[tuple], labels: np.ndarray) -> Model:
    """Logistic loss, steps over a few rows each, with a rate per parameter."""
    draw = np.random.default_rng(1)
    rows = [
        (feature[a:b], value[a:b])
        for first, feature, value in chunks
        for a, b in zip(first, [*first[1:], len(feature)])
    ]
    chance = np.clip(labels.mean(), 0.01, 0.99)
    bias = float(np.log(chance / (1 - chance)))
    weights = np.zeros(_FEATURES, np.float32)
    vectors = draw.normal(0, 0.05, (_FEATURES, RANK)).astype(np.float32)
    speed_w, speed_v = np.full(_FEATURES, 1e-3, np.float32), np.full((_FEATURES, RANK), 1e-3, np.float32)
    for _ in range(_EPOCHS):
        order = draw.permutation(len(rows))
        for at in range(0, len(rows), _STEP):
            some = order[at : at + _STEP]
            feature = np.concatenate([rows[i][0] for i in some])
            value = np.concatenate([rows[i][1] for i in some])
            lengths = np.array([len(rows[i][0]) for i in some])
            first, owner = np.cumsum(lengths) - lengths, np.repeat(np.arange(len(some)), lengths)
            margin, total, shares = _parts(Model(bias, weights, vectors), first, feature, value)
            slope = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[some]).astype(np.float32)
            by_feature = np.argsort(feature, kind="stable")
            ids, starts = np.unique(feature[by_feature], return_index=True)
            pull = (slope[owner] * value)[by_feature]
            grad_w = np.add.reduceat(pull, starts) / len(some) + _DECAY * weights[ids]
            grad_v = np.add.reduceat(pull[:, None] * (total[owner] - shares)[by_feature], starts, axis=0)
            grad_v = grad_v / len(some) + _DECAY * vectors[ids]
            speed_w[ids] += grad_w**2
            speed_v[ids] += grad_v**2
            weights[ids] -= _RATE * grad_w / np.sqrt(speed_w[ids])
            vectors[ids] -= _RATE * grad_v / np.sqrt(speed_v[ids])
            bias -= _RATE * float(slope.mean())
    return Model(bias, weights, vectors)
