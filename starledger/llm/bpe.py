"""Byte-level BPE: every distinct word of the corpus is encoded in one place, and joined back.

Texts are split into pre-tokens. A batch of texts keeps the places of its words as numbers, in
a file of the shared folder, and sends each of its different words once, with its number. The
words of all batches meet by a shuffle, are encoded once each, and their ids return to the
batches, where the places are filled in. So a word that fills a third of the corpus costs a
row per batch. Decoding joins the ids with the table of the tokens' bytes, which has a row per
token of the vocabulary.

The vocabulary is read by the driver and sent to the tasks; its size is the tokenizer's.
Files are reached through ``pyarrow.fs``, so the shared folder is a URI or absolute path.
"""

from __future__ import annotations

import base64
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, functions as F

from starledger.llm.common import as_bytes
from starledger.shared import new_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Text of a batch; its words and their ids are held by one task at a time.
BATCH_BYTES = 32 << 20
_FLUSH = 4 << 20
_BATCHES_PER_TASK = 1 << 24


def load_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a rank file: a token in base64 and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def encode(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, id: str = "doc_id", text: str = "text",
    batch_bytes: int = BATCH_BYTES, decoded: bool = False,
) -> DataFrame:
    """``id``, ``n_tokens`` and ``ids`` (unsigned 32-bit, little-endian) of every row.

    With ``decoded``, also what ``decode`` makes of the ids, by the tasks that have them.

    Each match of ``pattern`` is encoded by itself, without special tokens. A null text is an
    empty one, which has no tokens. Rows with a null id and repeated rows are kept; other
    columns are not read. Tasks that are run again must get the same rows in the same order,
    as from stored tables.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id).alias("id"), as_bytes(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    folder = new_folder(spark, "bpe")
    vocabulary = spark.sparkContext.broadcast(ranks)
    words = rows.mapInArrow(
        lambda batches: _split(batches, folder, pattern, batch_bytes), "batch long, code int, word binary"
    )
    by_word = words.repartition("word").sortWithinPartitions("word")
    encoded = by_word.mapInArrow(
        lambda batches: _encode(batches, vocabulary.value), "batch long, code int, ids binary"
    )
    by_batch = encoded.repartition("batch").sortWithinPartitions("batch", "code")
    done = by_batch.mapInArrow(
        lambda batches: _assemble(batches, folder, vocabulary.value, decoded),
        f"id {kind}, n_tokens long, ids binary" + ", decoded binary" * decoded,
    )
    return done.withColumnRenamed("id", id)


def decode(tokens: DataFrame, ranks: dict[bytes, int], ids: str = "ids") -> DataFrame:
    """The rows with ``decoded``, the bytes that column ``ids`` stands for; null for null.

    An id that the vocabulary lacks is an error. A column ``decoded`` is replaced.
    """
    rows = tokens.drop("decoded").withColumn("_ids", F.col(ids))
    names = [name for name in rows.columns if name != "_ids"]
    shared = tokens.sparkSession.sparkContext.broadcast(_token_table(ranks))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for rows in batches:
            decoded = [_decoded(x.as_py(), table) if x.is_valid else None for x in rows.columns[-1]]
            yield pa.RecordBatch.from_arrays(
                [*rows.columns[:-1], pa.array(decoded, pa.binary())], [*names, "decoded"]
            )

    schema = rows.withColumnRenamed("_ids", "decoded").schema
    return rows.mapInArrow(work, schema)


def _token_table(ranks: dict[bytes, int]) -> list:
    """The bytes of each token, by its id."""
    table: list = [None] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


def _decoded(ids: bytes, table: list) -> bytes:
    return b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()])


def _width(ranks: dict[bytes, int]) -> str:
    """The number type in which ids travel."""
    return "<u2" if max(ranks.values(), default=0) < 1 << 16 else "<u4"


def _split(batches: Iterator[pa.RecordBatch], folder: str, pattern: str, batch_bytes: int):
    """Store the places of words, a file per batch; put out the batch's different words."""
    import regex

    find = regex.compile(pattern).findall
    number = TaskContext.get().partitionId() * _BATCHES_PER_TASK
    codes: dict[str, int] = {"": 0}  # so that a batch without words still has a row
    ids, places, held = [], [], 0
    for rows in batches:
        start = 0
        for at, text in enumerate(rows.column(1)):
            content = text.as_py() or b""
            words = find(content.decode("utf-8", "replace"))
            places.append(np.array([codes.setdefault(w, len(codes)) for w in words], np.int32))
            held += len(content)
            if held >= batch_bytes:
                ids.append(rows.column(0).slice(start, at + 1 - start))
                start = at + 1
                yield from _finished(folder, number, ids, places, codes)
                number += 1
                codes, ids, places, held = {"": 0}, [], [], 0
        ids.append(rows.column(0).slice(start))
    if places:
        yield from _finished(folder, number, ids, places, codes)


def _finished(folder: str, number: int, ids: list, places: list, codes: dict) -> Iterator[pa.RecordBatch]:
    # Bytes of equal weight lie together, as they compress well.
    planes = [[(x >> shift).astype(np.uint8).tobytes() for x in places] for shift in (0, 8, 16, 24)]
    table = pa.table([pa.concat_arrays(ids), *(pa.array(p, pa.binary()) for p in planes)], names=["id", "p0", "p1", "p2", "p3"])
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    attempt = f"{root}/{number}.{TaskContext.get().taskAttemptId()}"
    with store.open_output_stream(attempt) as out:
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        with pa.ipc.new_stream(out, table.schema, options=options) as writer:
            writer.write_table(table)
    store.move(attempt, f"{root}/{number}")
    words = list(codes)
    for at in range(0, len(words), 1 << 16):
        some = [word.encode() for word in words[at : at + (1 << 16)]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(some), number)), pa.array(np.arange(at, at + len(some), dtype=np.int32)),
             pa.array(some, pa.binary())],
            ["batch", "code", "word"],
        )


def _encode(batches: Iterator[pa.RecordBatch], ranks: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """Ids of each word; equal words come one after the other."""
    import tiktoken

    # The pattern takes a word whole.
    coder = tiktoken.Encoding("words", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
    last, ids, width = b"", b"", _width(ranks)
    for rows in batches:
        out = []
        for word in rows.column(2):
            word = word.as_py()
            if word != last:
                last = word
                ids = np.array(coder.encode_ordinary(word.decode()), width).tobytes()
            out.append(ids)
        yield pa.RecordBatch.from_arrays([*rows.columns[:2], pa.array(out, pa.binary())], ["batch", "code", "ids"])


def _assemble(
    batches: Iterator[pa.RecordBatch], folder: str, ranks: dict[bytes, int], decoded: bool
) -> Iterator[pa.RecordBatch]:
    """Texts of ids, from rows ordered by batch and code."""
    number, held = None, []
    width, table = _width(ranks), _token_table(ranks) if decoded else None
    for rows in batches:
        numbers = rows.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(numbers[1:] != numbers[:-1]) + 1).tolist(), len(numbers)]
        for a, b in zip(cuts, cuts[1:]):
            if number is not None and numbers[a] != number:
                yield from _filled(folder, number, held, width, table)
                held = []
            number = int(numbers[a])
            held.append(rows.column(2).slice(a, b - a))
    if held:
        yield from _filled(folder, number, held, width, table)


def _filled(
    folder: str, number: int, words: list[pa.Array], width: str, tokens: list | None
) -> Iterator[pa.RecordBatch]:
    ids = pa.concat_arrays(words).cast(pa.large_binary())
    bounds = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset : ids.offset + len(ids) + 1]
    bounds = bounds // np.dtype(width).itemsize
    lengths, first = np.diff(bounds), bounds[:-1]
    data = ids.buffers()[2]
    flat = np.frombuffer(data, width) if data is not None and data.size else np.zeros(0, width)
    store, root = fs.FileSystem.from_uri(folder)
    with store.open_input_stream(f"{root}/{number}") as stream:
        table = pa.ipc.open_stream(stream).read_all()
    start, out, held = 0, [], 0
    for row, planes in enumerate(zip(*(table.column(k) for k in range(1, 5)))):
        codes = sum(
            np.frombuffer(p.as_py(), np.uint8).astype(np.int64) << shift for p, shift in zip(planes, (0, 8, 16, 24))
        )
        sizes = lengths[codes]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        places = np.repeat(first[codes] - ends + sizes, sizes) + np.arange(total)
        found = flat[places].astype("<u4").tobytes()
        out.append((total, found) if tokens is None else (total, found, _decoded(found, tokens)))
        held += 4 * total + (0 if tokens is None else len(out[-1][2]))
        if held >= _FLUSH or row == table.num_rows - 1:
            n, *texts = zip(*out)
            names = table.column(0).slice(start, len(out)).combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [names, pa.array(n, pa.int64()), *(pa.array(x, pa.binary()) for x in texts)],
                ["id", "n_tokens", "ids", "decoded"][: 2 + len(texts)],
            )
            start, out, held = row + 1, [], 0
