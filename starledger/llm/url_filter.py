"""URL filter: host and path rules first, then a ratio of two character language models.

The rules label every URL that they fit. Two smoothed variable-order Markov models, one of
accepted and one of rejected URLs, are counted from all of these; a URL that no rule fits is
judged by the difference of its log-likelihoods per character. The threshold is calibrated on
the labelled URLs, each scored by models of the other half, so that no URL is scored by a
model that has seen it.

Contexts of each order are hashed into a fixed number of buckets. So the models have a fixed
size whatever the corpus; what they are counted from is the whole of it, each distinct URL and
its number of rows combined before the shuffle.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Longest context in characters, and hash buckets per order: the size of the models.
ORDER = 4
BUCKETS = 1 << 16
#: Weight of the shorter context when a longer one is smoothed with it.
WEIGHT = 4.0
#: The calibration's resolution: scores per character in steps of 1/64 from -8 to 8.
STEPS = 64
SPAN = 8


class Rule(NamedTuple):
    verdict: str  # "allow" or "block"
    host: str
    path: str  # from its first slash on


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(path, F.lit(""))


def _longest(rules: list[Rule], value) -> Column:
    """``value(rule)`` of the longest rule that fits, null if none does."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.host + r.path)):
        at_host = (F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)
        found = F.when(at_host & F.col("path").startswith(rule.path), F.lit(value(rule))).otherwise(found)
    return found


def filter_urls(
    pages: DataFrame, rules: list[Rule], id: str = "page_id", url: str = "url", order: int = ORDER
) -> DataFrame:
    """``id``, ``host``, ``path``, ``rule``, ``verdict`` and ``score`` of every row.

    The longest rule (host and path together) that fits decides, else the models do; the score
    is theirs for every row, positive where they allow. Equal scores get equal verdicts. A null
    url is judged as an empty one, whose score is the threshold's alone. If the rules label no
    URL for one of the verdicts, nothing can be learnt and what no rule fits is allowed. Rows
    with a null id and repeated rows are kept and counted; other columns are not read.
    """
    rows = pages.select(F.col(id).alias("id"), F.col(url).cast("string").alias("url"))
    rows = rows.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    ruled = rows.withColumns(
        {
            "rule": _longest(rules, lambda r: r.host + r.path),
            "ruled": _longest(rules, lambda r: r.verdict),
        }
    )
    labelled = ruled.where("ruled is not null and url is not null").groupBy("url").agg(
        F.count(F.lit(1)).alias("n"), (F.first("ruled") == "block").cast("int").alias("label")
    )
    labelled = labelled.withColumn("fold", F.pmod(F.xxhash64("url"), F.lit(2)).cast("int"))
    counts = _counts(labelled, order)
    threshold = _threshold(labelled, counts, order)
    model = None if threshold is None else counts.sum(axis=0).astype(np.float64)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            scores = np.ones(rows.num_rows)
            if shared.value is not None:
                urls = [url or "" for url in rows.column(1).to_pylist()]
                scores = _score(urls, shared.value, order) - threshold
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(scores, pa.float64())], [*rows.schema.names, "score"]
            )

    kind = rows.schema["id"].dataType.simpleString()
    scored = ruled.mapInArrow(
        judge,
        f"id {kind}, url string, host string, path string, rule string, ruled string, score double",
    )
    verdict = F.coalesce("ruled", F.when(F.col("score") > 0, "allow").otherwise("block"))
    return scored.select(
        F.col("id").alias(id), "host", "path", "rule", verdict.alias("verdict"), "score"
    )


def _places(urls: list[str], order: int):
    """For each order, the bucket of every character with its context, and of the context.

    Characters are code points, and a URL begins after ``order`` zeros. Also the URL's number
    of each character.
    """
    lengths = np.array([len(url) for url in urls], np.int64)
    text = np.frombuffer("".join(urls).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(urls)), lengths)
    first = np.repeat(np.cumsum(lengths) - lengths, lengths)
    at = np.arange(len(text))
    grams, contexts = [], []
    code = np.zeros(len(text), np.uint64)  # the context, from its nearest character on
    for n in range(order + 1):
        if n:
            near = np.where(at - n >= first, text[np.maximum(at - n, 0)].astype(np.uint64) + np.uint64(1), 0)
            code = (code ^ near.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            code ^= code >> np.uint64(29)
        gram = (code ^ (text.astype(np.uint64) + np.uint64(1))) * np.uint64(0xBF58476D1CE4E5B9)
        gram ^= gram >> np.uint64(31)
        grams.append((gram % np.uint64(BUCKETS)).astype(np.int64))
        contexts.append((code % np.uint64(BUCKETS)).astype(np.int64))
    return grams, contexts, owner


def _counts(labelled: DataFrame, order: int):
    """Counts by fold, label, kind (gram or context), order and bucket."""
    shape = (2, 2, 2, order + 1, BUCKETS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, np.int64)
        for rows in batches:
            urls, n, label, fold = (column.to_pylist() for column in rows.columns)
            grams, contexts, owner = _places(urls, order)
            n, label, fold = (np.array(x, np.int64)[owner] for x in (n, label, fold))
            for kind, places in enumerate((grams, contexts)):
                for k, place in enumerate(places):
                    np.add.at(total, (fold, label, kind, k, place), n)
        flat = total.ravel()
        some = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(flat[some])], ["place", "n"])

    rows = labelled.mapInArrow(count, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    found = rows.toArrow()  # at most as many rows as the models have cells, a fixed number
    out = np.zeros(np.prod(shape), np.int64)
    out[found.column(0).to_numpy()] = found.column(1).to_numpy()
    return out.reshape(shape)


def _score(urls: list[str], model, order: int):
    """Log-likelihood per character as accepted less that as rejected."""
    grams, contexts, owner = _places(urls, order)
    logs = []
    for label in (0, 1):
        chance = np.full(len(owner), 1.0 / 256)
        for n in range(order + 1):
            seen, all_ = model[label, 0, n][grams[n]], model[label, 1, n][contexts[n]]
            # Hashing may add foreign counts to a gram, so its context has as many at least.
            chance = (seen + WEIGHT * chance) / (np.maximum(seen, all_) + WEIGHT)
        logs.append(np.log(chance))
    lengths = np.bincount(owner, minlength=len(urls))
    return np.bincount(owner, logs[0] - logs[1], len(urls)) / np.maximum(lengths, 1)


def _threshold(labelled: DataFrame, counts, order: int) -> float | None:
    """The score from which the held-out labelled URLs are best told apart.

    Both labels weigh the same; between equally good thresholds the middle one is taken.
    """
    if not counts[:, 0].any() or not counts[:, 1].any():
        return None
    others = labelled.sparkSession.sparkContext.broadcast(counts[::-1].astype(np.float64))
    bins = 2 * SPAN * STEPS

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, bins), np.int64)
        for rows in batches:
            urls, n, label, fold = (column.to_pylist() for column in rows.columns)
            fold = np.array(fold, np.int64)
            scores = np.choose(fold, [_score(urls, others.value[f], order) for f in (0, 1)])
            place = np.clip(np.floor((scores + SPAN) * STEPS), 0, bins - 1).astype(np.int64)
            np.add.at(total, (np.array(label, np.int64), place), np.array(n, np.int64))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total.ravel()[some])], ["bin", "n"])

    rows = labelled.mapInArrow(histogram, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n"))
    found = rows.toArrow()
    total = np.zeros(2 * bins)
    total[found.column(0).to_numpy()] = found.column(1).to_numpy()
    allow, block = total.reshape(2, bins)
    # At edge b: accepted URLs in bins from b on, rejected ones below it.
    right = np.append(allow[::-1].cumsum()[::-1], 0) / allow.sum()
    right += np.append(0, block.cumsum()) / block.sum()
    best = np.flatnonzero(right >= right.max() - 1e-12)
    return float(best[len(best) // 2] / STEPS - SPAN)
