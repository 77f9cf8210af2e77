import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from starledger.llm import quality_model
from starledger.llm.queries import op6_quality_model

SF = "/root/testdata/sf0.01"


def test_identity_equals_all_pairs():
    draw = np.random.default_rng(0)
    model = quality_model.Model(0.3, draw.normal(size=20), draw.normal(size=(20, 3)))
    feature, value = np.array([1, 5, 7, 2, 5]), np.array([0.5, 1.0, 2.0, 1.0, 3.0])
    got = quality_model._margins(model, np.array([0, 3]), feature, value)
    for margin, part in zip(got, (slice(0, 3), slice(3, 5))):
        pairs = itertools.combinations(zip(feature[part], value[part]), 2)
        want = model.bias + (model.weights[feature[part]] * value[part]).sum()
        want += sum(model.vectors[i] @ model.vectors[j] * x * y for (i, x), (j, y) in pairs)
        assert margin == pytest.approx(want)


def test_query_tells_held_out_quality_apart(spark):
    rows = op6_quality_model(spark, SF).collect()
    ids = [r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(r.doc_id for r in rows) == sorted(ids)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    labels = dict(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality").collect())
    judged = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert all(predicted for label, predicted in judged if label == 1)
    bad = [predicted for label, predicted in judged if label == 0]
    assert sum(bad) <= 0.25 * len(bad)


def test_nulls_empty_long_repeated_and_clashing_columns(spark):
    long = "word " * 1_000_000
    rows = [(1, None, 0), (2, "", 1), (None, "a b", 1), (3, long, 1), (3, long, 1), (4, "x", None), (6, "y z", 0)]
    docs = spark.createDataFrame([(i, t, 7.0, "q") for i, t, _ in rows], "doc_id long, text string, score double, quality string")
    labels = spark.createDataFrame([(i, q, "t") for i, _, q in rows], "doc_id long, quality int, text string")
    model = quality_model.fit(docs, labels)
    got = quality_model.score(docs, model)
    assert got.columns == ["doc_id", "text", "quality", "score"]
    scores = got.select("doc_id", "score").collect()
    assert len(scores) == 7 and all(0 <= r.score <= 1 for r in scores)
    assert len({r.score for r in scores if r.doc_id == 3}) == 1
    assert quality_model.score(docs.limit(0), model).count() == 0
    untaught = quality_model.fit(docs, labels.limit(0))
    assert {r.score for r in quality_model.score(docs, untaught).collect()} == {0.5}


def test_sample_is_bounded(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    few = quality_model.fit(docs, labels, sample_rows=5)
    assert (few.weights != 0).sum() < (quality_model.fit(docs, labels).weights != 0).sum()
