import hashlib
import re

import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from starledger.llm import quality_model, secret_scan
from starledger.llm.bpe import load_ranks
from starledger.llm.decontaminate import contaminated
from tests.llm.test_simhash import expected as groups_of

SF = "/root/testdata/sf0.001"


def redacted(text):
    spans = sorted(
        (m.start(), m.end()) for rule in secret_scan.RULES for m in re.finditer(rule.pattern, text)
        if len(m[rule.value]) >= rule.least
    )
    out, at = "", 0
    for a, b in spans:
        out += text[at:a] + "[SECRET]" if a >= at else ""
        at = max(at, b)
    return out + text[at:]


def test_run_equals_brute_force_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = dict(docs.select("doc_id", "text").collect())
    model = quality_model.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = quality_model.score(docs, model).select("doc_id", "score").collect()
    good = [(r.doc_id, texts[r.doc_id]) for r in scores if r.score >= 0.3]
    one = [i for i, _, component in groups_of(good) if i == component]
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    leaks = {r.doc_id for r in contaminated(docs.where(F.col("doc_id").isin(one)), items).collect()}
    coder = tiktoken.Encoding(
        "whole", pat_str=public_tokenizers.PATTERN, special_tokens={},
        mergeable_ranks=load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")),
    )
    want = {}
    for i in set(one) - leaks:
        text = redacted(texts[i])
        want[i] = (np.array(coder.encode_ordinary(text), "<u4").tobytes(), hashlib.sha256(text.encode()).hexdigest())
    got = {r.doc_id: (bytes(r.ids), r.decoded_sha256) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want
    assert 0 < len(want) < len(one) < len(good) < len(texts)


def test_stages_take_nulls_repeats_clashes_and_nothing(spark):
    rows = [(1, None, None, None, None), (1, None, None, None, None), (2, "", "en", "s", 0), (None, "a b c", None, "s", 5),
            (3, "token = 'abcdefghijkl0'", "en", None, 9), (3, "token = 'abcdefghijkl0'", "en", None, 9)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(*r, 1.0, 2) for r in rows], f"{schema}, score double, root int")
    for frame in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, frame, SF)
            assert out.columns == corpus_pipeline.COLUMNS, name
            kept = out.collect()
            if name == "simhash_near_dedup" and frame is docs:
                assert sorted((r.doc_id for r in kept), key=str) == [1, 3, None]
            if name == "secret_scan" and frame is docs:
                assert {(r.text, r.n_chars) for r in kept if r.doc_id == 3} == {("[SECRET]'", 9)}
        assert corpus_pipeline.STAGES[-1][1](spark, frame, SF).count() == frame.count()
