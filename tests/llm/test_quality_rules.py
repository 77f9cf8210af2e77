import math
import random
from collections import Counter

import regex
import xxhash
from pyspark.sql import functions as F

from starledger.llm import quality_rules as rules
from starledger.llm.queries import op7_quality_rules

SF = "/root/testdata/sf0.001"


def base(text):
    text = text or ""
    words = regex.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if regex.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)), len(covered), failed,
    )


def hashed(*parts):
    seed = 42
    for part in parts:
        seed = xxhash.xxh64_intdigest(part.encode(), seed)
    return (seed - (1 << 64) if seed >> 63 else seed) % rules.BUCKETS


def grams(text):
    tokens = regex.findall(rules.TOKEN, text or "")
    return [hashed(t) for t in tokens] + [hashed(a, b) for a, b in zip(tokens, tokens[1:])]


def brute(texts, trusted):
    raw = Counter(g for t in texts for g in grams(t))
    good = Counter(g for t in trusted for g in grams(t))
    r, g = raw.total() + rules.BUCKETS, good.total() + rules.BUCKETS
    weight = lambda b: round(math.log((good[b] + 1) / g / ((raw[b] + 1) / r)) * rules.SCALE)
    out = []
    for text in texts:
        found = [weight(b) for b in grams(text)]
        ratio = sum(found) / len(found) / rules.SCALE if found else None
        out.append((*base(text), not base(text)[-1] and (ratio is None or ratio >= rules.THRESHOLD)))
    return out


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    want = brute([d.text for d in docs], [d.text for d in docs if d.doc_id in good])
    got = op7_quality_rules(spark, SF).collect()
    assert sorted(map(tuple, got)) == sorted((d.doc_id, *w) for d, w in zip(docs, want))
    labels = dict(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality").collect())
    kept = {r.doc_id: r.kept for r in got if not r.base_failed and r.doc_id in labels}
    assert all(kept[i] for i in kept if labels[i] == 1) and not all(kept.values())


def test_nulls_empty_long_repeated_and_clashing_columns(spark):
    draw = random.Random(4)
    texts = [None, "", " \n\t", "a b c", "# | <x>\n\nq\nq\n q", "é " * 40, "w " * 50_000]
    texts += [" ".join(draw.choice("abc") for _ in range(draw.randrange(60))) for _ in range(40)]
    texts += texts[:8]
    docs = spark.createDataFrame([(i, t, "z", 1) for i, t in enumerate(texts)], "doc_id long, text string, ratio string, n_words int")
    rows = rules.judge(docs, docs.withColumn("trusted", F.col("doc_id") == 3))
    assert set(rows.columns) == {"doc_id", "text", *rules.BASE, "base_failed", "ratio", "kept"}
    got = {r.doc_id: r for r in rows.collect()}
    for i, want in enumerate(brute(texts, [texts[3]])):
        assert tuple(got[i][c] for c in [*rules.BASE, "base_failed", "kept"]) == want, texts[i]
    none = docs.withColumn("trusted", F.lit(None).cast("boolean"))
    assert rules.judge(docs.limit(0), none.limit(0)).count() == 0
    assert rules.judge(docs, none.limit(0)).count() == rules.judge(docs, none).count() == len(texts)


def test_columns_with_the_names_of_steps_are_kept(spark):
    names = ["_words", "_lines", "_hashes", "_windows", "_ordered", "_starts", "_tokens", "_weights", "key", "bucket", "tokens", "good"]
    docs = spark.createDataFrame([(1, "a b " * 30), (2, None)], "doc_id long, text string")
    wide = docs.select("*", *(F.col("doc_id").alias(name) for name in names))
    marked = F.col("doc_id") == 1
    plain = rules.judge(docs, docs.withColumn("trusted", marked))
    rows = rules.judge(wide, wide.withColumn("trusted", marked))
    assert rows.where(" or ".join(f"{name} != doc_id" for name in names)).count() == 0
    assert sorted(rows.select(plain.columns).collect()) == sorted(plain.collect())


def test_texts_are_judged_where_they_are_read(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    rows = rules.judge(docs, docs.withColumn("trusted", F.lit(True)))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    # The models come as a value, so the only shuffle is that of their fixed number of buckets.
    assert plan.count("Exchange SinglePartition") == 1 and "hashpartitioning" not in plan


def test_plans_run_no_python(spark):
    plan = op7_quality_rules(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
