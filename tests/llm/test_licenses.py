import random
import re

import pytest

from starledger.llm import licenses
from starledger.llm.licenses import TEMPLATES, scan_licenses
from starledger.llm.queries import op5_licenses


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def shingles(found):
    return [tuple(found[i : i + 5]) for i in range(len(found) - 4)]


def brute(rows, templates=TEMPLATES):
    """Every window against every template of its class, without min-hashes."""
    out = {}
    for i, text in rows:
        held = shingles(words(text))
        for name, template in templates.items():
            own = set(shingles(words(template)))
            length = 8
            while length < len(words(template)):
                length *= 2
            for start in range(0, max(1, len(held)), length // 2):
                share = len(own & set(held[start : start + length + length // 2 - 4])) / len(own)
                if share >= 0.8:
                    key = (i, text, name)
                    out[key] = max(out.get(key, (0, 0)), (share, -start))
    return sorted(((i, name, s, -b) for (i, _, name), (s, b) in out.items()), key=str)


def got(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    want = brute(map(tuple, rows))
    assert got(op5_licenses(spark, folder)) == want and len({name for _, name, _, _ in want}) >= 4


def test_changed_templates_at_any_place(spark):
    draw = random.Random(8)
    rows = []
    for i in range(150):
        name = draw.choice(list(TEMPLATES))
        notice = TEMPLATES[name].split()
        if len(notice) > 20:
            notice[draw.randrange(len(notice))] = "changed"
        body = [f"w{draw.randrange(50)}" for _ in range(draw.randrange(60))]
        rows.append((i, " ".join(body + notice + body[:7]).replace("License", draw.choice(["LICENSE", "License"]))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert got(scan_licenses(docs)) == want and len(want) >= 150


def test_nulls_empty_long_repeated_and_clashing_columns(spark):
    mit = TEMPLATES["MIT"]
    rows = [(1, None), (2, ""), (None, mit), (3, mit), (3, mit), (4, "a b c d"), (5, "é " * 200_000 + mit), (6, mit.upper())]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, start int")
    assert got(scan_licenses(docs)) == brute(rows)
    assert scan_licenses(docs.limit(0)).count() == 0
    two = {"one": mit, "two": mit}
    assert {r.license for r in scan_licenses(docs, two).collect()} == {"one", "two"}
    with pytest.raises(ValueError):
        scan_licenses(docs, {"short": "MIT License"})


def test_plan_runs_no_python(spark):
    plan = op5_licenses(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Cartesian"))
