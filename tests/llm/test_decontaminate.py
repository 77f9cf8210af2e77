import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from starledger.llm import decontaminate
from starledger.llm.decontaminate import contaminated, without_copies
from starledger.llm.queries import op9_decontaminate

SF = "/root/testdata/sf0.01"


def words(text):
    return (text or "").lower().encode().translate(decontaminate._PARTS).split()


def plain_score(a, b):
    rows = [[0] * (len(b) + 1)]
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(max(0, rows[-1][j] + (2 if x == y else -1), rows[-1][j + 1] - 1, row[-1] - 1))
        rows.append(row)
    return max(map(max, rows))


def test_alignment_equals_plain_tables():
    draw = random.Random(5)
    for _ in range(200):
        a, b = ([draw.randrange(4) for _ in range(draw.randrange(1, 14))] for _ in range(2))
        assert decontaminate.align(np.array(a), np.array(b))[0] == plain_score(a, b)


def test_query_equals_aligning_everything(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()
    # Whole documents aligned with whole items, all with all.
    want = set()
    code = {}
    numbers = lambda text: np.array([code.setdefault(w, len(code)) for w in words(text)], np.int64)
    coded = [(i.item_id, numbers(i.text)) for i in items]
    for doc in docs:
        text = numbers(doc.text)
        for item, want_words in coded:
            score = decontaminate.align(want_words, text)[0]
            if score >= 2 * min(0.6 * len(want_words), 13):
                want.add((doc.doc_id, item, score / (2 * len(want_words))))
    got = {tuple(r)[:3] for r in op9_decontaminate(spark, "/root/testdata/sf0.001").collect()}
    assert got == want and want


def test_edited_copies_are_found_and_others_left(spark):
    draw = random.Random(3)
    vocabulary = [f"w{i}" for i in range(5000)] + ["the", "of"] * 1000
    texts = [[draw.choice(vocabulary) for _ in range(40)] for _ in range(30)]
    items = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "item_id long, text string")
    rows, copies = [], set()
    for n in range(60):
        body = [draw.choice(vocabulary) for _ in range(300)]
        if n % 2:
            copy = list(texts[n // 2])
            for at in range(3, 40, 8):
                copy[at : at + 1] = draw.choice(([], ["other"], ["two", "more"]))
            body[100:100] = [w.title() + draw.choice(["", ",", "\n"]) for w in copy]
            copies.add((n, n // 2))
        rows.append((n, " ".join(body), n))
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id long")
    found = contaminated(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in found} == copies
    assert all(95 <= r.start <= 110 and 130 <= r.end <= 150 for r in found)
    kept = without_copies(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == list(range(0, 60, 2))


@pytest.mark.parametrize("every", [3, 4, 5])
@pytest.mark.parametrize("elsewhere", [False, True])
def test_recall_of_edited_copies_against_aligning_everything(spark, every, elsewhere):
    draw = random.Random(17)
    vocabulary = [f"v{i}" for i in range(3000)] + ["the", "of", "and", "in"] * 400
    texts = [[draw.choice(vocabulary) for _ in range(draw.randrange(20, 60))] for _ in range(30)]
    rows = []
    for text in texts:
        for edit in ("replace", "insert", "delete"):
            copy = []
            for at, word in enumerate(text):
                changed = at % every == every - 1
                copy += {"replace": [f"x{at}"], "insert": [word, f"x{at}"], "delete": []}[edit] if changed else [word]
            rows.append([draw.choice(vocabulary) for _ in range(80)] + copy + [draw.choice(vocabulary) for _ in range(80)])
        if elsewhere:
            rows += [[draw.choice(vocabulary) for _ in range(50)] + text for _ in range(15)]
    rows += [[draw.choice(vocabulary) for _ in range(300)] for _ in range(40)]
    code = {}
    numbers = lambda text: np.array([code.setdefault(w, len(code)) for w in text], np.int64)
    coded = [numbers(text) for text in texts]
    want = set()
    for n, row in enumerate(rows):
        for item, words_of_item in enumerate(coded):
            score = decontaminate.align(words_of_item, numbers(row))[0]
            if score >= 2 * min(0.6 * len(words_of_item), 13):
                want.add((n, item, score / (2 * len(words_of_item))))
    docs = spark.createDataFrame([(n, " ".join(row)) for n, row in enumerate(rows)], "doc_id long, text string")
    items = spark.createDataFrame([(n, " ".join(text)) for n, text in enumerate(texts)], "item_id long, text string")
    got = {tuple(r)[:3] for r in contaminated(docs, items).collect()}
    assert got <= want and len(want) >= 80
    assert len(got) >= 0.98 * len(want)


def test_the_number_of_jobs_does_not_grow_with_the_items(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    scans = []
    for copies in (items, items.union(items).union(items)):
        jobs = spark.sparkContext._jsc.sc().dagScheduler().nextJobId
        before = jobs()
        without_copies(docs, copies).count()
        scans.append(jobs() - before)
    assert scans[0] == scans[1]


def test_columns_of_any_name_are_kept(spark):
    names = ["key", "seeds", "number", "body", "score", "id", "_key"]
    passage = " ".join(f"alpha{i}" for i in range(20))
    docs = spark.createDataFrame([(1, passage, *names), (2, "other", *names)],
                                 f"doc_id long, text string, {', '.join(f'{n} string' for n in names)}")
    items = spark.createDataFrame([(5, passage, "k")], "item_id long, text string, number string")
    kept = without_copies(docs, items)
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [(2, "other", *names)]
    assert [(r.doc_id, r.item_id) for r in contaminated(docs, items).collect()] == [(1, 5)]


def test_nulls_empty_long_repeated(spark):
    passage = "alpha beta gamma delta epsilon zeta eta theta"
    rows = [(1, None), (2, ""), (None, passage), (3, passage), (3, passage), (4, "x " * 500_000 + passage)]
    docs = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, score string")
    items = spark.createDataFrame(
        [(1, passage), (2, passage), (3, None), (4, ""), (5, "alpha beta"), (None, passage)],
        "item_id int, text string",
    )
    found = contaminated(docs, items).collect()
    got = sorted(((r.doc_id, r.item_id, r.score) for r in found), key=str)
    assert got == sorted(((d, i, 1.0) for d in (None, 3, 3, 4) for i in (1, 2, None)), key=str)
    assert sorted(r.doc_id for r in without_copies(docs, items).collect()) == [1, 2]
    assert contaminated(docs.limit(0), items).count() == 0
    assert contaminated(docs, items.limit(0)).count() == 0
    assert without_copies(docs, items.limit(0)).count() == 6


def test_every_surviving_ngram_is_a_seed(spark):
    draw = random.Random(11)
    vocabulary = [f"v{i}" for i in range(3000)] + ["the", "of", "and"] * 300
    texts = [[draw.choice(vocabulary) for _ in range(40)] for _ in range(24)]
    rows, edited = [], set()
    for n, text in enumerate(texts):
        copy = list(text)
        for at in range(n % 3, 40, 4 + n % 2):
            copy[at] = f"other{n}x{at}"
        body = [draw.choice(vocabulary) for _ in range(200)]
        rows.append((n, " ".join(body[:100] + copy + body[100:])))
        edited.add((n, n))
        if n % 4 > 1:  # an exact copy elsewhere
            rows.append((100 + n, " ".join(body[50:] + text)))
    # Words put in between, more than a quarter of the item's, and words before all n-grams.
    rows.append((200, " ".join(texts[0][:9] + ["more"] * 15 + texts[0][9:10] + texts[0][12:13] + texts[0][14:20])))
    # All its n-grams are in many documents.
    rows += [(300 + k, " ".join(texts[1][3 * (k % 9) : 3 * (k % 9) + 5])) for k in range(90)]

    code = {}
    numbers = lambda text: np.array([code.setdefault(w, len(code)) for w in words(text)], np.int64)
    grams = lambda x: {tuple(x[i : i + 3]) for i in range(len(x) - 2)}
    want = set()
    for row, text in rows:
        for item, item_words in enumerate(texts):
            a, b = numbers(" ".join(item_words)), numbers(text)
            score = decontaminate.align(a, b)[0]
            if grams(a) & grams(b) and score >= 2 * min(0.6 * len(a), 13):
                want.add((row, item, score / (2 * len(a))))
    assert edited <= {w[:2] for w in want}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "item_id long, text string")
    assert {tuple(r)[:3] for r in contaminated(docs, items).collect()} == want
    kept = {r.doc_id for r in without_copies(docs, items).collect()}
    assert kept == {row for row, _ in rows} - {w[0] for w in want}


def test_words_are_parted_at_every_script_s_spaces_and_marks_of_punctuation(spark):
    plain = "alpha beta gamma délta epsilon zeta eta thëta iota kappa lambda my"
    indic = "हिन्दी में लिखा हुआ एक छोटा सा वाक्य यहाँ है"
    web = " ".join(plain.split())
    quoted = "—".join(f"“{word}”" for word in plain.split())
    rows = [(1, f"before {web}　after"), (2, quoted), (3, plain.upper()), (4, "…".join(indic.split())), (5, "none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for texts in ((plain, indic), (web, indic), (quoted, " ".join(indic.split()))):
        items = spark.createDataFrame(list(enumerate(texts)), "item_id int, text string")
        found = {(r.doc_id, r.item_id, r.score, r.start, r.end) for r in contaminated(docs, items).collect()}
        assert found == {(1, 0, 1.0, 1, 13), (2, 0, 1.0, 0, 12), (3, 0, 1.0, 0, 12), (4, 1, 1.0, 0, 10)}
        assert [r.doc_id for r in without_copies(docs, items).collect()] == [5]
