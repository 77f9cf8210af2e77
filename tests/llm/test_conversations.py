import hashlib
import random
import re
import zlib
from functools import cache

from oracle import connect, difference
from starledger.llm import queries
from starledger.llm.conversations import damage, repair

SF = "/root/testdata/sf0.001"
EMPTY = hashlib.sha256(b"").hexdigest()


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        said = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{said(conv)}:{said(turn)}".encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", said(text))}.get(kind, said(text))
        copy = (conv, turn, "user" if kind == 4 else said(role), text)
        out += [copy] * {0: 0, 3: 2}.get(kind, 1)
    return out


def plain(turns):
    """Faults and the cheapest repair of (turn, role, text), by a search over all edits."""
    turns = sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
    faults, seen = [], set()
    for _, role, text in turns:
        told = text.rstrip("\t\n\x0b\x0c\r ")
        fault = "duplicate" if (role, text) in seen else "" if told[-1:] in (".", "!", "?") else "truncated"
        faults.append("blank" if not told else fault)
        seen.add((role, text))
    follows = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    roles = {"u": "user", "a": "assistant"}

    @cache
    def best(i, state, inserted):
        options = [(0, "", ())] if i == len(turns) and state in ("", "a") else []
        if inserted < 2:
            for letter, role in roles.items():
                if (state, letter) in follows:
                    cost, audit, out = best(i, follows[state, letter], inserted + 1)
                    options.append((cost + 2, "I" + audit, (f"{role}:", *out)))
        if i < len(turns):
            _, role, text = turns[i]
            cost, audit, out = best(i + 1, state, 0)
            options.append((cost + 3, "D" + audit, out))
            if faults[i] in ("", "truncated"):
                for edit, price, new in [("K", 0, role)] + [("R", 2, r) for r in roles.values()]:
                    if (state, new[:1]) in follows:
                        cost, audit, out = best(i + 1, follows[state, new[:1]], 0)
                        price += faults[i] == "truncated"
                        options.append((cost + price, edit + audit, (f"{new}:{text}", *out)))
        return min(options) if options else (10**9, "", ())

    numbers = {t[0] for t in turns} - {None}
    cost, audit, out = best(0, "", 0)
    return (
        max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:])),
        cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest(),
    )


def expected(original, rows):
    return sorted(((c, *plain([r[1:] for r in rows if r[0] == c])) for c in {r[0] for r in original}), key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_query_equals_sql(spark):
    for folder in (SF, "/root/testdata/sf0.01"):
        df = queries.op12_conversations(spark, folder)
        assert difference(df, connect(folder), queries.oracle_sql()["op12_conversations"]) is None


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").collect()]
    assert got(queries.op12_conversations(spark, "/root/testdata/sf0.01")) == expected(rows, damaged(rows))


def test_any_turns_equal_brute_force(spark):
    draw = random.Random(7)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", "unknown", "é"]
    texts = ["Yes.", "No!", "so", "", " \t\n", "end. \n", "end ", "é?", "a. b"]
    rows = []
    for conv in range(400):
        for turn in range(draw.randrange(1, 9)):
            rows.append((conv, draw.choice([turn, turn, None, 5]), draw.choice(roles), draw.choice(texts) + draw.choice(["", str(turn) + "."])))
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    assert got(repair(df)) == expected(rows, rows)
    # Small batches, and conversations that are spilled in the middle.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        assert got(repair(df, spill_turns=2)) == expected(rows, rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_nulls_empty_repeated_clashing(spark):
    rows = [(1, 0, None, None), (None, None, "user", "Hi."), (None, 1, "assistant", "Yes."), (2, None, "user", "A."),
            (2, None, "user", "A."), (2, 3, "assistant", "B."), (3, 1, "user", None), (4, 7, "", "x.")]
    clash = [(*r, "c", "d", "r", 3) for r in rows]
    df = spark.createDataFrame(clash, "conv_id int, turn long, role string, text string, conv string, said string, repeats string, copies int")
    spaced = [(c, t, r or (" " if r is None else ""), " " if x is None else x) for c, t, r, x in rows]
    assert got(repair(df)) == expected(rows, spaced)
    assert got(repair(damage(df), copies="copies")) == expected(rows, damaged(rows))
    gone = repair(df.withColumn("copies", df.copies * 0), copies="copies")
    assert got(gone) == sorted(((c, 0, 0, 0, 0, 0, 0, "", EMPTY) for c in (1, None, 2, 3, 4)), key=str)
    named = df.selectExpr("cast(conv_id as string) as thread", "turn as n", "role as who", "text as body")
    assert [r.audit for r in repair(named, "thread", "n", "who", "body").orderBy("thread").collect()] == ["KK", "D", "KDK", "D", "D"]
    assert repair(df.limit(0)).count() == 0


def test_giant_conversation_with_long_texts(spark):
    n = 60_000
    df = spark.range(n, numPartitions=4).selectExpr(
        "1 as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role",
        "concat(id, if(id = 5, repeat(' word', 400000), ''), if(id % 1000 = 7, '', '.')) as text",
    ).where("turn != 30000")
    row = repair(df, spill_turns=1 << 12).first()
    # An inserted user turn is cheaper than leaving a turn out.
    assert (row.gaps, row.truncated, row.illegal, row.cost) == (1, 60, 1, 62)
    assert row.audit == "K" * 30_000 + "I" + "K" * 29_999
    text = lambda i: str(i) + " word" * (400_000 * (i == 5)) + ("" if i % 1000 == 7 else ".")
    said = [f"{'user' if i % 2 == 0 else 'assistant'}:{text(i) if i != 30000 else ''}" for i in range(n)]
    assert row.repaired_sha256 == hashlib.sha256("\n".join(said).encode()).hexdigest()
