"""One query per operator, with the columns of its contract, and SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from starledger.llm.common import table
from starledger.llm import bpe, minhash, quality_model, quality_rules
from starledger.llm.conversations import damage, repair
from starledger.llm.decontaminate import contaminated
from starledger.llm.filter_audit import audit, filter_failures
from starledger.llm.licenses import scan_licenses
from starledger.llm.secret_scan import BASE, RULES, find_secrets, span_text
from starledger.llm.simhash import near_duplicates
from starledger.llm.substring import without_repeats
from starledger.llm.url_filter import Rule, filter_urls
from starledger.llm.warc import ID_PREFIX, read_warc, write_warc


def op1_warc(spark: SparkSession, sf: str) -> DataFrame:
    records = read_warc(write_warc(table(spark, sf, "pages")), payloads=False)
    key = lambda name: F.expr(f"try_cast(replace({name}, '{ID_PREFIX}', '') as bigint)")
    return records.select(
        key("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        key("refers_to").alias("refers_to"),
        "verified",
    )


def op2_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(table(spark, sf, "documents"), shingle_words=4, max_bits=4)


def op3_substring(spark: SparkSession, sf: str) -> DataFrame:
    rows = without_repeats(table(spark, sf, "documents"), window=50)
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


#: The rules of op4.
URL_RULES = [
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
]


def op4_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return filter_urls(table(spark, sf, "pages"), URL_RULES)


def op5_licenses(spark: SparkSession, sf: str) -> DataFrame:
    return scan_licenses(table(spark, sf, "documents"))


def op6_quality_model(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = quality_model.fit(docs, table(spark, sf, "labels"))
    scored = quality_model.score(docs.select("doc_id", "text", "n_chars"), model)
    return scored.select(
        "doc_id",
        quality_model.held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op8_bpe(spark: SparkSession, sf: str) -> DataFrame:
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = table(spark, sf, "documents")
    return bpe.encode(docs, ranks, public_tokenizers.PATTERN, decoded=True).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op10_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    rows = find_secrets(table(spark, sf, "documents").select("doc_id", "text"))
    base = F.filter("secrets", lambda span: span["order"] < len(BASE))
    of = lambda kind: F.size(F.filter("secrets", lambda span: span["kind"] == kind)).cast("long")
    return rows.select(
        "doc_id",
        *(of(rule.kind).alias(f"n_{rule.kind}") for rule in BASE),
        F.sha2(span_text(base), 256).alias("base_sha256"),
        span_text(F.col("secrets")).alias("spans"),
    )


def op7_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    good = table(spark, sf, "labels").where("quality = 1").select("doc_id").distinct()
    # Labels grow with the documents: the join that suits them at any size.
    good = good.withColumn("trusted", F.lit(True)).hint("merge")
    rows = quality_rules.judge(docs, docs.join(good, "doc_id", "left"))
    return rows.select("doc_id", *quality_rules.BASE, "base_failed", "kept")


def op11_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf, "documents"), shingle_words=3, percent=85)


def op12_conversations(spark: SparkSession, sf: str) -> DataFrame:
    return repair(damage(table(spark, sf, "conversations")), copies="copies")


def op13_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    failures = filter_failures(table(spark, sf, "documents"))
    labels = table(spark, sf, "labels").where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    return audit(failures.join(labels, failures["id"] == labels["doc_id"], "left"))


_OP1 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT *, sha1(body) AS hex, max(page_id) OVER (PARTITION BY body) AS kept FROM p),
b AS (SELECT *, CAST(unhex(hex) AS BIT)::VARCHAR AS bits FROM d)
SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 160, 5), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + 16 * CAST(bits[i + 1] AS INT) + 8 * CAST(bits[i + 2] AS INT) + 4 * CAST(bits[i + 3] AS INT)
    + 2 * CAST(bits[i + 4] AS INT) + CAST(bits[i + 5] AS INT), 1)), '') AS payload_digest,
  CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> kept THEN kept END AS refers_to,
  CASE WHEN page_id = kept THEN TRUE END AS verified
FROM b
"""

#: Every window of 50 words by its words, and the places it covers where a smaller document has it.
_OP3 = """
WITH d AS (SELECT doc_id, row_number() OVER () AS copy, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
w AS (SELECT doc_id, copy, unnest(range(1, len(words) - 48)) AS start, words FROM d WHERE len(words) >= 50),
k AS (SELECT doc_id, copy, start, array_to_string(words[start:start + 49], ' ') AS said FROM w),
hit AS (SELECT copy, start FROM (SELECT *, min(doc_id) OVER (PARTITION BY said) AS first FROM k) WHERE doc_id > first),
gone AS (SELECT DISTINCT copy, start + i AS place FROM hit, range(50) covered(i)),
kept AS (SELECT copy, string_agg(word, ' ' ORDER BY place) AS kept, count(*) AS n
  FROM (SELECT copy, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM d) ANTI JOIN gone USING (copy, place) GROUP BY copy)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (copy)"""


def _op10() -> str:
    """Every rule in every text: gaps and matches in turn, their lengths summed to places."""
    parts = lambda rule, n: (
        f"unnest(regexp_extract_all(text, $$(?s)(.*?)({rule.pattern})$$, {n}))"
    )
    kinds = " UNION ALL ".join(
        f"SELECT doc_id, copy, {order} AS ord, '{rule.kind}' AS kind, {rule.least} AS least, {parts(rule, 1)} AS gap,"
        f" {parts(rule, 2)} AS hit, {parts(rule, 2 + rule.value)} AS val,"
        f" generate_subscripts(regexp_extract_all(text, $$(?s)(.*?)({rule.pattern})$$, 1), 1) AS n FROM d"
        for order, rule in enumerate(RULES)
    )
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS copy FROM documents),
m AS ({kinds}),
e AS (SELECT *, sum(length(gap) + length(hit)) OVER (PARTITION BY copy, ord ORDER BY n) AS e FROM m),
s AS (SELECT copy, ord, kind, CAST(e - length(hit) AS INT) AS a,
  kind || ':' || CAST(e - length(hit) AS INT) || ':' || CAST(e AS INT) AS span FROM e WHERE length(val) >= least)
SELECT any_value(d.doc_id) AS doc_id, count(*) FILTER (ord = 0) AS n_assign,
  count(*) FILTER (ord = 1) AS n_access, count(*) FILTER (ord = 2) AS n_hex,
  sha256(coalesce(string_agg(span, ',' ORDER BY a, ord) FILTER (ord < 3), '')) AS base_sha256,
  coalesce(string_agg(span, ',' ORDER BY a, ord), '') AS spans
FROM d LEFT JOIN s USING (copy) GROUP BY copy"""


#: All pairs of different sets that share a shingle.
_OP11 = """
WITH RECURSIVE w AS (SELECT row_number() OVER () AS copy, doc_id,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
d AS (SELECT copy, doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
  ELSE list_sort(list_distinct(list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i:i + 2], ' ')))) END AS shingles FROM w),
sets AS (SELECT shingles, len(shingles) AS n, row_number() OVER () AS s FROM d WHERE len(shingles) > 0 GROUP BY shingles),
e AS (SELECT s, n, unnest(shingles) AS shingle FROM sets),
links AS (SELECT a.s AS a, b.s AS b FROM e a JOIN e b ON a.shingle = b.shingle AND a.s < b.s
  AND 100 * a.n >= 85 * b.n AND 100 * b.n >= 85 * a.n
  GROUP BY a.s, b.s, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT s AS a, s AS b FROM sets UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON l.a = r.b),
firsts AS (SELECT s, min(doc_id) AS first FROM d JOIN sets USING (shingles) GROUP BY s),
classes AS (SELECT r.a AS s, min(f.first) AS component FROM reach r JOIN firsts f ON f.s = r.b GROUP BY r.a)
SELECT d.doc_id, CAST(len(d.shingles) AS BIGINT) AS n_shingles, CASE WHEN len(d.shingles) = 0 THEN d.doc_id ELSE c.component END AS component_id,
  coalesce(d.doc_id = CASE WHEN len(d.shingles) = 0 THEN d.doc_id ELSE c.component END, false) AS kept
FROM d LEFT JOIN sets ON sets.shingles = d.shingles LEFT JOIN classes c ON c.s = sets.s"""

#: Damage by a CRC-32 in bits; then every way to edit a turn from every state, turn by turn, of
#: which the least by cost and audit is kept.
_OP12 = """
WITH RECURSIVE raw AS (SELECT dense_rank() OVER (ORDER BY conv_id) AS conv, conv_id, turn, coalesce(role, ' ') AS role,
  coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS said
  FROM conversations),
kinds AS (SELECT *, xor(4294967295, list_reduce(
  list_transform(range(0, length(said) + 1), lambda i: CASE WHEN i = 0 THEN 4294967295 ELSE CAST(ascii(said[i]) AS BIGINT) END),
  lambda crc, byte: list_reduce([xor(crc, byte), 1, 2, 3, 4, 5, 6, 7, 8],
    lambda c, step: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)))) % 20 AS kind FROM raw),
damaged AS (SELECT conv, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
  CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM kinds, range(2) copy(n) WHERE kind <> 0 AND (n = 0 OR kind = 3)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
judged AS (SELECT *, left(role, 1) AS letter, lag(left(role, 1)) OVER (PARTITION BY conv ORDER BY i) AS before,
  CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
    WHEN i > min(i) OVER (PARTITION BY conv, role, text) THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 'truncated' ELSE '' END AS fault FROM numbered),
inserts(a, b, added, tag, put) AS (VALUES (0, 0, 0, '', []), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []),
  (0, 2, 2, 'I', ['user:']), (1, 2, 2, 'I', ['user:']), (3, 2, 2, 'I', ['user:']), (2, 3, 2, 'I', ['assistant:']),
  (0, 3, 4, 'II', ['user:', 'assistant:']), (1, 3, 4, 'II', ['user:', 'assistant:'])),
edits(b, c, price, name, letter, becomes) AS (VALUES (0, 0, 3, 'D', NULL, NULL), (1, 1, 3, 'D', NULL, NULL),
  (2, 2, 3, 'D', NULL, NULL), (3, 3, 3, 'D', NULL, NULL), (0, 1, 0, 'K', 's', NULL), (0, 2, 0, 'K', 'u', NULL),
  (1, 2, 0, 'K', 'u', NULL), (3, 2, 0, 'K', 'u', NULL), (2, 3, 0, 'K', 'a', NULL), (0, 2, 2, 'R', NULL, 'user'),
  (1, 2, 2, 'R', NULL, 'user'), (3, 2, 2, 'R', NULL, 'user'), (2, 3, 2, 'R', NULL, 'assistant')),
paths AS (SELECT DISTINCT conv, CAST(0 AS BIGINT) AS i, 0 AS state, {'cost': 0, 'audit': '', 'out': CAST([] AS VARCHAR[])} AS way FROM raw
  UNION ALL
  SELECT p.conv, p.i + 1, e.c, min({'cost': p.way.cost + n.added + e.price + CASE WHEN e.name <> 'D' AND j.fault = 'truncated' THEN 1 ELSE 0 END,
    'audit': p.way.audit || n.tag || e.name,
    'out': p.way.out || n.put || CASE WHEN e.name = 'D' THEN [] ELSE [coalesce(e.becomes, j.role) || ':' || j.text] END})
  FROM paths p JOIN judged j ON j.conv = p.conv AND j.i = p.i + 1 JOIN inserts n ON n.a = p.state JOIN edits e ON e.b = n.b
  WHERE (e.name = 'D' OR j.fault NOT IN ('blank', 'duplicate')) AND (e.letter IS NULL OR e.letter = j.letter)
  GROUP BY p.conv, p.i, e.c),
counts AS (SELECT conv, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
  count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
  count(*) FILTER (fault = 'truncated') AS truncated,
  count(*) FILTER (before IS NOT NULL AND before || letter NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv),
ends AS (SELECT p.conv, min({'cost': p.way.cost + n.added, 'audit': p.way.audit || n.tag, 'out': p.way.out || n.put}) AS way
  FROM paths p LEFT JOIN counts c ON c.conv = p.conv JOIN inserts n ON n.a = p.state
  WHERE p.i = coalesce(c.n, 0) AND n.b IN (0, 3) GROUP BY p.conv)
SELECT r.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(e.way.cost AS BIGINT) AS cost, e.way.audit AS audit,
  sha256(array_to_string(e.way.out, chr(10))) AS repaired_sha256
FROM (SELECT DISTINCT conv, conv_id FROM raw) r JOIN ends e ON e.conv = r.conv LEFT JOIN counts c ON c.conv = r.conv"""

_OP13 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS part,
  regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
  CASE WHEN len(words) < 50 THEN 'A' ELSE '' END
  || CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END
  || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 'C' ELSE '' END
  || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
  || CASE WHEN d.doc_id > min(d.doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS failed
  FROM d LEFT JOIN l USING (doc_id)),
n AS (SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY ALL),
c AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM c a, c b, c, c d, c e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, CAST(step AS INT) AS step, filter_order[step] AS filter,
  '[' || filter_order[1:step - 1] || '-]' AS before FROM o, range(1, 6) r(step)),
t AS (SELECT part, filter_order, step, filter,
  sum(n) FILTER (NOT regexp_matches(failed, before) AND NOT contains(failed, filter)) AS kept,
  sum(n) FILTER (NOT regexp_matches(failed, before) AND contains(failed, filter)) AS removed,
  sum(n) FILTER (regexp_matches(failed, before) AND contains(failed, filter)) AS redundant,
  sum(n) FILTER (failed = filter) AS unique_fails,
  sum(good) FILTER (NOT regexp_matches(failed, before) AND contains(failed, filter)) AS good_lost,
  sum(toxic) FILTER (NOT regexp_matches(failed, before) AND contains(failed, filter)) AS toxic_lost
  FROM n, s GROUP BY ALL)
SELECT part, filter_order, step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
  CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(coalesce(sum(removed) OVER (PARTITION BY part, filter), 0) AS BIGINT) AS shapley
FROM t"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_warc,
        op2_simhash,
        op3_substring,
        op4_url_filter,
        op5_licenses,
        op6_quality_model,
        op7_quality_rules,
        op8_bpe,
        op9_decontaminate,
        op10_secret_scan,
        op11_minhash,
        op12_conversations,
        op13_filter_audit,
    )
    return {query.__name__: query for query in found}


def oracle_sql() -> dict[str, str]:
    return {"op1_warc": _OP1, "op3_substring": _OP3, "op10_secret_scan": _op10(), "op11_minhash": _OP11, "op12_conversations": _OP12, "op13_filter_audit": _OP13}
