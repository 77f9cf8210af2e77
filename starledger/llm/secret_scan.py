"""Secret scans with a trigram inverted index, in DataFrame functions only.

From each rule's regular expression follows a Boolean query: which sets of three-character
pieces (of the lower-cased text) a match cannot do without. The index lists, for every trigram
that some rule asks for, the texts that contain it; intersecting the lists gives each rule's
candidates, and only these are searched with the expression. A rule without a trigram that
every match has is searched in all texts.

The index is keyed by a hash of the text, so copies share their entries; texts whose hashes
meet only share candidates, which are verified anyway.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from starledger.llm.common import stored, unused


class Rule(NamedTuple):
    """Matches of ``pattern`` whose group ``value`` (0: the match) has ``least`` characters.

    The pattern is Java's; it matches one character at least. ``trigram_query`` reads literals,
    sets, groups, alternatives and repetitions; a rule with anything else is searched in all texts.
    """

    kind: str
    pattern: str
    value: int = 0
    least: int = 1


#: The base rules, in their order.
BASE = [
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        value=2,
        least=12,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    Rule("hex", r"[0-9a-f]+", least=16),
]
#: Forms of published tokens and keys.
ADDED = [
    Rule("private", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
]
RULES = BASE + ADDED

_MOST_ALTERNATIVES, _MOST_LETTERS = 64, 6
#: Trigrams of a set that are looked for in the texts.
_ASKED = 2
#: Values whose running total is made at a time, and code points of a text that are cut at a time.
_STEP, _CUT = 256, 4096


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Sets of trigrams of which every match has one whole set; None if there is nothing."""
    try:
        ways, at = _alternatives(pattern, 0)
    except (_Unread, IndexError):
        return None
    if at < len(pattern):
        return None
    states = _runs([(1, 1, ways)], {((), "")})
    if states is None:
        return None
    sets = {
        frozenset(run[i : i + 3] for run in (*done, last) for i in range(len(run) - 2))
        for done, last in states
    }
    if frozenset() in sets:
        return None
    return sorted((s for s in sets if not any(other < s for other in sets)), key=sorted)


class _Unread(Exception):
    """Something in a pattern that no trigrams are derived from."""


# A pattern is a list of pieces: least and most repetitions (None: any), and what is repeated: a
# set of letters, None for too many of them, or a list of alternative patterns.


def _alternatives(pattern: str, at: int) -> tuple[list, int]:
    """The alternatives from a place to the end of the group, and where that is."""
    ways: list = [[]]
    while at < len(pattern) and pattern[at] != ")":
        if pattern[at] == "|":
            ways.append([])
            at += 1
            continue
        piece, at = _piece(pattern, at)
        least, most, at = _repetition(pattern, at)
        ways[-1].append((least, most, piece))
    return ways, at


def _piece(pattern: str, at: int):
    if pattern[at] == "(":
        opening = re.compile(r"\(\?i?:|\((?!\?)").match(pattern, at)
        if opening is None:
            raise _Unread
        ways, at = _alternatives(pattern, opening.end())
        if pattern[at] != ")":
            raise _Unread
        return ways, at + 1
    if pattern[at] == "[":
        return _set(pattern, at + 1)
    if pattern[at] in "^$*+?{":
        raise _Unread
    if pattern[at] == ".":
        return None, at + 1
    return _letter(pattern, at)


def _letter(pattern: str, at: int):
    """The letter, or None for a class of letters, and the place after it."""
    if pattern[at] != "\\":
        return {pattern[at].lower()}, at + 1
    code = re.compile(r"\\(?:x([0-9A-Fa-f]{2})|([^A-Za-z0-9])|([dDwWsS]))").match(pattern, at)
    if code is None:
        raise _Unread
    if code[3]:
        return None, code.end()
    return {(chr(int(code[1], 16)) if code[1] else code[2]).lower()}, code.end()


def _set(pattern: str, at: int):
    """The letters of a set if they are a few, each named, and the place after it."""
    letters: set | None = set()
    if pattern[at] == "^":
        letters, at = None, at + 1
    first = at
    while pattern[at] != "]" or at == first:
        if pattern[at] == "[" or pattern.startswith("&&", at):
            raise _Unread
        if pattern[at] == "-" and at != first and pattern[at + 1] != "]":
            letters, at = None, at + 1  # a range
            continue
        more, at = _letter(pattern, at)
        letters = None if letters is None or more is None else letters | more
    return letters if letters is None or len(letters) <= _MOST_LETTERS else None, at + 1


def _repetition(pattern: str, at: int) -> tuple[int, int | None, int]:
    found = re.compile(r"(?:([*+?])|\{(\d+)(,?)(\d*)\})[?+]?").match(pattern, at)
    if found is None:
        return 1, 1, at
    if found[1]:
        least, most = {"*": (0, None), "+": (1, None), "?": (0, 1)}[found[1]]
    else:
        least = int(found[2])
        most = int(found[4]) if found[4] else None if found[3] else least
    return least, most, found.end()


def _runs(pieces: list, states: set | None) -> set | None:
    """Ways to pass the pieces: literal runs that are complete, and the one still going on."""
    close = lambda ways: {((*done, last) if len(last) > 2 else done, "") for done, last in ways}
    for least, most, piece in pieces:
        if states is None:
            return None
        if len(states) > _MOST_ALTERNATIVES:
            return close(states)  # what follows is not asked for
        if piece is None:
            states = close(states)
            continue
        if isinstance(piece, set):
            once = {(done, last + c) for done, last in states for c in piece}
        else:
            ways = [_runs(branch, states) for branch in piece]
            once = None if None in ways else set().union(*ways)
        if (least, most) == (1, 1):
            states = once
        elif (least, most) == (0, 1):
            states = None if once is None else states | once
        else:
            states = once if least else states
            states = None if states is None else close(states)
    return states


def asked(rules: list[Rule]) -> dict[str, list[frozenset[str]]]:
    """Of each rule with a query, its sets of trigrams, of each set those to look up.

    A match needs all trigrams of a set, so any of them are a query as well, and the more sets
    share one, the fewer have to be looked for in every text.
    """
    queries = {rule.kind: trigram_query(rule.pattern) or [] for rule in rules}
    uses = Counter(t for sets in queries.values() for s in sets for t in s)
    few = lambda s: frozenset(sorted(s, key=lambda t: (-uses[t], t))[:_ASKED])
    return {kind: list(dict.fromkeys(map(few, sets))) for kind, sets in queries.items()}


def trigram_index(docs: DataFrame, rules: list[Rule] = RULES, text: str = "text") -> DataFrame:
    """Postings: ``trigram`` and ``key`` (of a text), each once, of the rules' trigrams."""
    trigrams = sorted({t for sets in asked(rules).values() for s in sets for t in s})
    low = F.lower("text")
    lists = F.array_compact(F.array(*(F.when(low.contains(t), F.lit(t)) for t in trigrams)))
    rows = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.select(_key("text").alias("key"), F.explode(lists).alias("trigram"))
    return rows.distinct()


def candidates(index: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """``key`` and ``kinds``: the rules that may match the text, of those that ask the index."""
    query = [
        (t, kind, number, len(s))
        for kind, sets in asked(rules).items()
        for number, s in enumerate(sets)
        for t in sorted(s)
    ]
    # As many rows as the rules have trigrams.
    query = index.sparkSession.createDataFrame(query, "trigram string, kind string, way int, size int")
    together = index.join(F.broadcast(query), "trigram").groupBy("key", "kind", "way", "size").count()
    return together.where("count = size").groupBy("key").agg(F.collect_set("kind").alias("kinds"))


def find_secrets(docs: DataFrame, rules: list[Rule] = RULES, text: str = "text") -> DataFrame:
    """The rows with ``secrets``: spans ``start``, ``order``, ``kind``, ``end`` of each match.

    Per rule, matches are leftmost and do not overlap; one whose value is too short is dropped
    but still passed over. Places are code points, the end exclusive, in the order of start
    and rule. A null or empty text has no secrets. Repeated rows are searched each; a column
    ``secrets`` is replaced, others are kept whatever their names.
    """
    docs = docs.drop("secrets")
    key, kinds = unused(docs, "key"), unused(docs, "kinds")
    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    indexed = [rule for rule in rules if queries[rule.kind] is not None]
    kept = docs.withColumn(key, _key(F.coalesce(F.col(text), F.lit(""))))
    # Stored, so that its size is known when the join is planned: texts that may hold secrets are few.
    found = stored(candidates(trigram_index(docs, indexed, text), indexed), "secret-candidates")
    rows = kept.join(found.withColumnsRenamed({"key": key, "kinds": kinds}), key, "left")
    spans = []
    for order, rule in enumerate(rules):
        asked = F.lit(True) if queries[rule.kind] is None else F.array_contains(kinds, rule.kind)
        spans.append(_spans(rule, order, F.col(text), asked))
    return rows.withColumn("secrets", F.array_sort(F.concat(*spans))).drop(key, kinds)


def _key(text) -> Column:
    return F.xxhash64(text)


def _spans(rule: Rule, order: int, text: Column, asked: Column) -> Column:
    """Spans of a rule's matches in the texts where it is asked for and matches at all.

    Texts are read as gap and match in turn, each found where the last one ended, so that the
    lengths of gaps and matches add up to places.
    """
    pair = rf"(?s)\G(.*?)({rule.pattern})"
    part = lambda group: F.regexp_extract_all(text, F.lit(pair), F.lit(group))
    parts = F.arrays_zip(
        part(1).alias("gap"), part(2).alias("match"), part(2 + rule.value).alias("value")
    )
    none = F.expr("cast(array() as array<struct<start: int, order: int, kind: string, end: int>>)")

    def with_ends(matches: Column) -> Column:
        lengths = F.transform(matches, lambda x: F.length(x["gap"]) + F.length(x["match"]))
        placed = F.arrays_zip(matches.alias("x"), _running(lengths, lambda a, b: a + b).alias("end"))
        placed = F.filter(placed, lambda p: F.length(p["x"]["value"]) >= rule.least)
        return F.transform(placed, lambda p: F.struct(
            (p["end"] - F.length(p["x"]["match"])).alias("start"), F.lit(order).alias("order"),
            F.lit(rule.kind).alias("kind"), p["end"].alias("end"),
        ))

    spans = _let(parts, with_ends)
    # Cheaper than taking the text apart, and as long a value as the rule asks for.
    present = text.rlike(_at_least(rule))
    return F.when(asked & present, spans).otherwise(none)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body with a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Of each value of an array of ints, it and all before it combined, 0 if there are none.

    Values are combined in runs of ``_STEP``, and those runs: nothing grows with each step.
    """
    total = lambda some: F.aggregate(some, F.lit(0), combine)
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.expr("cast(array() as array<int>)"))
    run = lambda i: F.floor(i / _STEP).cast("int")

    def ends(all_values: Column) -> Column:
        runs = F.transform(
            upto(F.ceil(F.size(all_values) / _STEP).cast("int")),
            lambda r: total(F.slice(all_values, r * _STEP + 1, F.lit(_STEP))),
        )
        before = _let(runs, lambda sums: F.transform(
            upto(F.size(sums)), lambda r: total(F.slice(sums, F.lit(1), r))
        ))
        return _let(before, lambda firsts: F.transform(upto(F.size(all_values)), lambda i: combine(
            F.get(firsts, run(i)), total(F.slice(all_values, run(i) * _STEP + 1, i % _STEP + 1))
        )))

    return _let(values, ends)


def _at_least(rule: Rule) -> str:
    """A pattern that is in every text with a span of the rule."""
    if rule.value == 0 and rule.pattern.endswith("]+"):
        last = rule.pattern.rindex("[")
        literal = rule.pattern[:last]
        if re.fullmatch(r"\w*", literal):
            return f"{literal}{rule.pattern[last:-1]}{{{max(1, rule.least - len(literal))},}}"
    return rule.pattern


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each, joined by commas."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def redact(docs: DataFrame, rules: list[Rule] = RULES, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The rows with every secret's place in the text taken by ``mark``; overlapping ones by one.

    A column ``secrets`` is dropped, others are kept.
    """


    def cut(chunks: Column, begin: Column, end: Column) -> Column:
        """The text between two places, of its pieces of equal length."""
        first, last = F.floor(begin / _CUT).cast("int"), F.floor(end / _CUT).cast("int")
        piece = lambda i: F.coalesce(F.get(chunks, i), F.lit(""))
        within = F.substring(piece(first), begin % _CUT + 1, end - begin)
        over = F.concat(
            F.substring(piece(first), begin % _CUT + 1, F.lit(_CUT)),
            F.array_join(F.slice(chunks, first + 2, last - first - 1), ""),
            F.substring(piece(last), F.lit(1), end % _CUT),
        )
        return F.when(first == last, within).otherwise(over)

    def cleaned(parts: Column) -> Column:
        spans, chunks = parts["spans"], parts["chunks"]
        # What is redacted before each span, and behind the last one.
        redacted = F.concat(F.array(F.lit(0)), _running(F.transform(spans, lambda x: x["end"]), lambda a, b: F.greatest(a, b)))

        def pieces(done: Column) -> Column:
            one = lambda span, i: F.when(
                span["start"] >= F.get(done, i), F.concat(cut(chunks, F.get(done, i), span["start"]), F.lit(mark))
            ).otherwise("")
            tail = cut(chunks, F.element_at(done, -1), F.length(text))
            return F.concat(F.array_join(F.transform(spans, one), ""), tail)

        return _let(redacted, pieces)

    rows = find_secrets(docs, rules, text)
    chunks = F.regexp_extract_all(F.col(text), F.lit(f"(?s)(.{{1,{_CUT}}})"), F.lit(1))
    parts = F.struct(F.col("secrets").alias("spans"), chunks.alias("chunks"))
    rows = rows.withColumn(text, F.when(F.size("secrets") > 0, _let(parts, cleaned)).otherwise(F.col(text)))
    return rows.select(*(f"`{name}`" for name in docs.columns if name != "secrets"))
