"""Quality rules: counts of each text, then a ratio of two n-gram models.

A text that fails no base rule is judged by the mean, over its token n-grams, of how much
likelier each is in trusted texts than in the corpus. Both models are multinomials over hash
buckets of the n-grams, smoothed, and counted from all texts; they have a fixed size. The
threshold is a fixed number, so every text is judged alike. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from starledger.llm.common import stored, unused, words_of

#: Fixed values of the base rules.
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30  # words in repeated windows, per hundred

#: Tokens of the models: runs of letters, of digits, or of other visible characters.
TOKEN = r"(\p{L}+|\p{N}+|[^\p{L}\p{N}\x00-\x20]+)"
BUCKETS = 1 << 16
SMOOTHING = 1.0
#: Least mean log-likelihood ratio of a kept text.
THRESHOLD = -0.25
SCALE = 1 << 20

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with the ``BASE`` counts, as longs, and ``base_failed``.

    A null text is an empty one: all counts are 0 and the base fails. Columns of these names
    are replaced, all others are kept.
    """
    words, lines, hashes, windows, ordered, starts = names = [
        unused(docs, name) for name in ("_words", "_lines", "_hashes", "_windows", "_ordered", "_starts")
    ]
    whole = F.coalesce(F.col(text), F.lit(""))
    with_word = F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    rows = docs.withColumns({words: words_of(F.col(text)), lines: with_word})
    rows = rows.withColumns(
        {
            "n_words": F.size(words),
            "word_chars": F.length(F.array_join(words, "")),
            "n_symbols": F.length(F.regexp_replace(whole, f"[^{SYMBOLS}]+", "")),
            "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
            hashes: F.transform(words, lambda word: F.xxhash64(word)),
        }
    )
    rows = rows.withColumn(windows, _windows(hashes))
    rows = rows.withColumn(ordered, _ordered(F.col(windows)))
    rows = rows.withColumn(starts, _repeated_starts(F.col(ordered)))
    rows = rows.withColumn("n_repeat_words", _covered(F.col(starts)))
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )
    longs = {name: F.col(name).cast("long") for name in BASE}
    return rows.drop(*names).withColumns(longs).withColumn("base_failed", failed)


def _windows(hashes: str) -> Column:
    """A 64-bit hash of every window of words, from the hashes of its words."""
    word = lambda at: F.get(hashes, at)
    one = lambda first, i: F.xxhash64(first, *(word(i + k) for k in range(1, WINDOW)))
    firsts = F.slice(hashes, 1, F.greatest(F.size(hashes) - WINDOW + 1, F.lit(0)))
    return F.transform(firsts, one)


def _ordered(windows: Column) -> Column:
    """The windows with their places, equal ones together; none if all differ."""
    pairs = F.transform(windows, lambda x, i: F.struct(x.alias("x"), i.alias("at")))
    differ = F.size(F.array_distinct(windows)) == F.size(windows)
    return F.when(~differ, F.array_sort(pairs)).otherwise(
        F.array().cast("array<struct<x: bigint, at: int>>")
    )


def _repeated_starts(ordered: Column) -> Column:
    """Places of the windows that are found more than once, ascending."""
    before = F.concat(F.array(F.lit(None).cast("struct<x: bigint, at: int>")), ordered)
    after = F.slice(ordered, 2, F.size(ordered))
    near = F.arrays_zip(ordered.alias("own"), before.alias("before"), after.alias("after"))
    like = lambda z, other: F.coalesce(z["own"]["x"] == z[other]["x"], F.lit(False))
    again = F.filter(near, lambda z: like(z, "before") | like(z, "after"))
    return F.sort_array(F.transform(again, lambda z: z["own"]["at"]))


def _covered(starts: Column) -> Column:
    """How many words the windows from these places on cover."""
    own = lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW)))
    own_words = F.zip_with(starts, F.slice(starts, 2, F.size(starts)), own)
    return F.aggregate(own_words, F.lit(0), lambda total, n: total + n)


def with_ratio(docs: DataFrame, corpus: DataFrame, text: str = "text", trusted: str = "trusted") -> DataFrame:
    """The rows with ``ratio``, a column that is replaced; all others are kept.

    The ratio is the mean over the text's n-grams of the logarithm of how much likelier they
    are in the rows of ``corpus`` that column ``trusted`` marks than in all of its rows. Texts
    without n-grams, empty or null, have a null. Repeated rows count each time; a null mark is
    none. Without trusted texts their model is uniform. The models reach the rows as one array
    of ``BUCKETS`` numbers, so texts are scored where they are read.
    """
    tokens, weights = unused(docs, "_tokens"), unused(docs, "_weights")
    rows = docs.withColumns({tokens: _tokens(text), weights: _weights(corpus, text, trusted).scalar()})
    add = lambda total, bucket: total + F.get(weights, bucket)
    total = F.aggregate(_buckets(tokens), F.lit(0).cast("long"), add)
    ratio = F.when(F.size(tokens) > 0, total / (2 * F.size(tokens) - 1) / SCALE)
    return rows.withColumn("ratio", ratio).drop(tokens, weights)


def _weights(corpus: DataFrame, text: str, trusted: str) -> DataFrame:
    """One row with the array of the buckets' weights, whole numbers: their sums do not depend
    on the order of rows."""
    good = F.coalesce(F.col(trusted), F.lit(False))
    rows = corpus.select(good.alias("good"), _tokens(text).alias("tokens"))
    rows = rows.select("good", _buckets("tokens").alias("grams"))
    # Outer, as Spark would otherwise make all n-grams twice to leave out texts without any.
    grams = rows.select("good", F.explode_outer("grams").alias("bucket")).where("bucket is not null")
    # Combined before the shuffle to a row per bucket: a fixed number.
    counts = grams.groupBy("bucket").agg(
        F.count_if("good").alias("good"), F.count(F.lit(1)).alias("raw")
    )
    counts = stored(counts, "ngrams")
    totals = counts.agg(F.sum("good"), F.sum("raw")).first()
    chance = lambda n, total: (F.coalesce(n, F.lit(0)) + SMOOTHING) / ((total or 0) + SMOOTHING * BUCKETS)
    log = F.log(chance("good", totals[0]) / chance("raw", totals[1]))
    buckets = corpus.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    weights = buckets.join(counts, "bucket", "left").select("bucket", F.round(log * SCALE).cast("int").alias("weight"))
    ordered = F.array_sort(F.collect_list(F.struct("bucket", "weight")))
    return weights.agg(ordered["weight"].alias("weights"))


def _tokens(text: str) -> Column:
    return F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(TOKEN), F.lit(1))


def _buckets(tokens: str) -> Column:
    """The buckets of each token and of each pair of tokens."""
    bucket = lambda *parts: F.pmod(F.xxhash64(*parts), F.lit(BUCKETS)).cast("int")
    n = F.greatest(F.size(tokens) - 1, F.lit(0))
    pairs = F.zip_with(F.slice(tokens, 1, n), F.slice(tokens, 2, n), lambda a, b: bucket(a, b))
    return F.concat(F.transform(tokens, lambda t: bucket(t)), pairs)


def judge(
    docs: DataFrame, corpus: DataFrame, text: str = "text", trusted: str = "trusted",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The rows with the ``BASE`` counts, ``base_failed``, ``ratio`` and ``kept``.

    The models are counted from ``corpus``, see ``with_ratio``, which may be ``docs``
    themselves. A text is kept if the base holds and its ratio is ``threshold`` or more;
    without n-grams the ratio is null and the base decides. Equal texts are judged alike.
    Columns of these names are replaced, all others are kept; an empty table gives no rows.
    """
    rows = with_ratio(base_counts(docs, text), corpus, text, trusted)
    kept = ~F.col("base_failed") & F.coalesce(F.col("ratio") >= threshold, F.lit(True))
    return rows.withColumn("kept", kept)
