import re
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from starledger import schemas
from starledger.functions import double_field, int_field, multi_value, split_fields, trim_controls
from starledger.sources import (
    CORRUPT,
    first_line,
    parse_products,
    parse_ratings,
    ratings_from_film,
    rejects,
    scan_lines,
)
from pyspark.sql.types import StructType

PLAIN = "3982^Mouse^1057,439^B009^http://x/a.jpg^Parts|Mouse^good|cheap"
QUOTED = '7^"A ""quoted"" name"^1^B^u^c^t'
PADDED = "8^ \tname\x01 ^1^B^ u^c ^ t|u\t"


def values(df, column):
    return [row[0] for row in df.select(column).collect()]


def test_products_keep_five_of_seven_fields(lines):
    parsed = parse_products(lines(PLAIN))
    assert parsed.collect() == [
        (3982, "Mouse", "http://x/a.jpg", "Parts|Mouse", "good|cheap")
    ]
    assert parsed.schema.simpleString() == StructType.fromDDL(schemas.PRODUCT).simpleString()


def test_quotes_are_part_of_the_value(lines):
    assert values(parse_products(lines(QUOTED)), "name") == ['"A ""quoted"" name"']


def test_trim_strips_control_characters_and_is_optional(lines):
    assert parse_products(lines(PADDED)).first() == (8, "name", "u", "c", "t|u")
    assert parse_products(lines(PADDED), trim=False).first() == (
        8, " \tname\x01 ", " u", "c ", " t|u\t",
    )


@pytest.mark.parametrize(
    "line",
    [
        "1^n^c^a^u^cat",  # six fields
        "x^n^c^a^u^cat^tag",
        "2147483648^n^c^a^u^cat^tag",
        " 1^n^c^a^u^cat^tag",
        "1^n^c^a^u^cat^",  # the last field is empty, so it does not count
        "1^n^c^a^u^cat^^^",
        "",
    ],
)
def test_bad_products(lines, line):
    everything = lines(PLAIN, line)
    with pytest.raises(Exception, match="malformed product line"):
        parse_products(everything).collect()
    assert values(parse_products(everything, mode="drop"), "productId") == [3982]
    good, bad = rejects(parse_products(everything, mode="permissive"))
    assert values(good, "productId") == [3982] and values(bad, "value") == [line]


def test_empty_inner_fields_are_fine(lines):
    assert parse_products(lines("1^^^^^^^x")).first() == (1, "", "", "", "")


def test_ratings(lines):
    parsed = parse_ratings(
        lines("1,10,5.0,1395676800", "1,11,3,1393632000,extra", "-2,+10,4.5e0,1393631999")
    )
    assert parsed.collect() == [
        (1, 10, 5.0, 1395676800),
        (1, 11, 3.0, 1393632000),
        (-2, 10, 4.5, 1393631999),
    ]
    assert parsed.schema.simpleString() == StructType.fromDDL(schemas.RATING).simpleString()


@pytest.mark.parametrize(
    "line",
    ["1,2,3.0", "1,2,3.0,", "12.0,2,3.0,4", "1, 2,3.0,4", "1,2,high,4", "1,2,nan,4", "1,2,INF,4", ""],
)
def test_bad_ratings(lines, line):
    everything = lines(line, "1,10,5.0,7")
    with pytest.raises(Exception, match="malformed rating line"):
        parse_ratings(everything).collect()
    assert values(parse_ratings(everything, "drop"), "timestamp") == [7]
    permissive = parse_ratings(everything, "permissive")
    assert permissive.where(F.col(CORRUPT).isNotNull()).first() == (None, None, None, None, line)


@pytest.mark.parametrize(
    "use",
    [
        lambda parsed: parsed.count(),
        lambda parsed: parsed.select("userId").collect(),
        lambda parsed: parsed.where("productId > 10").select("score").collect(),
        lambda parsed: parsed.agg(F.sum("timestamp")).collect(),
    ],
)
def test_strict_fails_whatever_is_selected(lines, use):
    with pytest.raises(Exception, match="malformed rating line"):
        use(parse_ratings(lines("1,10,5.0,7", "1,10,bad,7")))


def test_unknown_mode(lines):
    with pytest.raises(ValueError):
        parse_ratings(lines("1,2,3,4"), "lenient")


@pytest.mark.parametrize(
    "text, expected",
    [("5", 5.0), (" 1.5d ", 1.5), (".5", 0.5), ("5.", 5.0), ("1e3", 1000.0), ("0x1p3", 8.0),
     ("Infinity", float("inf")), ("-Infinity", float("-inf")), ("inf", None), ("infinity", None),
     ("x", None), ("", None), ("5n", None), ("+Infinity", float("inf")), (" -Infinity ", float("-inf")),
     ("InfinityN", None), ("5f", 5.0), ("1e400", float("inf")), ("\t2\x00", 2.0)],
)
def test_double_field(lines, text, expected):
    assert lines(text).select(double_field(F.col("value"))).first()[0] == expected


def test_double_field_nan(lines):
    assert str(lines("+NaN").select(double_field(F.col("value"))).first()[0]) == "nan"
    assert lines("NAN").select(double_field(F.col("value"))).first()[0] is None


@pytest.mark.parametrize(
    "text, expected",
    [("007", 7), ("-2147483648", -2147483648), ("2147483648", None), ("1_0", None), ("12\n", None), ("", None),
     (" 1", None), ("1 ", None), ("\t1", None), ("1\x00", None), ("\x7f1", None), ("1\x7f", None),
     ("+", None), ("1.0", None), ("--1", None), ("-0", 0), ("1\u00e9", None), ("\u0661", None)],
)
def test_int_field(lines, text, expected):
    assert lines(text).select(int_field(F.col("value"))).first()[0] == expected


def test_split_trim_and_multi_value(lines):
    row = lines("a^^b^^").select(split_fields(F.col("value"), "^")).first()
    assert row[0] == ["a", "", "b"]
    assert lines("\x00 a b\n").select(trim_controls(F.col("value"))).first()[0] == "a b"
    assert lines("a|b|").select(multi_value(F.col("value"))).first()[0] == ["a", "b", ""]


def test_scan_and_first_line(spark, tmp_path):
    (tmp_path / "b.txt").write_text("from b\n" * 10000)
    (tmp_path / "a.txt").write_text("first\nsecond\n")
    (tmp_path / "0.txt").write_text("")
    assert first_line(spark, str(tmp_path)).collect() == [("first",)]
    assert first_line(spark, str(tmp_path / "b.txt")).collect() == [("from b",)]
    assert scan_lines(spark, str(tmp_path)).count() == 10002
    empty = tmp_path / "empty"
    empty.mkdir()
    (empty / "e.txt").write_text("")
    assert first_line(spark, str(empty)).collect() == []


def test_first_line_of_a_file_in_many_splits(spark, tmp_path):
    path = tmp_path / "long.txt"
    path.write_text("".join(f"line {n}\n" for n in range(50000)))
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "20000")
    try:
        line = first_line(spark, str(path))
        assert line.collect() == [("line 0",)]
        assert line.repartition(3).where("value is not null").collect() == [("line 0",)]
    finally:
        spark.conf.set(key, before)


def test_film_layouts(spark):
    film = spark.createDataFrame([(1, 2, 3.0, 4)], schemas.FILM_RATING)
    assert ratings_from_film(film).columns == ["userId", "productId", "score", "timestamp"]
    for layout, fields in [(schemas.MOVIE, 10), (schemas.FILM_TAG, 4)]:
        assert len(StructType.fromDDL(layout).names) == fields


def jvm_fields(line, separator):
    """What a JVM split gives: trailing empty parts are dropped, an empty line is one part."""
    parts = line.split(separator)
    while len(parts) > 1 and parts[-1] == "":
        parts.pop()
    return [] if line and parts == [""] else parts


def jvm_int(text):
    if re.fullmatch(r"[+-]?[0-9]+", text) and -(2**31) <= int(text) < 2**31:
        return int(text)
    return None


pieces = st.sampled_from(
    ["1", "-7", "+3", "2147483647", "2147483648", "4.5", "x", "", " ", " 9", "1e2", "^", ",", "a b"]
)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(pieces, max_size=9), min_size=1, max_size=60))
def test_parsers_agree_with_a_model(spark, data):
    carets, commas = ["^".join(line) for line in data], [",".join(line) for line in data]
    frame = lambda texts: spark.createDataFrame([(t,) for t in texts], "value string")

    want = Counter()
    for line in carets:
        parts = jvm_fields(line, "^")
        if len(parts) >= 7 and jvm_int(parts[0]) is not None:
            want[(jvm_int(parts[0]), *(parts[i].strip() for i in (1, 4, 5, 6)))] += 1
    assert Counter(map(tuple, parse_products(frame(carets), mode="drop").collect())) == want

    want = Counter()
    for line in commas:
        parts = jvm_fields(line, ",")
        ints = [jvm_int(parts[i]) if len(parts) > i else None for i in (0, 1, 3)]
        try:
            score = float(parts[2])
        except (ValueError, IndexError):
            continue
        if None not in ints:
            want[ints[0], ints[1], score, ints[2]] += 1
    assert Counter(map(tuple, parse_ratings(frame(commas), "drop").collect())) == want


def test_rejects_parse_each_line_once(lines):
    """Taking the rejected lines only does not copy the parsing into the filter."""
    parsed = parse_ratings(lines("1,10,5.0,7", "1,abc,5.0,7", "x", "1,10,,7"), mode="permissive")
    good, bad = rejects(parsed)
    for rows in (good, bad):
        assert rows._jdf.queryExecution().executedPlan().toString().count("split(") == 1
    assert sorted(row.value for row in bad.collect()) == ["1,10,,7", "1,abc,5.0,7", "x"]
    assert [tuple(row) for row in good.collect()] == [(1, 10, 5.0, 7)]
