import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rowgate import DateRule, Dialect, parse_spec
from rowgate.operators.joins import listed_join
from rowgate.operators.load import accepted, load_counts, rejects, stage, tag_lines
from rowgate.sources.delimited import read_lines

XY = parse_spec("x|int,y|int")
TWO = parse_spec("a|string|nullable,b|string|nullable")


def tag(spark, folder, spec, dialect=Dialect(), dates=DateRule(), has_header=True):
    return tag_lines(read_lines(spark, folder, has_header), spec, dialect, dates)


def values(df):
    return sorted(map(tuple, df.collect()), key=repr)


def reasons(df):
    return [(r.line, r.reason) for r in rejects(df).orderBy("file", "block", "row").collect()]


def test_all_rows_good(spark, put):
    tagged = tag(spark, put("x,y\n1,1\n2,2\n3,3\n4,4\n"), XY)
    assert values(accepted(tagged)) == [(1, 1), (2, 2), (3, 3), (4, 4)]
    assert reasons(tagged) == []


def test_blank_in_not_null_column_is_rejected_verbatim(spark, put):
    tagged = tag(spark, put("x,y\n1,1\n,2\n3,3\n4,4\n,5\n"), XY)
    assert values(accepted(tagged)) == [(1, 1), (3, 3), (4, 4)]
    assert reasons(tagged) == [(",2", "null"), (",5", "null")]
    assert {r.field for r in rejects(tagged).collect()} == {"x"}


def test_header_is_dropped_per_file_and_order_decides(spark, put):
    put("x,y\n1,2\n", "a.csv")
    folder = put("y,x\n3,4\n", "b.csv")
    assert values(accepted(tag(spark, folder, XY))) == [(1, 2), (3, 4)]
    assert values(accepted(tag(spark, put("5,6\n", folder="bare"), XY, has_header=False))) == [(5, 6)]


@pytest.mark.parametrize("header", ["x,y\n", "\n", " \t\n"])
def test_every_line_has_the_outcome_it_has_without_a_header(spark, put, header):
    body = "1,1\n   \n\n\t\n\ufffe2,2\n2,2\n"
    for has_header, text, folder in [(True, header + body, "with"), (False, body, "bare")]:
        tagged = tag(spark, put(text, folder=folder), XY, has_header=has_header)
        assert values(accepted(tagged)) == [(1, 1), (2, 2)]
        assert reasons(tagged) == [("   ", "arity"), ("", "malformed"), ("\t", "arity"), ("\ufffe2,2", "bad_number")]
    one = parse_spec("a|string|nullable")
    assert values(accepted(tag(spark, put("a\nb\n  \n", folder="one"), one))) == [("b",), (None,)]


def test_each_file_of_a_task_gives_up_its_first_line(spark, put):
    for i in range(40):
        folder = put(f"x,y\n{i},{i}\n", f"{i}.csv")
    tagged = tag(spark, folder, XY)
    assert tagged.rdd.getNumPartitions() < 40
    assert values(accepted(tagged)) == sorted(((i, i) for i in range(40)), key=repr)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    try:
        assert accepted(tag(spark, folder, XY)).count() == 40
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def check_lines(spark, put, cases, dialect=Dialect()):
    """Load all lines as one file and compare cells, or the reject reason, line by line."""
    folder = put("".join(line + "\n" for line, _ in cases))
    rows = tag(spark, folder, TWO, dialect, has_header=False).orderBy("_load.file", "_load.block", "_load.row").collect()
    assert len(rows) == len(cases)
    assert [(line, r["_load"].reason or (r.a, r.b)) for (line, _), r in zip(cases, rows)] == cases
    assert all(r["_load"].line == (line if r["_load"].reason else None) for (line, _), r in zip(cases, rows))


def test_well_formed_lines(spark, put):
    cases = [
        ("a,b", ("a", "b")),
        ('a"b,1', ('a"b', "1")),
        ('"a,b",1', ("a,b", "1")),
        ('"a""b",1', ('a"b', "1")),
        ('"a" \t,"1"  ', ("a", "1")),
        ('1, "2"', ("1", '"2"')),
        ('"","x"', (None, "x")),
        ('"""",x', ('"', "x")),
        (" a b ,\t1", ("a b", "1")),
        ("\x1f a\x00,b", ("a", "b")),
        ("a￿b,￿", ("a￿b", "￿")),
        ("a\x01b,é\U0001f600", ("a\x01b", "é\U0001f600")),
        ("\\,\\n", ("\\", "\\n")),
    ]
    check_lines(spark, put, cases)


def test_bad_lines(spark, put):
    cases = [
        ('6,"6', "malformed"),
        ('"a"b,1', "malformed"),
        ('"a"",1', "malformed"),
        ('"a""b,1', "malformed"),
        ("4", "arity"),
        ("5,5,5", "arity"),
        ("5,5,", "arity"),
        (",".join("x" * 30000), "arity"),
    ]
    check_lines(spark, put, cases)


def test_very_long_quoted_cell(spark, put):
    text = 'ab"c,' * 200_000
    line = '"' + text.replace('"', '""') + '",1'
    tagged = tag(spark, put("h,h\n" + line + "\n" + line[:-3] + "\n"), TWO)
    assert values(accepted(tagged)) == [(text, "1")]
    assert [reason for _, reason in reasons(tagged)] == ["malformed"]


def test_other_escape_character(spark, put):
    cases = [
        ("'a|b'|c", ("a|b", "c")),
        ("'a''b'|c", ("a'b", "c")),
        (r"'a\'b'|c", ("a'b", "c")),
        (r"a\|b|c", ("a|b", "c")),
        (r"a\\|b", ("a\\", "b")),
        (r"a\\nb|'\\t'", ("a\\nb", "\\t")),
        (r"a\nb|'c\td'", ("a\nb", "c\td")),
        (r"a\xb|c''d", (r"a\xb", "c''d")),
        (r"\'a'|b", ("'a'", "b")),
        ("'a' |b", ("a", "b")),
        ("a|b\\", "malformed"),
        ("'a|b", "malformed"),
        (r"'a\'|b", "malformed"),
        ("'a'x|b", "malformed"),
    ]
    check_lines(spark, put, cases, Dialect("|", "'", "\\"))


def test_quoting_off(spark, put):
    folder = put('"a,b"\n')
    assert values(accepted(tag(spark, folder, TWO, Dialect(quote=""), has_header=False))) == [('"a', 'b"')]
    folder = put('"a\\,b,c"\n')
    assert values(accepted(tag(spark, folder, TWO, Dialect(quote="", escape="\\"), has_header=False))) == [('"a,b', 'c"')]


def test_tab_delimiter_after_quoted_cell(spark, put):
    assert values(accepted(tag(spark, put('"a"\tb\n'), TWO, Dialect("\t"), has_header=False))) == [("a", "b")]


def test_dialect_conflicts():
    with pytest.raises(ValueError):
        Dialect('"')
    with pytest.raises(ValueError):
        Dialect("\\", escape="\\")


TYPES = parse_spec("i|int,l|long,d|double,f|float,s|string|nullable,t|long|timestamp")
GOOD = {"i": "1", "l": "2", "d": "1.5", "f": "2.5", "s": "a", "t": "2020/01/02 03:04:05"}
DATES = DateRule("yyyy/MM/dd HH:mm:ss", "UTC")


CELLS = [
    ("i", "7", 7),
    ("i", "+7", 7),
    ("i", "-7", -7),
    ("i", "٣", "bad_number"),
    ("i", "\x7f7", "bad_number"),
    ("i", "7\x1f", "bad_number"),
    ("i", "7\x7f", "bad_number"),
    ("i", "7\u00a0", "bad_number"),
    ("i", "+", "bad_number"),
    ("i", "1-", "bad_number"),
    ("i", "1e3", "bad_number"),
    ("i", "7.", "bad_number"),
    ("i", ".7", "bad_number"),
    ("i", "7.0", "bad_number"),
    ("i", "007", 7),
    ("i", "-2147483648", -2147483648),
    ("i", "2147483648", "bad_number"),
    ("i", " 7 ", "bad_number"),
    ("i", "1.5", "bad_number"),
    ("i", "9999999999", "bad_number"),
    ("i", "abc", "bad_number"),
    ("i", " ", "null"),
    ("l", "9999999999", 9999999999),
    ("l", "99999999999999999999", "bad_number"),
    ("d", "1e3", 1000.0),
    ("d", " 1.5 ", 1.5),
    ("d", "1.0f", 1.0),
    ("d", "0x1p3", 8.0),
    ("d", "1e400", float("inf")),
    ("d", "Infinity", float("inf")),
    ("d", "-Infinity", float("-inf")),
    ("d", "inf", "bad_number"),
    ("d", "nan", "bad_number"),
    ("d", "INFINITY", "bad_number"),
    ("d", "x", "bad_number"),
    ("f", "0.1", pytest.approx(0.1, abs=1e-7)),
    ("f", "inf", "bad_number"),
    ("s", '"  a  "', "a"),
    ("s", "\t ", None),
    ("t", "1577836800000", datetime(2020, 1, 1)),
    ("t", "99999999999999999999", datetime(1970, 1, 1)),
    ("t", "9223372036854775807", "bad_timestamp"),
    ("t", "2020/1/2 3:4:5", datetime(2020, 1, 2, 3, 4, 5)),
    ("t", " 2020/1/2 3:4:5 ", datetime(2020, 1, 2, 3, 4, 5)),
    ("t", "-5", "bad_timestamp"),
    ("t", "not-a-date", "bad_timestamp"),
    ("t", "2020/13/45 00:00:00", "bad_timestamp"),
    ("t", "", "null"),
]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_cell_rules(spark, put, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        check_cells(spark, put)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def check_cells(spark, put):
    folder = put("".join(",".join({**GOOD, column: text}.values()) + "\n" for column, text, _ in CELLS))
    tagged = tag(spark, folder, TYPES, dates=DATES, has_header=False)
    rows = tagged.orderBy("_load.file", "_load.block", "_load.row").collect()
    found = [(column, text, row["_load"].reason or row[column]) for (column, text, _), row in zip(CELLS, rows)]
    assert len(rows) == len(CELLS)
    assert found == CELLS


def test_nan_cell(spark, put):
    folder = put(",".join({**GOOD, "d": "NaN"}.values()) + "\n")
    row = tag(spark, folder, TYPES, dates=DATES, has_header=False).first()
    assert row["_load"].reason is None and math.isnan(row.d)


def test_first_bad_cell_decides(spark, put):
    assert reasons(tag(spark, put("h\nx,\n,x\n"), XY)) == [("x,", "bad_number"), (",x", "null")]


def test_counts_and_staging(spark, put):
    put("x,y\n1,1\n,2\n", "a.csv")
    folder = put("x,y\n3,3\n4,4\n", "b.csv")
    tagged = tag(spark, folder, XY)
    counts = {r.file[-5:]: (r.accepted, r.rejected) for r in load_counts(tagged).collect()}
    assert counts == {"a.csv": (1, 1), "b.csv": (2, 0)}
    staged = stage(tagged, XY)
    assert staged.counts == {"accepted": 3, "rejected": 1}
    assert values(staged.accepted.drop("_load")) == [(1, 1), (3, 3), (4, 4)]
    assert [r.line for r in staged.rejects.collect()] == [",2"]
    assert values(staged.accepted_whole_files().drop("_load")) == [(3, 3), (4, 4)]


def test_long_key_list_is_joined_without_broadcast(spark):
    left = spark.range(1000).select("id", (F.col("id") % 3).alias("a.b"), F.lit(99).alias("_salt"))
    listed = spark.createDataFrame([(0,), (2,)], "`a.b` bigint")
    for how, kept in [("left_anti", "`a.b` = 1"), ("left_semi", "`a.b` != 1")]:
        for bound in (0, 10):
            found = listed_join(left, listed, ["a.b"], how, broadcast_rows=bound)
            assert values(found) == values(left.where(kept))
    many = spark.range(200_001).select(F.col("id").alias("a.b"))
    found = listed_join(left, many, ["a.b"], "left_anti")
    assert found.count() == 0
    plan = found._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert "Broadcast" not in plan and "SortMergeJoin" in plan


def test_whole_file_mode_with_odd_column_names(spark, put):
    put("a.b,_file,_salt\n1,2,3\n", "a.csv")
    spec = parse_spec("a.b|int,_file|int,_salt|int")
    staged = stage(tag(spark, put("a.b,_file,_salt\n4,5,6\nx,5,6\n", "b.csv"), spec), spec)
    assert values(staged.accepted_whole_files().drop("_load")) == [(1, 2, 3)]


def test_empty_file(spark, put):
    put("x,y\n", "a.csv")
    staged = stage(tag(spark, put("", "b.csv"), XY), XY)
    assert staged.counts == {"accepted": 0, "rejected": 0}
    assert staged.accepted.count() == staged.rejects.count() == 0


def test_large_file_is_split_and_complete(spark, put):
    text = "x,y\n" + "".join(f"{i},{i}\n" for i in range(50_000))
    folder = put(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        tagged = tag(spark, folder, XY)
        assert tagged.rdd.getNumPartitions() > 2
        assert accepted(tagged).selectExpr("count(*)", "sum(x)").first() == (50_000, 50_000 * 49_999 // 2)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
