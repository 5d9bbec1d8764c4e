import uuid

import pytest
from pyspark.sql import functions as F

from rowgate import DateRule, Dialect, parse_spec
from rowgate.operators import tables
from rowgate.operators.export import write_rejects
from rowgate.operators.ingest import load_files, load_records
from rowgate.operators.tables import declare_table, read_table
from rowgate.spec import TableSpec

KEYED = "k|int|$primary_key,v|string|nullable"


@pytest.fixture
def name():
    return "t" + uuid.uuid4().hex


def rows(table):
    return sorted(map(tuple, table.read().collect()))


def test_parse_spec():
    spec = parse_spec("X|Float|data,TIMESTAMP|Long|data,TEXT|String|Store_Only| text_search ,t|LONG|timestamp,bare,")
    assert [f.dataType.simpleString() for f in spec.schema] == ["float", "bigint", "string", "timestamp", "string"]
    assert spec.header_cells() == [
        "X|float|data",
        "TIMESTAMP|long|data",
        "TEXT|string|store_only|text_search",
        "t|long|timestamp",
        "bare|string",
    ]
    assert parse_spec("a|int|$primary_key(1),b|int|$primary_key(0),c|int|primary_key").keys == ["b", "a", "c"]
    spec = parse_spec("a|int|$primary_key(5),b|int|$primary_key(x),c|integer")
    assert spec.keys == ["a", "b"]
    for text in ["a|decimal", "a|int,a|int", "|int", "a|string|timestamp", "_load|int"]:
        with pytest.raises(ValueError):
            parse_spec(text)


def test_header_cells_describe_the_key_order():
    spec = parse_spec("a|int|$primary_key(1),b|int|$primary_key(0)")
    again = parse_spec(",".join(spec.header_cells()))
    assert again.keys == ["b", "a"]


def test_declare_in_collection_and_stored_type_wins(spark, name):
    collection = "c" + uuid.uuid4().hex
    table = declare_table(spark, name, KEYED, collection)
    assert table.read().count() == 0 and table.spec.keys == ["k"]
    again = declare_table(spark, name, "other|double", collection)
    assert again.spec == table.spec
    with pytest.raises(ValueError):
        declare_table(spark, name + "x")


def test_table_made_elsewhere_is_appended_to(spark, put, name):
    spark.sql(f"CREATE TABLE {name} (a INT, b STRING) USING parquet")
    table = declare_table(spark, name, KEYED)
    load_files(spark, put("a,b\n1,x\n,y\nz,z\n"), table)
    assert sorted(map(tuple, table.read().collect()), key=str) == [(1, "x"), (None, "y")]
    with pytest.raises(ValueError, match="not updated"):
        load_files(spark, put("a,b\n1,x\n"), table, update=True)


def test_insert_ignore_and_replay(spark, put, name):
    table = declare_table(spark, name, KEYED)
    first = put("k,v\n1,a\n2,b\n1,c\n,d\n", folder="one")
    report = load_files(spark, first, table, load_id="one")
    assert report.staged.counts == {"accepted": 3, "rejected": 1}
    assert rows(table) == [(1, "a"), (2, "b")]
    assert load_files(spark, first, table, load_id="one").staged.counts == report.staged.counts
    load_files(spark, first, table, load_id="again")
    assert rows(table) == [(1, "a"), (2, "b")]
    load_files(spark, put("k,v\n2,x\n3,y\n", folder="two"), table)
    assert rows(table) == [(1, "a"), (2, "b"), (3, "y")]


def inserted(table):
    return sorted(tuple(r)[1:] for r in table.inserted().select("load", *table.spec.names).collect())


def test_update_keeps_last_and_logs_inserts_only(spark, put, name):
    table = declare_table(spark, name, KEYED)
    load_files(spark, put("k,v\n1,a\n2,b\n", folder="one"), table)
    load_files(spark, put("k,v\n2,x\n3,y\n2,z\n", folder="two"), table, update=True, load_id="two")
    assert rows(table) == [(1, "a"), (2, "z"), (3, "y")]
    load_files(spark, put("k,v\n3,n\n4,w\n", folder="three"), table)
    assert rows(table) == [(1, "a"), (2, "z"), (3, "y"), (4, "w")]
    load_files(spark, put("k,v\n2,x\n", folder="two"), table, update=True, load_id="two")
    assert rows(table) == [(1, "a"), (2, "z"), (3, "y"), (4, "w")]
    assert inserted(table) == [(1, "a"), (2, "b"), (3, "y"), (4, "w")]


STEPS = [(tables, "_write_once"), (tables, "move_folder"), (tables.Table, "_write"), (tables.commits, "add"), (tables.Table, "settle")]


def stop_after(monkeypatch, steps):
    """Let the next load fail once that many folders, entries or pointers were written or moved."""
    done = []

    def counted(real):
        def step(*args):
            if len(done) == steps:
                raise RuntimeError("lost")
            done.append(args)
            return real(*args)

        return step

    for owner, step in STEPS:
        monkeypatch.setattr(owner, step, counted(getattr(owner, step)))


def interrupted(monkeypatch, stop, load):
    stop_after(monkeypatch, stop)
    try:
        load()
        return False
    except RuntimeError:
        return True
    finally:
        monkeypatch.undo()


@pytest.mark.parametrize("stop,update_between", [*[(stop, True) for stop in range(8)], (3, None), (6, None), (4, False)])
def test_update_repeated_after_any_step(spark, put, name, monkeypatch, stop, update_between):
    """With and without another load in between: no row is lost or doubled, each key is logged once."""
    table = declare_table(spark, name, KEYED, buckets=2)
    load_files(spark, put("k,v\n1,a\n", folder="one"), table)
    two = put("k,v\n1,x\n2,y\n", folder="two")
    assert interrupted(monkeypatch, stop, lambda: load_files(spark, two, table, update=True, load_id="two")) == (stop < 7)
    committed = table.holds_load("two")
    assert committed == (stop >= 6)
    assert rows(tables.open_table(spark, name)) == ([(1, "x"), (2, "y")] if committed else [(1, "a")])
    if update_between is not None:
        load_files(spark, put("k,v\n2,between\n5,b\n", folder="three"), table, update=update_between)
    for _ in range(2):
        load_files(spark, two, table, update=True, load_id="two")
    second = "between" if update_between and committed else "y"
    assert rows(table) == [(1, "x"), (2, second)] + ([(5, "b")] if update_between is not None else [])
    assert [k for k, _ in inserted(table)] == [k for k, _ in rows(table)]


@pytest.mark.parametrize("stop", [1, 3, 4, 5])
def test_insert_repeated_after_an_update(spark, put, name, monkeypatch, stop):
    """The inserted row is in the table and in the log, whatever came between."""
    table = declare_table(spark, name, KEYED, buckets=2)
    load_files(spark, put("k,v\n1,a\n", folder="one"), table)
    load_files(spark, put("k,v\n1,b\n", folder="two"), table, update=True)
    five = put("k,v\n5,e\n", folder="five")
    interrupted(monkeypatch, stop, lambda: load_files(spark, five, table, load_id="five"))
    load_files(spark, put("k,v\n1,c\n", folder="three"), table, update=True)
    load_files(spark, five, table, load_id="five")
    assert rows(table) == [(1, "c"), (5, "e")]
    assert inserted(table) == [(1, "a"), (5, "e")]


@pytest.mark.parametrize("stop", range(4))
def test_keyless_load_repeated_after_any_step(spark, put, name, monkeypatch, stop):
    bag = declare_table(spark, name, "k|int,v|string")
    one = put("k,v\n1,a\n1,a\n", folder="one")
    interrupted(monkeypatch, stop, lambda: load_files(spark, one, bag, load_id="one"))
    for _ in range(2):
        load_files(spark, one, bag, load_id="one")
    assert rows(bag) == inserted(bag) == [(1, "a")] * 2


def files_of(table):
    return {f for f in table.read().inputFiles() if "/none/" not in f}


def test_update_of_one_row_rewrites_one_bucket(spark, name):
    table = declare_table(spark, name, "k|long|$primary_key,v|long", buckets=64)
    table.write(spark.range(5000).select(F.col("id").alias("k"), F.col("id").alias("v")), F.col("k"), "all")
    before = files_of(table)
    assert len(before) >= 64
    table.write(spark.createDataFrame([(77, -1)], "k long, v long"), F.col("k"), "one", update=True)
    after = files_of(table)
    assert 1 <= len(after - before) <= 2 and len(before - after) >= 1  # what stays of the bucket, and the row
    assert {f.rsplit("/_b=", 1)[1].split("/")[0] for f in before - after} == {f.rsplit("/_b=", 1)[1].split("/")[0] for f in after - before}
    assert table.read().where("v = -1").count() == 1 and table.read().count() == 5000
    table.write(spark.createDataFrame([(6000, 1)], "k long, v long"), F.col("k"), "new", update=True)
    assert after < files_of(table) and len(files_of(table)) == len(after) + 1
    dropped = table.drop_old_data()
    assert not [d for d in dropped if "/data/" in d]  # what "all" inserted is the log of the feeds
    table.write(spark.createDataFrame([(77, -2)], "k long, v long"), F.col("k"), "again", update=True)
    assert len([d for d in table.drop_old_data() if "-merged" in d]) == 1
    assert table.read().where("k = 77").first().v == -2 and table.read().count() == 5001


def test_buckets_of_many_folders_are_merged(spark, name, monkeypatch):
    monkeypatch.setattr(tables, "SEGMENTS", 3)
    table = declare_table(spark, name, "k|long|$primary_key,v|long", buckets=2)
    for i in range(9):
        table.write(spark.range(8).select((F.col("id") + 4 * i).alias("k"), F.lit(i).cast("long").alias("v")), F.col("k"), f"l{i}")
        assert all(len(names) <= 3 for names in tables.commits.last(spark, table.folder)["live"].values())
    assert rows(table) == inserted(table) == [(k, max(0, k // 4 - 1)) for k in range(40)]
    table.drop_old_data()
    assert rows(table) == inserted(table)


def interleave(monkeypatch, owner, step, other):
    """Run another load right before the first call of a step."""
    real, ran = getattr(owner, step), []

    def first(*args):
        if not ran:
            ran.append(True)
            other()
        return real(*args)

    monkeypatch.setattr(owner, step, first)


@pytest.mark.parametrize("step,update,other_update", [*[(i, True, True) for i in range(5)], (2, False, True), (3, True, False)])
def test_two_writers(spark, put, name, monkeypatch, step, update, other_update):
    """A load commits in between at any step of another: the result is that of one after the other."""
    table = declare_table(spark, name, KEYED, buckets=2)
    load_files(spark, put("k,v\n" + "".join(f"{i},a\n" for i in range(6)), folder="old"), table)
    mine, theirs = put("k,v\n2,mine\n8,mine\n", folder="mine"), put("k,v\n2,other\n3,other\n8,other\n9,other\n", folder="other")

    def other():
        if not table.holds_load("other"):
            load_files(spark, theirs, tables.open_table(spark, name), update=other_update, load_id="other")

    interleave(monkeypatch, *STEPS[step], other)
    load_files(spark, mine, table, update=update, load_id="mine")
    monkeypatch.undo()
    at = {e["load"]: e["number"] for e in tables.commits.between(spark, table.folder, 0, 3)}
    expected = {i: "a" for i in range(6)}
    for load, keys, updates in sorted([("mine", (2, 8), update), ("other", (2, 3, 8, 9), other_update)], key=lambda x: at[x[0]]):
        expected.update({k: load for k in keys if updates or k not in expected})
    assert dict(rows(table)) == expected and len(rows(table)) == len(expected)
    assert [k for k, _ in inserted(table)] == sorted(expected)


def test_writers_of_other_buckets_do_not_start_anew(spark, name, monkeypatch):
    table = declare_table(spark, name, "k|long|$primary_key,v|long", buckets=16)
    ids = table._bucketed(spark.range(100).select(F.col("id").alias("k"))).collect()
    one, two = ids[0], next(r for r in ids if r._b != ids[0]._b)

    def write(row, load):
        table.write(spark.createDataFrame([(row.k, 1)], "k long, v long"), F.col("k"), load, update=True)

    prepared = []
    real = tables.Table._prepared
    monkeypatch.setattr(tables.Table, "_prepared", lambda *args: prepared.append(args[4]) or real(*args))
    interleave(monkeypatch, tables.commits, "add", lambda: write(two, "two"))
    write(one, "one")
    assert sorted(prepared) == ["one", "two"] and rows(table) == sorted([(one.k, 1), (two.k, 1)])


def test_composite_key_and_keyless(spark, put, name):
    table = declare_table(spark, name, "a|int|$primary_key(1),b|int|$primary_key(0),v|string")
    load_files(spark, put("h\n1,1,p\n1,2,q\n1,1,r\n", folder="one"), table, update=True)
    assert rows(table) == [(1, 1, "r"), (1, 2, "q")]
    bag = declare_table(spark, name + "bag", "a|int")
    for _ in range(2):
        load_files(spark, put("a\n1\n1\n", folder="bag"), bag, update=True)
    assert rows(bag) == [(1,)] * 4


def test_fail_whole_file(spark, put, name):
    table = declare_table(spark, name, "x|int,y|int")
    put("x,y\n1,1\n,2\n", "bad.csv")
    report = load_files(spark, put("x,y\n3,3\n", "good.csv"), table, skip_errors=False)
    assert rows(table) == [(3, 3)]
    assert report.rejects.count() == 1


def test_reject_file_is_byte_exact(spark, put, name, tmp_path):
    table = declare_table(spark, name, "x|int,y|int")
    put("x,y\n1,1\n,2\n3,3\n4,4\n,5\n", "bad one+%.csv", folder="in put")
    folder = put("x,y\n3,3\n", "good.csv", folder="in put")
    report = load_files(spark, folder, table)
    report.export_rejects(str(tmp_path / "out"))
    found = list((tmp_path / "out").glob("source=*/part-*"))
    assert [f.read_bytes() for f in found] == [b"x,y\n,2\n,5\n"]


def test_no_rejects_make_no_reject_file(spark, put, name, tmp_path):
    table = declare_table(spark, name, "x|int,y|int")
    report = load_files(spark, put("x,y\n3,3\n"), table)
    write_rejects(report.rejects, str(tmp_path / "out"), report.staged.headers)
    assert list((tmp_path / "out").glob("source=*")) == []


def test_many_rejects_of_one_file_keep_their_order_over_part_files(spark, put, name, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table = declare_table(spark, name, "x|int")
        text = "x\n" + "".join(f"bad{i}\n" for i in range(3000))
        report = load_files(spark, put(text), table)
        report.export_rejects(str(tmp_path / "out"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = sorted((tmp_path / "out").glob("source=*/part-*"))
    assert len(parts) > 1
    assert "".join(p.read_text() for p in parts) == text


def test_replicated_table_is_broadcast_within_its_bound(spark, put, name):
    small = declare_table(spark, name, KEYED, replicated=True)
    load_files(spark, put("k,v\n1,a\n2,b\n"), small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for limit, expected in [(10**6, True), (1, False)]:
            joined = spark.range(10).join(read_table(spark, name, limit), F.col("id") == F.col("k"))
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert ("BroadcastHashJoin" in plan) == expected
            assert joined.count() == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def records(spark, maps):
    return spark.createDataFrame([(m,) for m in maps], "attrs map<string,string>")


def test_attribute_records(spark, name):
    table = declare_table(spark, name, "i|int,l|long,d|double,f|float,s|string,t|long|timestamp")
    maps = [
        {"i": "7", "l": " 7", "d": "x", "f": "", "s": "  a ", "t": "1000", "zz": "1"},
        {"I": "7", "d": " 1.5 ", "s": " \t", "t": "1970/1/1 0:0:2"},
        {"i": "1", "t": "soon"},
        {"i": "2", "t": ""},
        {"d": "nan", "f": "Infinity"},
    ]
    report = load_records(records(spark, maps), "attrs", table, DateRule("yyyy/MM/dd HH:mm:ss", "UTC"))
    found = table.read().select("i", "l", "d", "f", "s", F.unix_millis("t")).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(
        [
            (7, 0, 0.0, 0.0, "  a ", 1000),
            (None, None, 1.5, None, None, 2000),
            (None, None, 0.0, float("inf"), None, None),
        ],
        key=repr,
    )
    assert [r.reason for r in report.rejects.collect()] == ["bad_timestamp"] * 2


def test_attribute_record_without_its_key_fails(spark, name, tmp_path):
    table = declare_table(spark, name, KEYED)
    report = load_records(records(spark, [{"k": "1"}, {"v": "x"}]), "attrs", table)
    assert rows(table) == [(1, None)]
    assert [(r.reason, r.field, r.line) for r in report.rejects.collect()] == [("null", "k", '{"v":"x"}')]
    report.export_rejects(str(tmp_path / "out"))
    assert [f.read_text() for f in (tmp_path / "out").glob("source=records/part-*")] == ['{"v":"x"}\n']


def test_dropped_table_can_be_declared_again(spark, put, tmp_path, name):
    folder = str(tmp_path / "it's here")
    for _ in range(2):
        table = declare_table(spark, name, KEYED, folder=folder)
        load_files(spark, put("k,v\n1,a\n1,b\n"), table, update=True)
        assert rows(table) == [(1, "b")]
        table.drop()
        assert not spark.catalog.tableExists(name)


def test_odd_column_names(spark, put, name):
    table = declare_table(spark, name, "a.b|int|$primary_key,c d|string|nullable")
    load_files(spark, put("h\n1;x\n1;y\n"), table, Dialect(";"), update=True)
    load_files(spark, put("h\n1;z\n2;y\n"), table, Dialect(";"))
    assert rows(table) == [(1, "y"), (2, "y")]
    assert TableSpec(table.read().schema).header_cells() == ["a.b|int|primary_key", "c d|string|nullable"]


def test_the_insert_log_is_read_without_dealing_rows_by_load(spark, name):
    table = declare_table(spark, name, KEYED)
    for load, first in (("a", 0), ("b", 5)):
        table.write(spark.createDataFrame([(first + i, load) for i in range(5)], table.spec.schema), F.col("k"), load)
    log = table.inserted()
    assert "hashpartitioning" not in log._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.load, r.k, r.v) for r in log.collect()) == [("a", i, "a") for i in range(5)] + [("b", i, "b") for i in range(5, 10)]
