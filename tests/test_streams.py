import uuid

import pytest
from pyspark.sql import functions as F

from rowgate import Dialect, parse_spec, session
from rowgate.operators.export import write_delimited, write_json
from rowgate.operators.ingest import load_files
from rowgate.operators.load import accepted, tag_lines
from rowgate.operators import tables
from rowgate.operators.tables import declare_table
from rowgate.sources.delimited import read_lines
from rowgate.streaming.feed import start_delimited_feed, start_json_feed, subscribe
from rowgate.streaming.loads import start_file_load, start_record_load

KEYED = "k|int|$primary_key,v|string|nullable"


@pytest.fixture
def table(spark):
    return declare_table(spark, "t" + uuid.uuid4().hex, KEYED)


def rows(table):
    return sorted(map(tuple, table.read().collect()))


def test_stream_equals_batch_and_resumes(spark, put, table, tmp_path):
    for i in range(5):
        folder = put(f"k,v\n{i},a{i}\n{i + 1},b{i}\nx,bad\n", f"{i}.csv")
    checkpoint = str(tmp_path / "checkpoint")
    query = start_file_load(spark, folder, table, checkpoint, files_per_trigger=2, update=True)
    query.awaitTermination()
    assert sum(1 for p in query.recentProgress if p["numInputRows"]) == 3
    batch = declare_table(spark, "t" + uuid.uuid4().hex, "k|int|$primary_key,v|string|nullable")
    load_files(spark, folder, batch, update=True)
    assert [k for k, _ in rows(table)] == [k for k, _ in rows(batch)] == list(range(6))
    put("k,v\n9,late\n", "9.csv")
    start_file_load(spark, folder, table, checkpoint, update=True).awaitTermination()
    assert [k for k, _ in rows(table)] == [0, 1, 2, 3, 4, 5, 9]
    staged = spark.read.parquet(f"{table.folder}/work/load=files-{query.id}-0/staged")
    assert staged.where("_load.reason = 'bad_number'").count() == 2


def test_repeated_batch_is_a_no_op(spark, put, table, tmp_path):
    """Without its commit mark Spark runs the batch again; the rows must not come twice."""
    bag = declare_table(spark, "t" + uuid.uuid4().hex, "k|int,v|string|nullable")
    folder = put("k,v\n1,a\n1,a\n")
    checkpoint = tmp_path / "checkpoint"
    for _ in range(2):
        start_file_load(spark, folder, bag, str(checkpoint)).awaitTermination()
        assert rows(bag) == [(1, "a"), (1, "a")]
        for mark in (checkpoint / "commits").iterdir():
            mark.unlink()


def test_streams_with_checkpoints_of_their_own_share_a_table(spark, put, table, tmp_path):
    one, two = put("k,v\n1,a\n2,b\n", folder="one"), put("k,v\n7,c\n8,d\n", folder="two")
    for folder in (one, two, one):
        start_file_load(spark, folder, table, str(tmp_path / uuid.uuid4().hex)).awaitTermination()
    assert rows(table) == [(1, "a"), (2, "b"), (7, "c"), (8, "d")]


def test_record_stream(spark, table, tmp_path):
    maps = spark.createDataFrame([({"k": "1", "v": " a "},), ({"k": "x"},), ({"v": "b"},)], "attrs map<string,string>")
    maps.write.json(str(tmp_path / "records"))
    records = spark.readStream.schema("attrs map<string,string>").json(str(tmp_path / "records"))
    start_record_load(records, "attrs", table, str(tmp_path / "checkpoint")).awaitTermination()
    assert rows(table) == [(0, None), (1, " a ")]


def test_feed_delivers_each_later_insert_once(spark, put, table, tmp_path):
    load_files(spark, put("k,v\n1,old\n", folder="one"), table)
    checkpoint, out = str(tmp_path / "checkpoint"), tmp_path / "out"
    subscribe(table, checkpoint)

    def drain():
        start_delimited_feed(table, str(out), checkpoint).awaitTermination()
        files = sorted(out.glob("batch=*/part-*"))
        lines = [f.read_bytes().decode().split("\r\n") for f in files]
        return len(list(out.glob("batch=*"))), sorted(line for f in lines for line in f[1:-1])

    assert drain() == (0, [])
    load_files(spark, put("k,v\n1,new\n2,b\n3,\n", folder="two"), table, update=True)
    assert drain() == (1, ["2\tb", "3\t"])
    load_files(spark, put("k,v\n3,ignored\n", folder="three"), table)
    assert drain() == (1, ["2\tb", "3\t"])
    load_files(spark, put("k,v\n4,d\n", folder="four"), table)
    assert drain() == (2, ["2\tb", "3\t", "4\td"])
    headers = {f.read_bytes().split(b"\r\n")[0] for f in out.glob("batch=*/part-*")}
    assert headers == {b"k|int|primary_key\tv|string|nullable"}


def test_feed_with_a_new_checkpoint_delivers_later_rows_only(spark, put, table, tmp_path):
    load_files(spark, put("k,v\n1,old\n", folder="one"), table)
    checkpoint, out = str(tmp_path / "checkpoint"), tmp_path / "out"
    for folder, text, expected in [("two", "k,v\n", []), ("three", "k,v\n2,b\n", ["2\tb"])]:
        load_files(spark, put(text, folder=folder), table)
        start_delimited_feed(table, str(out), checkpoint).awaitTermination()
        lines = [line for f in out.glob("batch=*/part-*") for line in f.read_text().splitlines()[1:]]
        assert lines == expected


def test_rows_of_an_unfinished_load_are_not_visible(spark, put, table, tmp_path, monkeypatch):
    checkpoint, out = str(tmp_path / "checkpoint"), tmp_path / "out"
    subscribe(table, checkpoint)

    def lost(*args):
        raise RuntimeError("lost")

    def drain():
        start_delimited_feed(table, str(out), checkpoint).awaitTermination()
        return [line for f in out.glob("batch=*/part-*") for line in f.read_text().splitlines()[1:]]

    folder = put("k,v\n1,a\n")
    real = tables.move_folder
    monkeypatch.setattr(tables, "move_folder", lost)
    with pytest.raises(RuntimeError):
        load_files(spark, folder, table, load_id="one")
    spark.catalog.refreshTable(table.name)
    assert rows(table) == [] and drain() == []
    monkeypatch.setattr(tables, "move_folder", real)
    load_files(spark, folder, table, load_id="one")
    assert rows(table) == [(1, "a")] and drain() == ["1\ta"]


def test_rejects_and_failed_files_of_a_stream(spark, put, table, tmp_path):
    put("k,v\n1,a\nx,bad\n \n", "a.csv")
    folder = put("k,v\n2,b\n", "b.csv")
    out = {"rejects": str(tmp_path / "rejects"), "failed_files": str(tmp_path / "failed")}
    start_file_load(spark, folder, table, str(tmp_path / "checkpoint"), skip_errors=False, **out).awaitTermination()
    assert rows(table) == [(2, "b")]
    assert [f.read_bytes() for f in (tmp_path / "rejects").glob("batch=*/source=a.csv-*/part-*")] == [b"k,v\nx,bad\n \n"]
    failed = spark.read.json(out["failed_files"]).collect()
    assert [(r.file.rsplit("/", 1)[-1], r.rejected) for r in failed] == [("a.csv", 2)]


def test_working_folders_with_rejects_stay_until_exported(spark, put, table, tmp_path):
    report = load_files(spark, put("k,v\nx,bad\n"), table, load_id="one")
    assert table.drop_old_data() == []
    assert report.rejects.count() == 1
    report.export_rejects(str(tmp_path / "out"))
    assert len(table.drop_old_data()) == 1
    load_files(spark, put("k,v\ny,bad\n"), table, load_id="two")
    assert len(table.drop_old_data(unexported_rejects=True)) == 1


def test_json_feed(spark, put, table, tmp_path):
    checkpoint, out = str(tmp_path / "checkpoint"), tmp_path / "out"
    subscribe(table, checkpoint)
    load_files(spark, put('k,v\n1,"a""b"\n2,\n'), table)
    start_json_feed(table, str(out), checkpoint).awaitTermination()
    lines = sorted(line for f in out.glob("batch=*/part-*.json") for line in f.read_text().splitlines())
    assert lines == ['{"k":1,"v":"a\\"b"}', '{"k":2,"v":null}']


ODD = ["a,b", 'say "hi"', "  lead", "trail \t", "back\\slash\\", "'", "", None, "a\rb", "x\ny", "é￿", "#c", "\\N", "null", '"', "\\\""]


@pytest.mark.parametrize("delimiter", ["\t", ",", "|"])
def test_exported_cells_come_back(spark, tmp_path, delimiter):
    """Line ends other than CRLF inside cells need a line feed as record end to stay as they are."""
    schema = parse_spec("k|int|$primary_key,v|string|nullable").schema
    cells = [v for v in ODD if v is None or "\r" not in v]
    df = spark.createDataFrame(list(enumerate(cells)), schema)
    write_delimited(df, str(tmp_path / "lf"), delimiter, line_end="\n")
    back = spark.read.csv(
        str(tmp_path / "lf"), schema="k int, v string", sep=delimiter, header=True, escape='"', multiLine=True
    )
    assert sorted(map(tuple, back.collect())) == [(i, v or None) for i, v in enumerate(cells)]


def test_line_ends_inside_cells_are_kept(spark, tmp_path):
    df = spark.createDataFrame([(1, "a\nb"), (2, "c\r\nd"), (3, "")], parse_spec(KEYED).schema).coalesce(1)
    write_delimited(df, str(tmp_path / "out"), ",")
    found = [f.read_bytes() for f in (tmp_path / "out").glob("part-*")]
    assert found == [b'k|int|primary_key,v|string|nullable\r\n1,"a\nb"\r\n2,"c\r\nd"\r\n3,""\r\n']


def test_export_without_rows_is_a_header(spark, tmp_path):
    write_delimited(spark.createDataFrame([], parse_spec(KEYED).schema), str(tmp_path / "out"))
    assert b"".join(f.read_bytes() for f in (tmp_path / "out").glob("part-*")) == b"k|int|primary_key\tv|string|nullable\r\n"


def test_export_then_load_is_the_identity(spark, tmp_path):
    spec = parse_spec("k|int|$primary_key,d|double,v|string|nullable,t|long|timestamp|nullable")
    cells = [v for v in ODD if v is None or (v.strip() == v and "\n" not in v and "\r" not in v)]
    data = [(i, i / 7, v) for i, v in enumerate(cells)]
    df = spark.createDataFrame(data, "k int, d double, v string").select(
        *[F.col(c).alias(c, metadata=spec.schema[c].metadata) for c in "kdv"],
        F.when(F.col("k") % 3 != 0, F.timestamp_millis(F.col("k") * 1001)).alias("t", metadata=spec.schema["t"].metadata),
    )
    write_delimited(df, str(tmp_path / "out"), ",")
    header = spark.read.csv(str(tmp_path / "out"), header=True).columns
    assert header == spec.header_cells()
    lines = read_lines(spark, str(tmp_path / "out"))
    back = accepted(tag_lines(lines, parse_spec(",".join(header)), Dialect(",")))
    expected = [tuple(None if x == "" else x for x in r) for r in df.collect()]
    assert sorted(map(tuple, back.collect())) == sorted(expected)


def test_record_ends_are_crlf_and_headers_come_first(spark, tmp_path):
    df = spark.createDataFrame([(1, "a\tb"), (2, "\tc"), (3, "d\re"), (4, None)], parse_spec(KEYED).schema).coalesce(1)
    write_delimited(df, str(tmp_path / "out"))
    found = [f.read_bytes() for f in (tmp_path / "out").glob("part-*.txt")]
    assert found == [b'k|int|primary_key\tv|string|nullable\r\n1\t"a\tb"\r\n2\t"\tc"\r\n3\t"d\re"\r\n4\t\r\n']


def test_json_has_null_fields_and_epoch_milliseconds(spark, tmp_path):
    df = spark.sql("SELECT 1 k, CAST(NULL AS STRING) v, TIMESTAMP'2020-01-01 00:00:00Z' t").coalesce(1)
    write_json(df, str(tmp_path / "out"))
    found = [f.read_text() for f in (tmp_path / "out").glob("part-*.json")]
    assert found == ['{"k":1,"v":null,"t":1577836800000}\n']


def test_every_file_of_an_export_has_the_header(spark, tmp_path):
    schema = parse_spec("k|int|$primary_key,v|string|nullable").schema
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "2")
    try:
        write_delimited(spark.createDataFrame([(i, "x") for i in range(7)], schema).coalesce(1), str(tmp_path / "out"))
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    files = sorted(f for f in (tmp_path / "out").iterdir() if f.name[0] not in "._")
    assert [f.suffix for f in files] == [".csv"] * 4
    assert [len(f.read_bytes().split(b"\r\n")) for f in files] == [4, 4, 4, 3]
    assert {f.read_bytes().split(b"\r\n")[0] for f in files} == {b"k|int|primary_key\tv|string|nullable"}


def test_a_feed_reads_on_from_its_entry(spark, put, table, tmp_path):
    """Timestamps and nulls come through, and offsets are numbers of entries."""
    stamped = declare_table(spark, "t" + uuid.uuid4().hex, "k|int|$primary_key,t|long|timestamp|nullable")
    checkpoint, out = str(tmp_path / "checkpoint"), tmp_path / "out"
    assert subscribe(stamped, checkpoint) == subscribe(stamped, checkpoint) == 0
    for i, cells in enumerate(["1,1577836800000\n2,\n", "2,5\n", "3,-1\n4,9999999999999\n"]):
        load_files(spark, put("k,t\n" + cells, folder=f"in{i}"), stamped)
        query = start_json_feed(stamped, str(out), checkpoint)
        query.awaitTermination()
    lines = sorted(line for f in out.glob("batch=*/part-*.json") for line in f.read_text().splitlines())
    assert lines == ['{"k":1,"t":1577836800000}', '{"k":2,"t":null}', '{"k":4,"t":9999999999999}']
    assert query.recentProgress[-1]["sources"][0]["endOffset"] == "{'commit': 3}"


def test_renaming_many_files_looks_up_their_folder_once(spark, tmp_path, monkeypatch):
    for name in [*[f"part-{i:05d}.txt" for i in range(300)], "_SUCCESS", ".part.txt.crc", "other.json"]:
        (tmp_path / name).write_text(name)
    looked_up, plain = [], session._hadoop_path
    monkeypatch.setattr(session, "_hadoop_path", lambda spark, path: looked_up.append(path) or plain(spark, path))
    session.rename_files(spark, str(tmp_path), ".txt", ".csv")
    assert {f.name for f in tmp_path.iterdir()} == {*[f"part-{i:05d}.csv" for i in range(300)], "_SUCCESS", ".part.txt.crc", "other.json"}
    assert (tmp_path / "part-00007.csv").read_text() == "part-00007.txt" and len(looked_up) == 1
