"""The registered queries: one or more per operator, each over the whole given tables."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowgate import DateRule, Dialect, parse_spec
from rowgate.operators import analytics
from rowgate.operators.export import write_delimited, write_json, write_rejects
from rowgate.operators.ingest import load_files, load_records
from rowgate.operators.load import accepted, rejects, stage, tag_attributes, tag_lines
from rowgate.operators.load import load_counts as counts_per_file
from rowgate.operators.merge import conform, insert_or_ignore, insert_or_update, one_per_key
from rowgate.operators.tables import Table, declare_table, read_table
from rowgate.plans import fixtures
from rowgate.plans.fixtures import EVENT_DATES, EVENT_SPEC, attribute_records, delimited, event_files, table
from rowgate.session import configure, new_folder
from rowgate.sources.delimited import read_lines
from rowgate.streaming.feed import start_delimited_feed, start_json_feed, subscribe
from rowgate.streaming.loads import start_file_load, start_record_load

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)

    _QUERIES[function.__name__] = run
    return run


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _wall_clock(name: str) -> Column:
    return F.col(name).cast("timestamp_ntz").alias(name)


def _tagged_events(spark: SparkSession, sf_dir: str, broken: bool = True) -> DataFrame:
    lines = read_lines(spark, event_files(spark, sf_dir, broken))
    return tag_lines(lines, parse_spec(EVENT_SPEC), dates=DateRule(EVENT_DATES, "UTC"))


def _event_rows(rows: DataFrame) -> DataFrame:
    return rows.select("event_id", "user_id", "event_type", "value", _wall_clock("ts"))


def _event_key() -> Column:
    return F.regexp_extract("line", "^[0-9]+", 0).cast("bigint").alias("event_id")


def _new_table(spark: SparkSession, label: str, spec: str, **how) -> Table:
    return declare_table(spark, f"{label}_{uuid.uuid4().hex}", spec, folder=new_folder(spark, label), **how)


# Delimited loads


@query
def load_delimited(spark, sf_dir):
    return _event_rows(accepted(_tagged_events(spark, sf_dir)))


@query
def load_rejects(spark, sf_dir):
    return rejects(_tagged_events(spark, sf_dir)).select(_event_key(), "reason")


@query
def load_reject_fields(spark, sf_dir):
    return rejects(_tagged_events(spark, sf_dir)).select(_event_key(), "field")


@query
def load_reject_reasons(spark, sf_dir):
    return rejects(_tagged_events(spark, sf_dir)).groupBy("reason").agg(F.count("*").alias("n"))


@query
def load_counts(spark, sf_dir):
    counts = counts_per_file(_tagged_events(spark, sf_dir))
    bucket = F.regexp_extract("file", "bucket=([0-9]+)", 1).cast("bigint").alias("bucket")
    return counts.groupBy(bucket).agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))


@query
def load_staged(spark, sf_dir):
    """Both outputs of one parse, read back from the staged load."""
    staged = stage(_tagged_events(spark, sf_dir), parse_spec(EVENT_SPEC))
    good = staged.accepted.select("event_id", F.lit("accepted").alias("outcome"))
    return good.unionByName(staged.rejects.select(_event_key(), F.col("reason").alias("outcome")))


@query
def load_fail_file(spark, sf_dir):
    staged = stage(_tagged_events(spark, sf_dir, broken=False), parse_spec(EVENT_SPEC))
    return staged.accepted_whole_files().select("event_id", "value")


@query
def load_delimited_custom_quote(spark, sf_dir):
    name = F.concat(F.lit(r"'a|\'"), F.col("c_name"), F.lit("'"))
    folder = delimited(spark, sf_dir, "customer-quoted", "customer", ["c_custkey", name, "c_nationkey", "c_acctbal"], "|", False)
    spec = parse_spec("c_custkey|long|$primary_key,c_name|string,c_nationkey|int,c_acctbal|double")
    return accepted(tag_lines(read_lines(spark, folder, has_header=False), spec, Dialect("|", "'", "\\")))


@query
def load_strict_types(spark, sf_dir):
    r = F.col("l_suppkey") % 9
    number = F.col("l_linenumber").cast("string")
    spoilt = F.when(r == 0, F.concat(F.lit(" "), number, F.lit(" "))).when(r == 1, "1.5").otherwise(number)
    folder = delimited(spark, sf_dir, "lineitem", "lineitem", ["l_orderkey", spoilt, "l_quantity", "l_extendedprice"])
    spec = parse_spec("l_orderkey|long,l_linenumber|int,l_quantity|float,l_extendedprice|double")
    return accepted(tag_lines(read_lines(spark, folder), spec))


@query
def load_timestamp_zone(spark, sf_dir):
    written = F.date_format("ts", "dd-MM-yyyy HH:mm:ss")
    folder = delimited(spark, sf_dir, "event-times", "events", ["event_id", written])
    spec = parse_spec("event_id|long|$primary_key,ts|long|timestamp")
    rows = accepted(tag_lines(read_lines(spark, folder), spec, dates=DateRule("dd-MM-yyyy HH:mm:ss", "America/New_York")))
    return rows.select("event_id", _wall_clock("ts"))


@query
def load_timestamp_lenient(spark, sf_dir):
    """Dates written with the month, day, hour and minute beyond their ranges, and text behind them."""
    at = F.col("ts")
    fields = [F.year(at) - 1, F.month(at) + 12, F.dayofmonth(at) - 1, F.hour(at) + 23, F.minute(at) + 59, F.second(at) + 60]
    written = F.concat(*[part for field in fields for part in (field.cast("string"), F.lit(" "))], F.lit("local time"))
    folder = delimited(spark, sf_dir, "event-lenient-times", "events", ["event_id", written])
    spec = parse_spec("event_id|long|$primary_key,ts|long|timestamp")
    rule = DateRule("yyyy MM dd HH mm ss", "America/New_York", lenient=True)
    rows = accepted(tag_lines(read_lines(spark, folder), spec, dates=rule))
    return rows.select("event_id", _wall_clock("ts"))


@query
def load_timestamp_two_digit_year(spark, sf_dir):
    written = F.date_format("o_orderdate", "dd/MM/yy")
    folder = delimited(spark, sf_dir, "orders-short-years", "orders", ["o_orderkey", written])
    spec = parse_spec("o_orderkey|long|$primary_key,o_orderdate|long|timestamp")
    rows = accepted(tag_lines(read_lines(spark, folder), spec, dates=DateRule("dd/MM/yy", "UTC")))
    return rows.select("o_orderkey", _wall_clock("o_orderdate"))


@query
def load_timestamp_hour_twelve(spark, sf_dir):
    written = F.date_format("ts", "yyyy-MM-dd hh:mm:ss")
    folder = delimited(spark, sf_dir, "events-hours", "events", ["event_id", written])
    spec = parse_spec("event_id|long|$primary_key,ts|long|timestamp")
    rule = DateRule("yyyy-MM-dd hh:mm:ss", "UTC")
    rows = accepted(tag_lines(read_lines(spark, folder), spec, dates=rule))
    return rows.select("event_id", _wall_clock("ts"))


# Attribute records


def _order_entries() -> dict[str, Column]:
    k, status = F.col("o_orderkey"), F.col("o_orderstatus")
    return {
        "o_orderkey": k,
        "o_custkey": F.col("o_custkey"),
        "o_orderstatus": F.when(k % 5 == 0, F.concat(F.lit("  "), status, F.lit(" "))).when(k % 5 == 1, "   ").otherwise(status),
        "o_totalprice": F.col("o_totalprice"),
        "o_orderdate": F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"),
        "o_orderpriority": F.when(k % 7 != 0, F.col("o_orderpriority")),
        "zz": F.lit("extra"),
    }


_ORDER_SPEC = (
    "o_orderkey|long|$primary_key,o_custkey|long,o_orderstatus|string,o_totalprice|double,"
    "o_orderdate|long|timestamp,o_orderpriority|string"
)
_ORDER_DATES = DateRule("yyyy-MM-dd HH:mm:ss", "UTC")


def _order_records(spark: SparkSession, sf_dir: str) -> str:
    other_case = F.when(F.col("o_orderkey") % 11 == 0, "O_CUSTKEY").otherwise("o_custkey")
    return attribute_records(spark, sf_dir, "order-records", "orders", _order_entries(), {"o_custkey": other_case})


def _order_rows(rows: DataFrame) -> DataFrame:
    return rows.withColumn("o_orderdate", _wall_clock("o_orderdate"))


@query
def load_attributes(spark, sf_dir):
    records = spark.read.parquet(_order_records(spark, sf_dir))
    return _order_rows(accepted(tag_attributes(records, "attrs", parse_spec(_ORDER_SPEC), _ORDER_DATES)))


@query
def load_attributes_lenient(spark, sf_dir):
    k = F.col("o_orderkey")
    price = F.col("o_totalprice").cast("string")
    entries = {
        "o_orderkey": k,
        "o_custkey": F.when(k % 10 == 3, "1.5").otherwise(F.col("o_custkey").cast("string")),
        "o_totalprice": F.when(k % 6 == 0, "n/a").when(k % 6 == 1, "  ").when(k % 6 != 2, price),
    }
    folder = attribute_records(spark, sf_dir, "orders-lenient", "orders", entries)
    spec = parse_spec("o_orderkey|long|$primary_key,o_custkey|long,o_totalprice|double")
    return accepted(tag_attributes(spark.read.parquet(folder), "attrs", spec))


_DATED_SPEC = "o_orderkey|long|$primary_key,o_orderdate|long|timestamp"


def _records_with_bad_dates(spark: SparkSession, sf_dir: str) -> str:
    written = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    entries = {"o_orderkey": F.col("o_orderkey"), "o_orderdate": F.when(F.col("o_orderkey") % 13 == 4, "soon").otherwise(written)}
    return attribute_records(spark, sf_dir, "orders-dates", "orders", entries)


def _orders_with_bad_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = spark.read.parquet(_records_with_bad_dates(spark, sf_dir))
    return tag_attributes(records, "attrs", parse_spec(_DATED_SPEC), _ORDER_DATES)


@query
def load_attributes_failures(spark, sf_dir):
    failed = rejects(_orders_with_bad_dates(spark, sf_dir))
    key = F.get_json_object("line", "$.o_orderkey").cast("bigint").alias("o_orderkey")
    return failed.select(key, "reason")


@query
def load_attributes_successes(spark, sf_dir):
    return _order_rows(accepted(_orders_with_bad_dates(spark, sf_dir)))


# Keyed writes


def _stored_and_incoming(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All orders are stored; all come in again one dearer, two thirds of them under a new key."""
    stored = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    key = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderkey")).otherwise(-F.col("o_orderkey"))
    return stored, stored.select(key.alias("o_orderkey"), "o_custkey", (F.col("o_totalprice") + 1).alias("o_totalprice"))


@query
def upsert_update(spark, sf_dir):
    return insert_or_update(*_stored_and_incoming(spark, sf_dir), ["o_orderkey"])


@query
def upsert_ignore(spark, sf_dir):
    return insert_or_ignore(*_stored_and_incoming(spark, sf_dir), ["o_orderkey"])


@query
def upsert_composite(spark, sf_dir):
    stored = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    edits = F.explode(
        F.array(
            F.struct(F.col("turn"), F.lit("edited").alias("role")),
            F.struct(F.lit(1000).cast("bigint").alias("turn"), F.lit("new").alias("role")),
        )
    )
    incoming = stored.where("turn = 0").select("conv_id", edits.alias("e")).select("conv_id", "e.turn", "e.role")
    return insert_or_update(stored, incoming, ["conv_id", "turn"])


@query
def upsert_dup_in_load(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    occurrences = F.array(
        *[F.struct(F.lit(n).alias("seq"), (F.col("o_totalprice") * n).alias("o_totalprice")) for n in (1, 2)]
    )
    incoming = orders.select("o_orderkey", F.explode(occurrences).alias("t")).select("o_orderkey", "t.*")
    empty = orders.where(F.lit(False))
    keys, columns = ["o_orderkey"], ["o_orderkey", "o_totalprice"]
    last = one_per_key(incoming, keys, F.struct("seq"), columns, "last")
    first = one_per_key(incoming, keys, F.struct("seq"), columns, "first")
    updated = insert_or_update(empty, last, keys).withColumn("mode", F.lit("update"))
    return updated.unionByName(insert_or_ignore(empty, first, keys).withColumn("mode", F.lit("ignore")))


@query
def upsert_hot_key(spark, sf_dir):
    """Line items as an ordered load keyed by order, a third of them moved onto one hot key."""
    lines = table(spark, sf_dir, "lineitem")
    key = F.when(F.col("l_suppkey") % 3 == 0, F.lit(0).cast("bigint")).otherwise(F.col("l_orderkey"))
    incoming = lines.select(key.alias("key"), "l_extendedprice", "l_partkey", "l_suppkey", "l_linenumber")
    order = F.struct("l_extendedprice", "l_partkey", "l_suppkey", "l_linenumber")
    return one_per_key(incoming, ["key"], order, ["key", "l_extendedprice", "l_partkey"], "last")


@query
def append_keyless(spark, sf_dir):
    bag = _new_table(spark, "append", "o_orderkey|long,o_totalprice|double")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    for load_id in ("first", "second"):
        bag.write(orders, F.col("o_orderkey"), load_id)
    return bag.read().groupBy("o_orderkey").agg(F.count("*").alias("n"))


@query
def conform_to_table(spark, sf_dir):
    stored = _new_table(spark, "conform", "o_orderkey|long|$primary_key,o_custkey|long,o_orderstatus|string")
    folder = delimited(spark, sf_dir, "orders-text", "orders", ["o_orderkey", "o_custkey", "o_orderstatus"])
    again = declare_table(spark, stored.name, "o_orderkey|long,o_custkey|string,o_orderstatus|string")
    load_files(spark, folder, again)
    return stored.read()


@query
def conform_types(spark, sf_dir):
    """Rows with other types and another column order take the stored schema."""
    spec = parse_spec("o_orderkey|long,o_custkey|long,o_totalprice|double")
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_totalprice", "cast(o_custkey as int) o_custkey", "cast(o_orderkey as string) o_orderkey"
    )
    return conform(rows, spec.schema)


@query
def table_load_and_update(spark, sf_dir):
    """Files into a keyed table, then all events again as an updating load of attribute records."""
    stored = _new_table(spark, "events", EVENT_SPEC)
    dates = DateRule(EVENT_DATES, "UTC")
    load_files(spark, event_files(spark, sf_dir), stored, dates=dates)
    k = F.col("event_id")
    entries = {
        "event_id": F.when(k % 2 == 0, k).otherwise(-k),
        "user_id": F.col("user_id"),
        "event_type": F.lit("update"),
        "value": F.col("value"),
        "ts": F.date_format("ts", EVENT_DATES),
    }
    records = spark.read.parquet(attribute_records(spark, sf_dir, "event-updates", "events", entries))
    load_records(records, "attrs", stored, dates, update=True)
    return _event_rows(stored.read())


@query
def table_insert_log(spark, sf_dir):
    """The append-only log after an inserting and an updating load holds the inserted rows only."""
    stored = _new_table(spark, "logged", "o_orderkey|long|$primary_key,o_custkey|long,o_totalprice|double")
    before, incoming = _stored_and_incoming(spark, sf_dir)
    stored.write(before, F.col("o_orderkey"), "stored")
    stored.write(incoming, F.col("o_orderkey"), "incoming", update=True)
    return stored.inserted().drop("load")


PAGE = 50
_ORDER_PRICES = "o_orderkey|long|$primary_key,o_custkey|long,o_totalprice|double"


@query
def upsert_touched_buckets(spark, sf_dir):
    """One order in a hundred becomes dearer in a table of 64 buckets, then one order alone."""
    stored, orders = _new_table(spark, "bucketed", _ORDER_PRICES, buckets=64), _stored_and_incoming(spark, sf_dir)[0]
    dearer = orders.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    stored.write(orders, F.col("o_orderkey"), "all")
    stored.write(dearer.where("o_orderkey % 100 = 1"), F.col("o_orderkey"), "some", update=True)
    stored.write(dearer.where("o_orderkey = 2"), F.col("o_orderkey"), "one", update=True)
    return stored.read()


@query
def table_two_writers(spark, sf_dir):
    """Two loads at the same time: one updates all stored orders and adds some, the other adds more."""
    stored = _new_table(spark, "shared", _ORDER_PRICES)
    before, incoming = _stored_and_incoming(spark, sf_dir)
    stored.write(before, F.col("o_orderkey"), "stored")
    others = before.withColumn("o_orderkey", F.lit(10_000_000_000) + F.col("o_orderkey"))
    with ThreadPoolExecutor(2) as pool:
        loads = [(incoming, "incoming", True), (others, "others", False)]
        for done in [pool.submit(stored.write, rows, F.col("o_orderkey"), load, update) for rows, load, update in loads]:
            done.result()
    return stored.read()


@query
def replicated_lookup(spark, sf_dir):
    nations = _new_table(spark, "nation", "n_nationkey|int|$primary_key,n_name|string,n_regionkey|int", replicated=True)
    nations.write(table(spark, sf_dir, "nation"), F.col("n_nationkey"), "nations")
    customers = table(spark, sf_dir, "customer")
    joined = customers.join(read_table(spark, nations.name), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("n_name").agg(F.count("*").alias("customers"))


# Streaming loads and the change feed


def _loaded_batches(loaded: Table) -> DataFrame:
    return loaded.inserted().agg(F.count("*").alias("accepted"), F.count_distinct("load").alias("batches"))


@query
def stream_batch_cap(spark, sf_dir):
    loaded = _new_table(spark, "stream", EVENT_SPEC)
    start_file_load(
        spark,
        event_files(spark, sf_dir),
        loaded,
        new_folder(spark, "checkpoint"),
        dates=DateRule(EVENT_DATES, "UTC"),
        files_per_trigger=2,
    ).awaitTermination()
    return _loaded_batches(loaded)


@query
def stream_load_rows(spark, sf_dir):
    """The streaming load of the event files gives the rows of the batch load."""
    loaded = _new_table(spark, "streamrows", EVENT_SPEC)
    checkpoint = new_folder(spark, "checkpoint")
    start_file_load(
        spark, event_files(spark, sf_dir), loaded, checkpoint, dates=DateRule(EVENT_DATES, "UTC"), files_per_trigger=3
    ).awaitTermination()
    return _event_rows(loaded.read())


@query
def stream_load_attributes(spark, sf_dir):
    """Attribute records arriving as files, loaded as a stream."""
    loaded = _new_table(spark, "orders", _ORDER_SPEC)
    records = spark.readStream.schema("attrs map<string,string>").parquet(_order_records(spark, sf_dir))
    start_record_load(records, "attrs", loaded, new_folder(spark, "checkpoint"), _ORDER_DATES).awaitTermination()
    return _order_rows(loaded.read())


@query
def stream_two_sources(spark, sf_dir):
    """Two folders, loaded as two streams with checkpoints of their own into one table."""
    loaded = _new_table(spark, "orders", _ORDER_SPEC)
    records = spark.read.schema("attrs map<string,string>").parquet(_order_records(spark, sf_dir))
    even = F.pmod(F.xxhash64(F.map_entries("attrs")), F.lit(2)) == 0
    for half in (even, ~even):
        folder = new_folder(spark, "half")
        records.where(half).write.parquet(folder)
        source = spark.readStream.schema("attrs map<string,string>").parquet(folder)
        start_record_load(source, "attrs", loaded, new_folder(spark, "checkpoint"), _ORDER_DATES).awaitTermination()
    return _order_rows(loaded.read())


@query
def stream_load_rejects(spark, sf_dir):
    """The reject files that a streaming load writes, batch by batch."""
    loaded, out = _new_table(spark, "stream", EVENT_SPEC), new_folder(spark, "rejects")
    start_file_load(
        spark,
        event_files(spark, sf_dir),
        loaded,
        new_folder(spark, "checkpoint"),
        dates=DateRule(EVENT_DATES, "UTC"),
        files_per_trigger=4,
        rejects=out,
    ).awaitTermination()
    lines = spark.read.schema("value string").text(out).where(F.col("value") != fixtures.EVENT_HEADER)
    return lines.withColumnRenamed("value", "line").select(_event_key())


@query
def stream_attribute_failures(spark, sf_dir):
    """The failed records of a stream, as their reject files hold them."""
    out = new_folder(spark, "rejects")
    loaded = _new_table(spark, "dated", _DATED_SPEC)
    records = spark.readStream.schema("attrs map<string,string>").parquet(_records_with_bad_dates(spark, sf_dir))
    start_record_load(
        records, "attrs", loaded, new_folder(spark, "checkpoint"), _ORDER_DATES, rejects=out
    ).awaitTermination()
    parsed = spark.read.schema("value string").text(out).select(F.from_json("value", "map<string,string>").alias("attrs"))
    return parsed.select(F.col("attrs.o_orderkey").cast("bigint").alias("o_orderkey"))


@query
def load_failed_files(spark, sf_dir):
    """The files that one bad row kept out, with their rejects."""
    loaded, out = _new_table(spark, "whole", EVENT_SPEC), new_folder(spark, "failed")
    dates = DateRule(EVENT_DATES, "UTC")
    load_files(spark, event_files(spark, sf_dir, broken=False), loaded, dates=dates, skip_errors=False).export_failed_files(out)
    failed = spark.read.schema("file string, rejected bigint").json(out)
    bucket = F.regexp_extract("file", "bucket=([0-9]+)", 1).cast("bigint").alias("bucket")
    return failed.groupBy(bucket).agg(F.sum("rejected").alias("rejected"))


@query
def load_blank_lines(spark, sf_dir):
    """Orders with an empty line and a line of blanks after some of them, with and without a header."""
    after = F.when(F.col("o_orderkey") % 5 == 0, "\n").when(F.col("o_orderkey") % 5 == 1, "\n \t").otherwise("")
    line = F.concat(F.concat_ws(",", "o_orderkey", "o_orderstatus"), after).alias("line")
    outcomes = []
    for header in (True, False):
        folder = new_folder(spark, "orders-blank")
        fixtures.write_text(table(spark, sf_dir, "orders").select(line), folder, "k,s" if header else None)
        tagged = tag_lines(read_lines(spark, folder, header), parse_spec("k|long|$primary_key,s|string"))
        outcome = F.coalesce(F.col("_load.reason"), F.lit("accepted")).alias("outcome")
        counted = tagged.select(outcome).where("outcome != 'header'").groupBy("outcome").agg(F.count("*").alias("n"))
        outcomes.append(counted.select(F.lit(header).alias("has_header"), "outcome", "n"))
    return outcomes[0].unionByName(outcomes[1])


@query
def table_retry_after_other_load(spark, sf_dir):
    """An updating load stops once its rows are written, another load comes, then it is retried."""
    stored = _new_table(spark, "retry", "o_orderkey|long|$primary_key,o_custkey|long,o_totalprice|double")
    before, incoming = _stored_and_incoming(spark, sf_dir)
    stored.write(before, F.col("o_orderkey"), "stored")
    conform(incoming, stored.spec.schema).write.parquet(f"{stored.data}/lost-merged/_b=0")
    others = before.withColumn("o_orderkey", F.lit(10_000_000_000) + F.col("o_orderkey"))
    stored.write(others, F.col("o_orderkey"), "others")
    stored.write(incoming, F.col("o_orderkey"), "incoming", update=True)
    return stored.read()


@query
def collection_tables(spark, sf_dir):
    """A table declared in a collection is found by its full name."""
    collection = f"c_{uuid.uuid4().hex}"
    spec = "n_nationkey|int|$primary_key,n_name|string"
    nations = declare_table(spark, "nation", spec, collection=collection, folder=new_folder(spark, "collection"))
    nations.write(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), F.col("n_nationkey"), "nations")
    return read_table(spark, f"{collection}.nation")


@query
def feed_read_counts(spark, sf_dir):
    """Rows read per trigger, as the feed's own progress reports them."""
    feed = _new_table(spark, "feed", EVENT_SPEC)
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    checkpoint, out, found = new_folder(spark, "checkpoint"), new_folder(spark, "out"), []
    subscribe(feed, checkpoint)
    for part in (0, 1, 2):
        feed.write(events.where(f"event_id % 3 = {part}"), F.col("event_id"), f"part-{part}")
        drained = start_json_feed(feed, out, checkpoint)
        drained.awaitTermination()
        found.append((part, sum(p["numInputRows"] for p in drained.recentProgress)))
    return spark.createDataFrame(found, "part int, n bigint")


@query
def page_records_all(spark, sf_dir):
    """All conversations, in pages by a key of two columns."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    return analytics.number_pages(rows, ["conv_id", "turn"], PAGE).drop("page")


@query
def page_records_numbered(spark, sf_dir):
    """The page of every conversation's turn."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn")
    return analytics.number_pages(rows, ["conv_id", "turn"], PAGE)


def _table_with_new_rows(spark: SparkSession, sf_dir: str, start) -> str:
    """Store a third of the events, subscribe, insert the others, drain the feed into files."""
    feed = _new_table(spark, "feed", EVENT_SPEC)
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    checkpoint, out = new_folder(spark, "checkpoint"), new_folder(spark, "out")
    feed.write(events.where("event_id % 3 = 0"), F.col("event_id"), "before")
    subscribe(feed, checkpoint)
    for part in (1, 2):
        feed.write(events.where(f"event_id % 3 = {part}"), F.col("event_id"), f"after-{part}")
        start(feed, out, checkpoint).awaitTermination()
    return out


@query
def change_feed_new_rows(spark, sf_dir):
    out = _table_with_new_rows(spark, sf_dir, start_delimited_feed)
    lines = read_lines(spark, out)
    rows = accepted(tag_lines(lines, parse_spec(EVENT_SPEC), Dialect("\t")))
    return rows.select("event_id", "user_id", "event_type", "value")


@query
def change_feed_json(spark, sf_dir):
    out = _table_with_new_rows(spark, sf_dir, start_json_feed)
    return spark.read.schema("event_id bigint, user_id bigint, event_type string, value double, batch int").json(out).select(
        "event_id", "value", "batch"
    )


@query
def change_feed_commit_log(spark, sf_dir):
    """Entry by entry: an insert, an update with new keys, a load of known keys; three triggers."""
    stored = _new_table(spark, "feed", _ORDER_PRICES)
    before, incoming = _stored_and_incoming(spark, sf_dir)
    checkpoint, out = new_folder(spark, "checkpoint"), new_folder(spark, "out")
    stored.write(before.where("o_orderkey % 2 = 0"), F.col("o_orderkey"), "before")
    subscribe(stored, checkpoint)
    for rows, load, update in [(before, "rest", False), (incoming, "incoming", True), (before, "known", False)]:
        stored.write(rows, F.col("o_orderkey"), load, update)
        start_json_feed(stored, out, checkpoint).awaitTermination()
    return spark.read.schema("o_orderkey bigint, o_totalprice double, batch int").json(out)


@query
def change_feed_after_failed_load(spark, sf_dir):
    """A load that stopped after its rows were written, then the same load again: each row once."""
    feed = _new_table(spark, "feed", EVENT_SPEC)
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    checkpoint, out = new_folder(spark, "checkpoint"), new_folder(spark, "out")
    subscribe(feed, checkpoint)
    conform(events, feed.spec.schema).write.parquet(f"{feed.data}/lost/_b=0")
    start_delimited_feed(feed, out, checkpoint).awaitTermination()
    for _ in range(2):
        feed.write(events, F.col("event_id"), "load")
        start_delimited_feed(feed, out, checkpoint).awaitTermination()
    rows = accepted(tag_lines(read_lines(spark, out), parse_spec(EVENT_SPEC), Dialect("\t")))
    return rows.select("event_id", "user_id", "event_type", "value")


# Exports


def _typed_events(spark: SparkSession, sf_dir: str, event_type: Column) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return conform(events.withColumn("event_type", event_type), parse_spec(EVENT_SPEC).schema)


def _awkward_type() -> Column:
    r = F.col("event_id") % 40
    return F.when(r == 1, '\t"x\ny').when(r != 2, F.col("event_type"))


@query
def export_delimited(spark, sf_dir):
    folder = new_folder(spark, "export")
    write_delimited(_typed_events(spark, sf_dir, _awkward_type()), folder)
    schema = "event_id bigint, user_id bigint, event_type string, value double, ts bigint"
    back = spark.read.schema(schema).csv(
        folder, sep="\t", header=True, escape='"', multiLine=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    return back.select("event_id", "event_type", "value")


@query
def export_raw_cells(spark, sf_dir):
    """Each record up to its CRLF as it stands in the file, with line ends inside cells."""
    r = F.col("event_id") % 40
    kind = F.when(r == 1, "a\nb").when(r == 2, "c\rd").when(r == 3, 'e"f').when(r != 4, F.col("event_type"))
    rows = _typed_events(spark, sf_dir, kind).select("event_id", "event_type")
    folder = new_folder(spark, "export")
    write_delimited(rows, folder, ",")
    records = spark.read.schema("value string").option("lineSep", "\r\n").text(folder)
    return records.where(F.col("value").rlike("^[0-9]")).withColumnRenamed("value", "record")


@query
def export_file_names(spark, sf_dir):
    """Files of at most 300 rows: their ending, and the rows behind a header in each."""
    folder = new_folder(spark, "export")
    with_cap, cap = "spark.sql.files.maxRecordsPerFile", spark.conf.get("spark.sql.files.maxRecordsPerFile")
    spark.conf.set(with_cap, "300")
    try:
        # So many small files take longer to create than their rows to move: all cores share them.
        write_delimited(_typed_events(spark, sf_dir, F.col("event_type")).repartition(spark.sparkContext.defaultParallelism), folder)
    finally:
        spark.conf.set(with_cap, cap)
    lines = spark.read.option("lineSep", "\r\n").text(folder).select("value", F.col("_metadata.file_name").alias("file"))
    is_header = F.startswith("value", F.lit("event_id|long|"))
    files = lines.groupBy("file").agg(F.count_if(is_header).alias("headers"), F.count_if(~is_header).alias("rows"))
    ending = F.concat(F.lit("."), F.substring_index("file", ".", -1)).alias("ending")
    return files.groupBy(ending, "headers").agg(F.sum("rows").alias("n"), F.max(F.col("rows") <= 300).alias("capped"))


@query
def export_typed_header(spark, sf_dir):
    """The header cells found in the exported files, each with the number of values below it."""
    folder = new_folder(spark, "export")
    no_type = F.when(F.col("event_id") % 40 != 2, F.col("event_type"))
    write_delimited(_typed_events(spark, sf_dir, no_type), folder)
    exported = spark.read.csv(folder, sep="\t", header=True, escape='"')
    described = F.array(
        *[
            F.struct(F.lit(i).alias("pos"), F.lit(cell).alias("cell"), F.count(f"`{cell}`").alias("n"))
            for i, cell in enumerate(exported.columns)
        ]
    )
    return exported.agg(described.alias("cells")).select(F.inline("cells"))


@query
def export_round_trip(spark, sf_dir):
    """An exported file describes itself: its header is the specification that loads it again."""
    folder = new_folder(spark, "export")
    write_delimited(_typed_events(spark, sf_dir, F.col("event_type")), folder, delimiter=",")
    header = spark.read.csv(folder, header=True).columns
    return _event_rows(accepted(tag_lines(read_lines(spark, folder), parse_spec(",".join(header)))))


@query
def export_json(spark, sf_dir):
    folder = new_folder(spark, "export")
    write_json(_typed_events(spark, sf_dir, F.when(F.col("event_id") % 40 != 2, F.col("event_type"))), folder)
    lines = spark.read.text(folder)
    parsed = lines.select(F.from_json("value", "event_id bigint, event_type string, value double").alias("j"), "value")
    return parsed.select("j.event_id", "j.event_type", "j.value", F.col("value").contains('"event_type":').alias("has_type_key"))


@query
def export_rejects(spark, sf_dir):
    """Reject files: per source bucket the header and the raw lines that were rejected."""
    staged = stage(_tagged_events(spark, sf_dir), parse_spec(EVENT_SPEC))
    folder = new_folder(spark, "rejects")
    write_rejects(staged.rejects, folder, staged.headers)
    lines = spark.read.text(folder).where(F.col("value") != fixtures.EVENT_HEADER)
    delimiters = (F.size(F.split("line", ",", -1)) - 1).cast("bigint").alias("delimiters")
    return lines.withColumnRenamed("value", "line").select(_event_key(), delimiters)


# Table functions


@query
def groupby_having(spark, sf_dir):
    counted = [F.count("*").alias("n")]
    return analytics.groupby_having(table(spark, sf_dir, "events"), ["user_id"], counted, F.col("n") > 70)


@query
def stat_percentile(spark, sf_dir):
    found = analytics.percentile(table(spark, sf_dir, "events"), "event_type", "value", 0.9)
    return found.select("event_type", F.round("percentile", 6).alias("p90"))


@query
def filter_in_list(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return analytics.filter_by_list(events, "event_type", ["view", "click"]).select("event_id", "event_type")


@query
def filter_not_in_list(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return analytics.filter_by_list(events, "event_type", ["view", "click"], not_in_list=True).select("event_id", "event_type")


@query
def filter_in_list_table(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    listed = table(spark, sf_dir, "customer").where("c_acctbal < 0").select("c_custkey")
    return analytics.filter_by_list(orders, "o_custkey", listed)


@query
def filter_not_in_list_table(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    listed = table(spark, sf_dir, "customer").where("c_acctbal < 0").select("c_custkey")
    return analytics.filter_by_list(orders, "o_custkey", listed, not_in_list=True)


@query
def page_records(spark, sf_dir):
    return analytics.page_records(table(spark, sf_dir, "events").select("event_id", "user_id"), "event_id", 499, 100)
