"""Declared tables: a catalog entry whose location is the pointer to the current data.

Below the folder of a table, ``commits`` is its ordered log (see ``commits``), ``data/<name>`` holds the
rows one load wrote, and ``work`` what a load needs on the way. A table with a key has buckets by a
hash of it; each folder under ``data`` has a folder for each bucket it reaches into. A bucket is the
union of the folders that the last entry names for it, and the location is a pattern of exactly
these, so one catalog call moves the pointers of all buckets together.

An inserting load adds a folder and reads the keys of the buckets it reaches only. An updating load
adds its new keys in the same way and rewrites the buckets in which a stored row changes; the others
keep their files. A bucket of ``SEGMENTS`` folders is merged by the next load that reaches it.

The entry of a load makes its rows visible to the table and to feeds at once. A load that finds that
another one has committed meanwhile starts anew if their buckets meet and else only takes the next
number. What stops before its entry has no effect; a repeated load with the same id finds its entry
and does nothing. If the pointer was not moved after the entry, opening the table moves it.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowgate.operators import commits
from rowgate.operators.merge import conform, insert_or_update, new_rows, one_per_key
from rowgate.session import delete_folder, folder_bytes, has_mark, is_complete, list_folders, move_folder, publish_text, put_mark, read_text, same_folder
from rowgate.spec import TableSpec, parse_spec, ref

FOLDER, REPLICATED, BUCKETS, MEASURED = "rowgate.folder", "rowgate.replicated", "rowgate.buckets", "rowgate.measured"
PENDING = "_rejects-not-exported"  # mark in the working folder of a load
BROADCAST_BYTES = 32 * 1024 * 1024
BROADCAST_ROWS = 1_000_000
SEGMENTS, ATTEMPTS = 8, 20
_BUCKET = "_b"


@dataclass(frozen=True)
class Table:
    """A catalog table. Without a ``folder`` it was made elsewhere and is only appended to."""

    spark: SparkSession
    name: str
    spec: TableSpec
    folder: str | None
    replicated: bool
    buckets: int = 0

    @property
    def data(self) -> str:
        return f"{self.folder}/data"

    @property
    def location(self) -> str:
        return _describe(self.spark, self.name)["Location"].rstrip("/")

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def inserted(self) -> DataFrame:
        """All rows that loads have inserted, as ``load`` and the columns of the table. Reads the whole
        log of entries; feeds read on from where they are."""
        found = commits.between(self.spark, self.folder, 0, commits.last(self.spark, self.folder)["number"])
        named = [(name, e["load"]) for e in found for name in e["inserted"]]
        loads = self.spark.createDataFrame(named, "name string, load string")
        rows = self._files([f"{self.data}/{name}" for name, _ in named])
        name = F.regexp_extract("_metadata.file_path", f".*/data/([^/]+)/(?:{_BUCKET}=\\d+/)?[^/]+$", 1)
        named_rows = rows.select(name.alias("name"), *map(ref, self.spec.names))
        return named_rows.join(F.broadcast(loads), "name").drop("name")  # a row a load, already here; a shuffle would put each load into one task

    def work_folder(self, load_id: str) -> str:
        return f"{self.folder}/work/load={load_id}"

    def holds_load(self, load_id: str) -> bool:
        if self.folder is None:
            return False
        if has_mark(self.spark, f"{self.folder}/loads/{load_id}"):
            return True
        begun = read_text(self.spark, f"{self.work_folder(load_id)}/begun")
        if begun is None:
            return False
        last = commits.last(self.spark, self.folder)["number"]
        return any(e["load"] == load_id for e in commits.between(self.spark, self.folder, int(begun), last))

    def write(self, rows: DataFrame, order: Column, load_id: str, update: bool = False) -> None:
        """Insert ``rows``. With a key, a row whose key is stored replaces it (``update``) or is
        dropped; of several rows with one key the last (``update``) or the first one counts."""
        if self.folder is None:
            if update:
                raise ValueError(f"{self.name} was not declared here: rows can be appended to it, not updated")
            conform(rows, self.spec.schema).write.insertInto(self.name)
        elif not self.holds_load(load_id):
            first = commits.last(self.spark, self.folder)["number"]
            publish_text(self.spark, f"{self.work_folder(load_id)}/begun", str(first))
            if self.spec.keys:
                self._write_keyed(rows, order, load_id, update)
            else:
                self._append(rows, load_id)
            put_mark(self.spark, f"{self.folder}/loads/{load_id}")
        self.settle()

    def drop_old_data(self, unexported_rejects: bool = False) -> list[str]:
        """Delete rewritten buckets the table no longer points at and the working folders of finished
        loads, but for those with rejects that ``LoadReport.export_rejects`` has not written anywhere,
        unless ``unexported_rejects`` gives these up too. What a load inserted stays for the feeds.

        Readers may still use the data before an update; call this when there are none. Returns the
        deleted folders.
        """
        if self.folder is None:
            return []
        live, old = _folders(commits.last(self.spark, self.folder)["live"]), []
        for name in (path.rsplit("/", 1)[-1] for path in list_folders(self.spark, self.data)):
            if name.endswith("-merged"):
                buckets = [path.rsplit("=", 1)[-1] for path in list_folders(self.spark, f"{self.data}/{name}")]
                gone = [f"{self.data}/{name}/{_BUCKET}={k}" for k in buckets if int(k) not in live.get(name, ())]
                old += [f"{self.data}/{name}"] if len(gone) == len(buckets) else gone
        for work in list_folders(self.spark, f"{self.folder}/work"):
            kept, load_id = has_mark(self.spark, f"{work}/{PENDING}") and not unexported_rejects, work.rsplit("/load=", 1)[-1]
            if not kept and self.holds_load(load_id):
                put_mark(self.spark, f"{self.folder}/loads/{load_id}")
                old.append(work)
        for path in old:
            delete_folder(self.spark, path)
        return old

    def drop(self) -> None:
        """Remove the table and, if it was declared here, all its data."""
        self.spark.sql(f"DROP TABLE {self.name}")
        if self.folder is not None:
            delete_folder(self.spark, self.folder)

    def settle(self) -> None:
        """Let the catalog point at what the last entry names."""
        if self.folder is not None and self.spec.keys:
            wanted = _pattern(self.data, commits.last(self.spark, self.folder)["live"])
            if not same_folder(self.location, wanted):
                self.spark.sql(f"ALTER TABLE {self.name} SET LOCATION {_text(wanted)}")
        self.spark.catalog.refreshTable(self.name)
        if self.replicated:
            measured = f"{folder_bytes(self.spark, self.location)} bytes, {self.read().count()} rows"
            self.spark.sql(f"ALTER TABLE {self.name} SET TBLPROPERTIES ('{MEASURED}' = '{measured}')")

    def _files(self, paths: list[str]) -> DataFrame:
        reader = self.spark.read.schema(self.spec.schema).option("recursiveFileLookup", True)
        return reader.parquet(*(paths or [f"{self.data}/none"]))

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(_BUCKET, self._bucket())

    def _append(self, rows: DataFrame, load_id: str) -> None:
        name = f"load={load_id}"
        if not is_complete(self.spark, f"{self.data}/{name}"):
            aside = f"{self.work_folder(load_id)}/aside"
            conform(rows, self.spec.schema).write.mode("overwrite").parquet(aside)
            move_folder(self.spark, aside, f"{self.data}/{name}")
        for _ in range(ATTEMPTS):
            number = commits.last(self.spark, self.folder)["number"] + 1
            if commits.add(self.spark, self.folder, {"number": number, "load": load_id, "inserted": [name], "touched": [], "live": {}}):
                return
        raise RuntimeError(f"other loads into {self.name} took {ATTEMPTS} numbers; repeat load {load_id}")

    def _write_keyed(self, rows: DataFrame, order: Column, load_id: str, update: bool) -> None:
        keys, columns, work = self.spec.keys, self.spec.names, self.work_folder(load_id)
        chosen = one_per_key(rows, keys, order, columns, "last" if update else "first")
        path = f"{work}/incoming"
        if is_complete(self.spark, path):
            counted = self._bucketed(self._files([path])).groupBy(_BUCKET).count().collect()  # a row for each bucket
            reached = {int(r[_BUCKET]): r["count"] for r in counted}
        else:
            reached = self._counted(conform(chosen, self.spec.schema), lambda rows: _write_once(rows, path))
        incoming = self._files([path])
        for _ in range(ATTEMPTS):
            base = commits.last(self.spark, self.folder)
            new = self._prepared(incoming, reached, base, load_id, update)
            while new is not None:
                if commits.add(self.spark, self.folder, new):
                    return
                new = self._rebased(new, base)
        raise RuntimeError(f"other loads into {self.name} changed its buckets {ATTEMPTS} times; repeat load {load_id}")

    def _prepared(self, incoming: DataFrame, reached: dict[int, int], base: dict, load_id: str, update: bool) -> dict:
        """Write what the load adds to, and changes of, the buckets of ``base``; the entry to be added."""
        keys, live = self.spec.keys, {int(k): names for k, names in base["live"].items()}
        name, work = f"{base['number'] + 1}-{uuid.uuid4().hex[:6]}", self.work_folder(load_id)
        stored = self._files([f"{self.data}/{n}/{_BUCKET}={k}" for k in reached for n in live.get(k, ())])
        unknown = self._spread(new_rows(stored, incoming, keys))
        added = self._counted(unknown, lambda rows: self._write(rows, f"{work}/{name}"))
        fresh = self._files([f"{work}/{name}"])
        merged = {k for k in added if len(live.get(k, ())) >= SEGMENTS}
        if update:
            merged |= {k for k, n in reached.items() if added.get(k, 0) < n}
        if merged:
            held = self._files([f"{self.data}/{n}/{_BUCKET}={k}" for k in merged for n in live.get(k, ())])
            wanted = self._bucketed(incoming if update else fresh).where(F.col(_BUCKET).isin(*merged)).drop(_BUCKET)
            self._write(insert_or_update(held, self._spread(wanted), keys), f"{work}/{name}-merged")
            move_folder(self.spark, f"{work}/{name}-merged", f"{self.data}/{name}-merged")
        if added:
            move_folder(self.spark, f"{work}/{name}", f"{self.data}/{name}")
        for k in added.keys() | merged:
            live[k] = [f"{name}-merged"] if k in merged else [*live.get(k, ()), name]
        return {
            "number": base["number"] + 1,
            "load": load_id,
            "name": name,
            "inserted": [name] if added else [],
            "touched": sorted(added.keys() | merged),
            "read": sorted(reached),
            "live": {str(k): names for k, names in sorted(live.items())},
        }

    def _rebased(self, new: dict, base: dict) -> dict | None:
        """The entry behind those added since ``base``, None if one of them touched a bucket it read."""
        last = commits.last(self.spark, self.folder)
        touched = {k for e in commits.between(self.spark, self.folder, base["number"], last["number"]) for k in e["touched"]}
        if touched & set(new["read"]):
            for own in (new["name"], f"{new['name']}-merged"):
                delete_folder(self.spark, f"{self.data}/{own}")
            return None
        return {**new, "number": last["number"] + 1, "live": {**last["live"], **{str(k): new["live"][str(k)] for k in new["touched"]}}}

    def _counted(self, rows: DataFrame, write) -> dict[int, int]:
        """``write(rows)``, and the rows of each bucket that has some, counted on the way."""
        total, bucket = Observation(), self._bucket()
        write(rows.observe(total, *[F.count_if(bucket == k).alias(str(k)) for k in range(self.buckets)]))
        return {int(k): n for k, n in total.get.items() if n}

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*map(ref, self.spec.keys)), F.lit(self.buckets))

    def _spread(self, rows: DataFrame) -> DataFrame:
        """Rows dealt out by bucket, a large bucket to several tasks, so that buckets get few files."""
        return self._bucketed(rows).hint("rebalance", F.col(_BUCKET)).drop(_BUCKET)

    def _write(self, rows: DataFrame, path: str) -> None:
        self._bucketed(rows).write.mode("overwrite").partitionBy(_BUCKET).parquet(path)


def _folders(live: dict[str, list[str]]) -> dict[str, list[int]]:
    """The live buckets of each folder."""
    found = defaultdict(list)
    for k, names in live.items():
        for name in names:
            found[name].append(int(k))
    return found


def _pattern(data: str, live: dict[str, list[str]]) -> str:
    """The location of these folders, and of one without rows."""
    parts = ["none"]
    for name, buckets in sorted(_folders(live).items()):
        numbers = ",".join(map(str, sorted(buckets)))
        parts.append(f"{name}/{_BUCKET}={{{numbers}}}" if len(buckets) > 1 else f"{name}/{_BUCKET}={numbers}")
    return f"{data}/{{{','.join(parts)}}}" if len(parts) > 1 else f"{data}/none"


def declare_table(
    spark: SparkSession,
    name: str,
    spec: str | None = None,
    collection: str | None = None,
    replicated: bool = False,
    folder: str | None = None,
    buckets: int = 8,
) -> Table:
    """Open a table, or create it from ``spec``. A stored table's own type wins over ``spec``.

    ``buckets`` (of a table with a key) is what an update that changes one row rewrites a part of."""
    qualified = ".".join(_quoted(part) for part in ([collection] if collection else []) + name.split("."))
    if spark.catalog.tableExists(qualified):
        return open_table(spark, qualified)
    if spec is None:
        raise ValueError(f"table {name} does not exist: give a specification or create it first")
    parsed = parse_spec(spec)
    if collection:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(collection)}")
    folder = (folder or _default_folder(spark, qualified)).rstrip("/")
    if parsed.keys and (_BUCKET in [n.lower() for n in parsed.names] or re.search(r"[*?{}\[\]\\\\]", folder)):
        raise ValueError(f"a table with a key has no column {_BUCKET!r} and no pattern characters in its folder {folder!r}")
    data = f"{folder}/data/none" if parsed.keys else f"{folder}/data"
    spark.createDataFrame([], parsed.schema).write.parquet(f"{folder}/data/none")
    spark.catalog.createTable(qualified, path=data, source="parquet", schema=parsed.schema, recursiveFileLookup="true")
    spark.sql(
        f"ALTER TABLE {qualified} SET TBLPROPERTIES ('{FOLDER}' = {_text(folder)},"
        f" '{REPLICATED}' = '{str(replicated).lower()}', '{BUCKETS}' = '{buckets}')"
    )
    return open_table(spark, qualified)


def open_table(spark: SparkSession, name: str) -> Table:
    properties = {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    spec = TableSpec(T.StructType(list(spark.table(name).schema)))
    table = Table(spark, name, spec, properties.get(FOLDER), properties.get(REPLICATED) == "true", int(properties.get(BUCKETS, 0)))
    table.settle()
    return table


def read_table(spark: SparkSession, name: str, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The rows of a table; a replicated one is marked for broadcast while its files and rows, as
    measured at its last load, stay within ``broadcast_bytes`` and a million rows."""
    table = open_table(spark, name)
    properties = {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    measured = re.fullmatch(r"(\d+) bytes, (\d+) rows", properties.get(MEASURED, ""))
    small = measured and int(measured[1]) <= broadcast_bytes and int(measured[2]) <= BROADCAST_ROWS
    return F.broadcast(table.read()) if table.replicated and small else table.read()


def _write_once(rows: DataFrame, path: str) -> DataFrame:
    spark = rows.sparkSession
    if not is_complete(spark, path):
        rows.write.mode("overwrite").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _describe(spark: SparkSession, name: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    return {row.col_name: row.data_type for row in rows}


def _default_folder(spark: SparkSession, qualified: str) -> str:
    *database, table = qualified.replace("`", "").split(".")
    found = spark.catalog.getDatabase(database[-1] if database else spark.catalog.currentDatabase())
    return f"{found.locationUri.rstrip('/')}/{table}"


def _text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _quoted(part: str) -> str:
    return "`" + part.strip("`").replace("`", "``") + "`"
