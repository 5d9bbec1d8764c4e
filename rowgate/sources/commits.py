"""A stream over the ordered log of a table: its offsets are the numbers of entries.

Each trigger looks for the entries behind its offset by their numbers, which are without gaps; it
lists neither the log nor data it has delivered. The files that an entry names are read in the tasks,
batch by batch in Arrow. The classes are made inside a function so that they travel with the query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _source_class():
    from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

    def place(path: str):
        """The file system of a path, and the path in it."""
        from pyarrow import fs

        if "://" in path and not path.startswith("file:"):
            return fs.FileSystem.from_uri(path)
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")

    class InsertedFile(InputPartition):
        def __init__(self, path: str):
            self.path = path

    class CommitReader(DataSourceStreamReader):
        def __init__(self, options, schema: T.StructType):
            self.folder, self.start, self.fields = options["folder"], int(options["after"]), schema
            self.known = self.start

        def _text(self, name: str) -> str | None:
            from pyarrow import fs

            system, path = place(f"{self.folder}/commits/{name}")
            if system.get_file_info(path).type != fs.FileType.File:
                return None
            with system.open_input_stream(path) as stream:
                return stream.read().decode()

        def _entry(self, number: int) -> str | None:
            return self._text(f"{number:020d}.json")

        def initialOffset(self) -> dict:
            return {"commit": self.start}

        def latestOffset(self) -> dict:
            hint = self._text("hint") or ""
            if hint.isdigit() and int(hint) > self.known and self._entry(int(hint)) is not None:
                self.known = int(hint)
            while self._entry(self.known + 1) is not None:
                self.known += 1
            return {"commit": self.known}

        def partitions(self, start: dict, end: dict):
            import json

            from pyarrow import fs

            found = []
            for number in range(start["commit"] + 1, end["commit"] + 1):
                for name in json.loads(self._entry(number))["inserted"]:
                    system, path = place(f"{self.folder}/data/{name}")
                    files = system.get_file_info(fs.FileSelector(path, recursive=True))
                    found += sorted(f.path for f in files if f.type == fs.FileType.File and f.base_name.startswith("part-"))
            return [InsertedFile(path) for path in found]

        def read(self, partition: InsertedFile):
            import pyarrow.parquet as pq
            from pyspark.sql.pandas.types import to_arrow_schema

            system, _ = place(self.folder)
            schema = to_arrow_schema(self.fields)
            with system.open_input_file(partition.path) as source:
                for batch in pq.ParquetFile(source, coerce_int96_timestamp_unit="us").iter_batches(columns=schema.names):
                    yield batch.select(schema.names).cast(schema)

    class CommitSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return "rowgate_commits"

        def streamReader(self, schema: T.StructType) -> CommitReader:
            return CommitReader(self.options, schema)

    return CommitSource


def read_commits(spark: SparkSession, folder: str, schema: T.StructType, after: int) -> DataFrame:
    """The rows that the entries behind number ``after`` inserted, as a stream."""
    spark.dataSource.register(_source_class())
    return spark.readStream.format("rowgate_commits").schema(schema).option("folder", folder).option("after", str(after)).load()
