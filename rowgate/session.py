"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_LOCAL_FOLDERS: dict[str, str] = {}
_FOLDERS: dict[str, list[str]] = {}
_PUBLISHING = threading.Lock()
_RENAMED_AT_ONCE = 8

# Session settings the operators rely on; all can be set at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # A cast that fails must fail the job, not store a null.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # HotSpot never compiles methods beyond 8000 bytes of bytecode. A load of a wide table would
    # stay interpreted in one such method; with this limit Spark splits it into small ones instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session made elsewhere."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "rowgate", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> None:
    """Zone arithmetic below reads wall-clock times as UTC, so the session zone must be UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"set spark.sql.session.timeZone to UTC (it is {zone})")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
    if context.applicationId not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="rowgate-")
    return _LOCAL_FOLDERS[context.applicationId]


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder. Nothing is created; ``free_folders`` removes it."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _FOLDERS.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def _hadoop_path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a Spark write to ``path`` has committed."""
    marker, files = _hadoop_path(spark, f"{path}/_SUCCESS")
    return files.exists(marker)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """The folders directly below ``path``, none if it does not exist."""
    parent, files = _hadoop_path(spark, path)
    if not files.exists(parent):
        return []
    return [str(status.getPath()) for status in files.listStatus(parent) if status.isDirectory()]


def same_folder(one: str, other: str) -> bool:
    """Whether two spellings (with or without scheme) name one folder."""
    return one.rstrip("/").split(":", 1)[-1].lstrip("/") == other.rstrip("/").split(":", 1)[-1].lstrip("/")


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Give a folder another place in one step, so that readers see all of it or nothing."""
    old, files = _hadoop_path(spark, source)
    new, _ = _hadoop_path(spark, target)
    files.mkdirs(new.getParent())
    if not files.rename(old, new):
        raise RuntimeError(f"could not move {source} to {target}")


def rename_files(spark: SparkSession, path: str, ending: str, new_ending: str) -> None:
    """Give the files directly below ``path`` another ending. They may be very many, so a file costs
    few calls, and several files are renamed at a time."""
    folder, files = _hadoop_path(spark, path)
    new_path = spark._jvm.org.apache.hadoop.fs.Path

    def rename(status) -> None:
        old = status.getPath()
        name = old.getName()
        if name.endswith(ending) and name[0] not in "._":
            if not files.rename(old, new_path(folder, name.removesuffix(ending) + new_ending)):
                raise RuntimeError(f"could not rename {path}/{name}")

    with ThreadPoolExecutor(_RENAMED_AT_ONCE) as pool:
        list(pool.map(rename, files.listStatus(folder)))


def put_mark(spark: SparkSession, path: str) -> None:
    """An empty file as a mark."""
    mark, files = _hadoop_path(spark, path)
    files.create(mark, True).close()


def has_mark(spark: SparkSession, path: str) -> bool:
    mark, files = _hadoop_path(spark, path)
    return files.exists(mark)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, None if there is none."""
    found, files = _hadoop_path(spark, path)
    if not files.exists(found):
        return None
    stream = files.open(found)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, in place of the one that may be there."""
    target, files = _hadoop_path(spark, path)
    stream = files.create(target, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file unless there is one, whole at once; whether it was created.

    The text is written aside and renamed without overwriting, which HDFS does in one step; on local
    disks the look at the target and the renaming are two, so threads of one process take turns."""
    aside = f"{path}.{uuid.uuid4().hex}"
    put_text(spark, aside, text)
    old, files = _hadoop_path(spark, aside)
    new, _ = _hadoop_path(spark, path)
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        with _PUBLISHING:
            context.rename(old, new, plain)
    except Py4JJavaError as error:
        files.delete(old, False)
        if files.exists(new):
            return False
        raise error
    return True


def folder_bytes(spark: SparkSession, pattern: str) -> int:
    """Bytes of all files below the folders that match a pattern."""
    wanted, files = _hadoop_path(spark, pattern)
    return sum(files.getContentSummary(status.getPath()).getLength() for status in files.globStatus(wanted) or ())


def free_folders(spark: SparkSession) -> list[str]:
    """Delete the working folders this process has made, and return them. Call it when the results
    of list filters, percentiles and loads without a table have been consumed."""
    freed = list(_FOLDERS.get(spark.sparkContext.applicationId, ()))
    for path in freed:
        delete_folder(spark, path)
    _FOLDERS.pop(spark.sparkContext.applicationId, None)
    return freed


def delete_folder(spark: SparkSession, path: str) -> None:
    folder, files = _hadoop_path(spark, path)
    files.delete(folder, True)
