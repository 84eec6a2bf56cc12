"""Small Hadoop FileSystem helpers (work on any Hadoop-compatible store the cluster uses)."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import SparkSession

_AT_ONCE = 16  # file system calls of the driver at a time


def each(call: Callable, items: Iterable[tuple]) -> None:
    """Calls ``call`` with every item's values, several at a time; the first error is raised when all have ended."""
    with ThreadPoolExecutor(_AT_ONCE) as pool:
        for done in [pool.submit(call, *item) for item in items]:
            done.result()


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def relative_to(spark: SparkSession, root: str, uri: str) -> str:
    """``uri``'s folder relative to the table folder ``root`` ('' when it is the root itself)."""
    jvm = spark.sparkContext._jvm
    parent = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri)).getParent().toUri().getPath()
    base = jvm.org.apache.hadoop.fs.Path(qualify(spark, root)).toUri().getPath()
    parent, base = str(parent).rstrip("/"), str(base).rstrip("/")
    if parent != base and not parent.startswith(base + "/"):
        raise ValueError(f"{uri} is not inside {root}")
    return parent[len(base):].lstrip("/")


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str, recursive: bool = True) -> bool:
    fs, p = _path(spark, path)
    return bool(fs.delete(p, recursive))


def rename(spark: SparkSession, src: str, dst: str) -> None:
    """Raises where the file system refuses: it says so in its result only."""
    fs, p = _path(spark, src)
    _, q = _path(spark, dst)
    if not fs.rename(p, q):
        raise OSError(f"could not rename {src} to {dst}")


def replace(spark: SparkSession, src: str, dst: str) -> None:
    """Moves the file ``src`` over ``dst`` in one step: a reader finds the old file or the new one."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(jvm.java.net.URI(qualify(spark, dst)), conf).rename(
        jvm.org.apache.hadoop.fs.Path(src), jvm.org.apache.hadoop.fs.Path(dst), options)


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Visible files directly under ``path``."""
    return [f"{path.rstrip('/')}/{n}" for n in list_names(spark, path) if not n.startswith(("_", "."))]


def plain(uri: str) -> str:
    """A path that Spark and Hadoop take, from the escaped one in ``_metadata.file_path``."""
    return unquote(uri)


def has_data_files(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds at least one visible (not ``_``/``.``-prefixed) file."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return False
    it = fs.listFiles(p, True)
    while it.hasNext():
        name = it.next().getPath().getName()
        if not name.startswith(("_", ".")):
            return True
    return False


def qualify(spark: SparkSession, path: str) -> str:
    """Fully-qualified URI of ``path`` (as ``_metadata.file_path`` reports it)."""
    fs, p = _path(spark, path)
    return str(fs.makeQualified(p).toUri().toString())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes beside ``path`` first, so that a driver lost meanwhile leaves no half of it."""
    parent, name = path.rsplit("/", 1)
    fs, p = _path(spark, f"{parent}/.{name}.tmp")
    out = fs.create(p, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    replace(spark, f"{parent}/.{name}.tmp", path)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _path(spark, path)
    stream = fs.open(p)
    try:
        return str(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def list_names(spark: SparkSession, path: str, prefix: str = "") -> list[str]:
    """Names of the entries directly under ``path`` starting with ``prefix``."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(str(st.getPath().getName()) for st in fs.listStatus(p)
                  if str(st.getPath().getName()).startswith(prefix))
