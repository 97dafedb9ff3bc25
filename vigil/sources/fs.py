"""Shared-filesystem helpers through the Hadoop FileSystem API (works for HDFS / object stores, not just local)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def has_data(spark: SparkSession, path: str) -> bool:
    """True when the folder exists and holds at least one non-hidden entry."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return False
    return any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(p))


def partition_values(spark: SparkSession, path: str, column: str) -> list[int]:
    """Integer values of ``column=<n>`` sub-folders (a listing of folder names only, no data read)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    out = []
    for s in fs.listStatus(p):
        name = s.getPath().getName()
        if s.isDirectory() and name.startswith(column + "="):
            try:
                out.append(int(name.split("=", 1)[1]))
            except ValueError:
                pass
    return sorted(out)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def mkdirs(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def stamp(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of a file or of a folder's entries: changes when the table does."""
    fs, p = _fs(spark, path)
    return tuple(sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(p)))


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """``path`` with the text, whole or not at all: written beside it and renamed. Fails if it is there already."""
    fs, p = _fs(spark, path)
    beside = p.suffix(".part")
    out = fs.create(beside, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    if fs.exists(p) or not fs.rename(beside, p):
        raise FileExistsError(path)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files below a folder."""
    fs, p = _fs(spark, path)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def move(spark: SparkSession, path: str, to: str) -> None:
    fs, p = _fs(spark, path)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(to)
    fs.mkdirs(target.getParent())
    if not fs.rename(p, target):
        raise OSError(f"{path} cannot be moved to {to}")


def files_below(spark: SparkSession, path: str) -> list[str]:
    """The data files of a folder and the folders below it, in order of their paths."""
    fs, p = _fs(spark, path)
    out, it = [], fs.listFiles(p, True)
    while it.hasNext():
        found = it.next().getPath()
        if not found.getName().startswith(("_", ".")):
            out.append(found.toString())
    return sorted(out)
