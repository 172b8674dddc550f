"""Folders and marker files on whatever file system a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path`` (none if it isn't there), hidden ones left out."""
    fs, p = _at(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return sorted(n for n in names if n[0] not in "._")


def size(spark: SparkSession, path: str) -> int:
    """Bytes in a folder."""
    fs, p = _at(spark, path)
    return fs.getContentSummary(p).getLength()


def delete(spark: SparkSession, path: str) -> None:
    """Removes a folder; one that isn't there is no error."""
    fs, p = _at(spark, path)
    fs.delete(p, True)


def mark(spark: SparkSession, folder: str, name: str, text: str) -> None:
    """Writes ``folder/name`` in one step: whoever sees it sees all of it."""
    fs, p = _at(spark, f"{folder}/{name}")
    _, draft = _at(spark, f"{folder}/.{name}.draft")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(p):
        fs.delete(p, False)
    if not fs.rename(draft, p):
        raise OSError(f"{folder}/{name} can't be written")


def marks(spark: SparkSession, folder: str) -> dict[str, str]:
    """Names and texts of the markers in ``folder``."""
    fs, p = _at(spark, folder)
    if not fs.exists(p):
        return {}
    out = {}
    for s in fs.listStatus(p):
        name = s.getPath().getName()
        if not name.startswith("."):
            stream = fs.open(s.getPath())
            out[name] = bytes(stream.readAllBytes()).decode()
            stream.close()
    return out
