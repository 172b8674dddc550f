"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: A word: code points other than blank and the five ASCII control blanks.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.  Where
    the setting is missing, one is made in local mode (tests), where driver
    and executors are one process; on a cluster that is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^-]*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def written(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage, survives the
    loss of executors, and later steps read only the columns they need."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex[:12]}"
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables in the shared folder that are dropped once what was made from
    them is written itself."""

    def __init__(self, spark: SparkSession):
        self.spark, self.path = spark, f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex[:12]}"
        self.tables = 0

    def write(self, df: DataFrame, name: str) -> DataFrame:
        self.tables += 1
        path = f"{self.path}/{self.tables}-{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, all else as it is."""
    return F.translate(c, UPPER, LOWER)


def word_count(text: Column) -> Column:
    """Number of words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names`` made different from each column of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out
