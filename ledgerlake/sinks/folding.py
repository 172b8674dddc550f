"""Folding of live tables (R3, K7): many small batch folders become one.

A live table lies in ``year=/month=/batch_id=`` folders, one more for each
micro-batch and month.  ``fold`` picks the months that have many small ones
and rewrites those into one folder a month with a negative batch id, in one
job.  Folders that have grown large are left alone, so a row is rewritten a
bounded number of times.

Nothing is lost or doubled if a fold is cut off at any point:

1. the folded folders are written; nothing refers to them yet;
2. the marker ``_folds/<n>`` appears in one step: the fold holds;
3. the folders it replaces are removed.

``read`` follows the markers, so it gives each row once at any moment.  The
next fold removes what a fold cut off in 1 or 3 has left behind.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.sinks import paths
from ledgerlake.sinks.writers import write_partitioned

LOG = "_folds"
#: A folder below this size is small; as many small ones in a month are folded.
SMALL_BYTES, LEAST = 64 * 1024 * 1024, 8


def _number(folder: str) -> int:
    return int(folder.split("=", 1)[1])


def batches(spark: SparkSession, table: str) -> dict[str, list[int]]:
    """Batch ids by month folder (``year=Y/month=M``), as they lie there."""
    return {f"{y}/{m}": sorted(_number(b) for b in paths.folders(spark, f"{table}/{y}/{m}"))
            for y in paths.folders(spark, table) for m in paths.folders(spark, f"{table}/{y}")}


def _held(spark: SparkSession, table: str) -> tuple[int, dict[str, set[int]], dict[str, set[int]]]:
    """Last fold, and by month the folds that hold and the batches they replace."""
    last, folded, replaced = 0, {}, {}
    for name, text in paths.marks(spark, f"{table}/{LOG}").items():
        last = max(last, int(name))
        for month, ids in json.loads(text).items():
            folded.setdefault(month, set()).add(-int(name))
            replaced.setdefault(month, set()).update(ids)
    return last, folded, replaced


def live(spark: SparkSession, table: str) -> dict[str, list[int]]:
    """Batch ids by month that make up the table now."""
    _, folded, replaced = _held(spark, table)
    return {month: [b for b in ids if b not in replaced.get(month, ()) and (b >= 0 or b in folded.get(month, ()))]
            for month, ids in batches(spark, table).items()}


def read(spark: SparkSession, table: str, schema=None) -> DataFrame:
    """The live table, each row once, whether a fold is under way or was cut off."""
    at = [f"{table}/{month}/batch_id={b}" for month, ids in live(spark, table).items() for b in ids]
    reader = spark.read.option("basePath", table)
    return (reader.schema(schema) if schema is not None else reader).parquet(*at)


def clean(spark: SparkSession, table: str) -> None:
    """Removes replaced folders and folds that were never marked."""
    kept = live(spark, table)
    for month, ids in batches(spark, table).items():
        for b in set(ids) - set(kept[month]):
            paths.delete(spark, f"{table}/{month}/batch_id={b}")


def fold(spark: SparkSession, table: str, before: int | None = None, small_bytes: int = SMALL_BYTES, least: int = LEAST) -> int:
    """Folds each month that has ``least`` small folders or more; returns the
    number of months folded.  Batches from ``before`` on are left alone (the
    running one may be written again)."""
    clean(spark, table)
    chosen = {}
    for month, ids in live(spark, table).items():
        small = [b for b in ids if (before is None or b < before) and paths.size(spark, f"{table}/{month}/batch_id={b}") < small_bytes]
        if len(small) >= max(least, 2):
            chosen[month] = small
    if not chosen:
        return 0
    number = _held(spark, table)[0] + 1
    at = [f"{table}/{month}/batch_id={b}" for month, ids in chosen.items() for b in ids]
    rows = spark.read.option("basePath", table).parquet(*at)
    write_partitioned(rows.withColumn("batch_id", F.lit(-number).cast("long")), table, ("year", "month", "batch_id"))
    paths.mark(spark, f"{table}/{LOG}", str(number), json.dumps(chosen))
    clean(spark, table)
    return len(chosen)
