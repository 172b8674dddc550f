"""Keyed tables: one row per key, updated in place by hash range.

Rows lie in ``bucket=/version=`` folders by a hash of their key.  An update
keeps the newest row per key, among its own rows and those of the buckets
that its keys fall into; only these buckets are read and written again, as
a new version.  Buckets hold one row per key, so no bucket grows hot.

An update takes effect with its marker ``_versions/<n>``, in one step.  One
that is cut off leaves a version that nobody reads; done again under the
same number it replaces that version and gives the same rows.  The version
before stays for readers that still have it open; older ones are removed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators.latest import latest_by_rank
from ledgerlake.sinks import paths
from ledgerlake.sinks.writers import write_partitioned

LOG = "_versions"


class KeyedTable:
    """``order_by`` says which of two rows of a key is newer; of rows equal in
    it, the one of the later update (within an update, any) is."""

    def __init__(self, spark: SparkSession, path: str, key: str, order_by: Sequence[str], n_buckets: int = 64):
        self.spark, self.path, self.key, self.order_by, self.n = spark, path, key, list(order_by), n_buckets

    def versions(self, below: int | None = None) -> dict[int, list[int]]:
        """Versions that hold (below a number), newest first, by bucket."""
        held = paths.marks(self.spark, f"{self.path}/{LOG}")
        if set(held.values()) - {str(self.n)}:
            raise ValueError(f"{self.path} has {held.popitem()[1]} buckets, not {self.n}")
        out = {}
        for folder in paths.folders(self.spark, self.path):
            have = [int(v.split("=")[1]) for v in paths.folders(self.spark, f"{self.path}/{folder}")]
            fit = sorted((v for v in have if str(v) in held and (below is None or v < below)), reverse=True)
            if fit:
                out[int(folder.split("=")[1])] = fit
        return out

    def _at(self, newest: dict[int, int], schema=None) -> DataFrame:
        reader = self.spark.read.option("basePath", self.path)
        reader = reader.schema(schema) if schema is not None else reader
        at = [f"{self.path}/bucket={b}/version={v}" for b, v in sorted(newest.items())]
        return reader.parquet(*at).drop("bucket", "version")

    def read(self) -> DataFrame:
        """The newest row of every key."""
        return self._at({b: v[0] for b, v in self.versions().items()})

    def update(self, rows: DataFrame, version: int) -> list[int]:
        """Takes in ``rows`` (any number per key); returns the buckets rewritten.
        ``version`` grows from update to update; an update done again has the
        number it had."""
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.n)).cast("int")
        new = latest_by_rank(rows, [self.key], self.order_by).withColumn("bucket", bucket).persist()
        try:
            touched = sorted(r[0] for r in new.select("bucket").distinct().collect())  # n_buckets at most
            old = {b: v[0] for b, v in self.versions(below=version).items() if b in set(touched)}
            both = new.withColumn("__update", F.lit(1))
            if old:
                before = self._at(old, rows.schema).withColumn("bucket", bucket).withColumn("__update", F.lit(0))
                both = latest_by_rank(both.unionByName(before), [self.key], [*self.order_by, "__update"])
            both = both.drop("__update").withColumn("version", F.lit(version).cast("long"))
            if touched:
                write_partitioned(both, self.path, ("bucket", "version"))
            paths.mark(self.spark, f"{self.path}/{LOG}", str(version), str(self.n))
        finally:
            new.unpersist()
        for b, have in self.versions().items():
            for v in have[2:] if b in touched else ():
                paths.delete(self.spark, f"{self.path}/bucket={b}/version={v}")
        return touched
