"""Writers (K1-K8, K10, K11).

File size comes from a ``REBALANCE`` with AQE's advisory partition size
(128 MB by session setting), never from ``repartition(1)`` (D18).
Partitioned writes shuffle by the partition columns so each task writes
few directories, and overwrite only the partitions present (dynamic
partition overwrite), so a rerun replaces instead of appending (D13).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rebalance(df: DataFrame, *cols: str) -> DataFrame:
    """K7: AQE-sized output partitions (~advisoryPartitionSizeInBytes)."""
    return df.hint("rebalance", *cols) if cols else df.hint("rebalance")


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K1: snappy Parquet."""
    rebalance(df).write.mode(mode).option("compression", "snappy").parquet(path)


def write_observed(df: DataFrame, rules: Mapping[str, Column], path: str, columns: Sequence[str], mode: str = "overwrite") -> dict[str, int]:
    """K1 with V3-V11: writes ``columns`` of ``df`` and returns the number of
    rows that break each rule (a Column, NULL counts as passing).  The counts
    are metrics of the write itself, gathered behind its last shuffle, where
    a task that runs again counts once."""
    from pyspark.sql import Observation
    flags = {f"__r{i}": F.coalesce(bad, F.lit(False)) for i, bad in enumerate(rules.values())}
    seen = Observation()
    rows = rebalance(df.select(*columns, *[c.alias(n) for n, c in flags.items()]))
    rows = rows.observe(seen, F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(n)).alias(n) for n in flags])
    rows.select(*columns).write.mode(mode).option("compression", "snappy").parquet(path)
    return dict(zip(rules, (seen.get[n] for n in flags)))


def write_partitioned(df: DataFrame, path: str, parts: Sequence[str],
                      mode: str = "overwrite", dynamic: bool = True) -> None:
    """K2/K6: Parquet partitioned by derived columns.  ``dynamic`` overwrite
    replaces only the partitions present in ``df`` (incremental loads and
    rolling windows); ``dynamic=False`` replaces the whole table (a full
    export reloaded)."""
    (rebalance(df, *parts).write.mode(mode).option("compression", "snappy")
     .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
     .partitionBy(*parts).parquet(path))


def create_table(spark, name: str, schema, location: str | None = None,
                 partition_cols: Sequence[str] = (), fmt: str = "parquet") -> None:
    """K3: CREATE TABLE IF NOT EXISTS with fixed columns."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    part_cols = [c for c in partition_cols if c not in schema.fieldNames()]
    if part_cols:
        cols += ", " + ", ".join(f"`{c}` int" for c in part_cols)
    sql = f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING {fmt}"
    if partition_cols:
        sql += f" PARTITIONED BY ({', '.join(partition_cols)})"
    if location:
        sql += f" LOCATION '{location}'"
    spark.sql(sql)


def insert_by_name(df: DataFrame, table: str, overwrite: bool = False,
                   dynamic: bool = True) -> None:
    """K4: append (or overwrite) into a table by column name, with the
    table's types under ANSI store assignment (overflow raises).  An
    overwrite of a partitioned table replaces only the partitions present,
    or the whole table with ``dynamic=False`` (K5 full refresh)."""
    spark = df.sparkSession
    target = spark.table(table)
    parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if not (overwrite and dynamic and parts):
        rebalance(df.select(*target.columns)).write.insertInto(table, overwrite=overwrite)
        return
    # insertInto takes no overwrite mode of its own and the session's setting
    # is shared by all writes, so the folder is written with the writer's
    # option and its new partitions are made known
    place = next(r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
                 if r["col_name"] == "Location")
    typed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields])
    write_partitioned(typed, place, parts)
    spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)


def replace_table(df: DataFrame, table: str, partition_cols: Sequence[str] = ()) -> None:
    """K5: drop-and-rebuild (full refresh) as an overwrite."""
    w = rebalance(df, *partition_cols).write.mode("overwrite").format("parquet")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.saveAsTable(table)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K8: CSV with a header (one per part file); append or overwrite."""
    df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"').csv(path)


def write_documents(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Nested documents as JSON lines; NULL fields are left out."""
    (df.write.mode(mode).option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss")
     .option("ignoreNullFields", True).json(path))


def to_json_text(df: DataFrame) -> DataFrame:
    """Each row as one JSON text with ISO timestamps."""
    return df.select(F.to_json(F.struct(*df.columns),
                               {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss"}).alias("json"))


def write_to_catalog(df: DataFrame, table: str, ts_col: str | None = None,
                     fmt: str = "parquet") -> str:
    """K6 through the DataFrameWriterV2 API.

    A new table is created partitioned by ``years(ts_col), months(ts_col)``
    (hidden partitioning) on catalogs that support transforms (Iceberg and
    similar); a catalog that refuses them (plain Parquet:
    UNSUPPORTED_PARTITION_TRANSFORM) gets derived ``year``/``month``
    partition columns instead.  An existing table has the partitions
    present in ``df`` overwritten (idempotent rerun).  Returns the form used."""
    spark = df.sparkSession
    exists = spark.catalog.tableExists(table)
    if exists:
        cols = spark.table(table).columns
        if ts_col and "year" in cols and "month" in cols and "year" not in df.columns:
            df = df.withColumns({"year": F.year(ts_col), "month": F.month(ts_col)})
        try:
            rebalance(df.select(*cols)).writeTo(table).overwritePartitions()
        except Exception as exc:  # a v1 (session catalog) table: insert by name
            if "v1 table" not in str(exc).lower():
                raise
            insert_by_name(df.select(*cols), table, overwrite=True)
        return "overwrite"
    if ts_col is None:
        rebalance(df).writeTo(table).using(fmt).create()
        return "plain"
    try:
        (rebalance(df).writeTo(table).using(fmt)
         .partitionedBy(F.years(F.col(ts_col)), F.months(F.col(ts_col))).create())
        return "transforms"
    except Exception as exc:  # the catalog cannot take partition transforms
        if "TRANSFORM" not in str(exc).upper():
            raise
    derived = df.withColumns({"year": F.year(ts_col), "month": F.month(ts_col)})
    rebalance(derived, "year", "month").writeTo(table).using(fmt).partitionedBy(
        F.col("year"), F.col("month")).create()
    return "derived"
