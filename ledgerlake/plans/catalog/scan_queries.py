"""Sources and slices: S1, S3-S6, K2, K8, O3-O5."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions import scalars as FX
from ledgerlake.operators import slices
from ledgerlake.plans import roles as R
from ledgerlake.sources.tables import Tables


CUSTOMER_SCHEMA = T.StructType([
    T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("c_mktsegment", T.StringType())])


def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parquet scan with an explicit schema."""
    return Tables(spark, sf_dir).read("customer", CUSTOMER_SCHEMA)


def _line_slice_cols(df: DataFrame) -> DataFrame:
    return df.select("l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice",
                     F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"))


def scan_month_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six months across a year end (1998-11 .. 1999-04) in one scan."""
    li = Tables(spark, sf_dir).lineitem
    return _line_slice_cols(slices.month_range_filter(li, "l_shipdate", "1998-11-01", 6))


def scan_missing_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month scans where some months have no rows (typed empty, D7)."""
    li = Tables(spark, sf_dir).lineitem
    return _line_slice_cols(slices.scan_months(li, "l_shipdate", [(2001, 11), (2001, 12),
                                                                 (2002, 1)]))


def union_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3: UNION ALL of two year slices."""
    li = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_shipdate")
    parts = [slices.between_dates(li, "l_shipdate", _dt.date(y, 1, 1), _dt.date(y + 1, 1, 1))
             .withColumn("year", F.lit(y)) for y in (1996, 1997)]
    return slices.union_slices(parts)


def payments_6m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O4 + F2 (B15 shape): two half-open six-month windows from 1998-10."""
    li = Tables(spark, sf_dir).lineitem
    (lo, _), (_, hi) = slices.half_year_windows("1998-10-15", 2)
    p = slices.between_dates(li, "l_shipdate", lo, hi)
    paid = F.col("l_shipdate").cast("date")
    return p.select(F.col("l_orderkey").alias("loan_id"), F.col("l_linenumber").alias("line"),
                    paid.alias("paid_date"), FX.date_key(paid).alias("paid_date_id"),
                    F.col("l_extendedprice").alias("payment_amount"),
                    F.year(paid).alias("year"), F.month(paid).alias("month"))


def transactions_12m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O5 + F1 + F2 + P4 (B16 shape): trailing 12 months as of a day."""
    o = Tables(spark, sf_dir).orders
    lo, hi = slices.trailing_months(R.ORDERS_AS_OF, 12)
    o = slices.between_dates(o, "o_orderdate", lo, hi)
    return o.select(F.col("o_orderkey").alias("transaction_id"),
                    F.col("o_custkey").alias("account_id"),
                    FX.date_key("o_orderdate").alias("date_id"),
                    F.col("o_orderdate").alias("timestamp"),
                    F.col("o_orderpriority").alias("type"),
                    F.col("o_totalprice").alias("amount"),
                    F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8 + S1: a table written as CSV with a header, read back with an
    explicit schema (no inference pass)."""
    from ledgerlake.session import scratch_path
    from ledgerlake.sinks.writers import write_csv
    from ledgerlake.sources.files import read_csv
    path = scratch_path(spark, "customer_csv")
    write_csv(Tables(spark, sf_dir).customer, path)
    return read_csv(spark, path, CUSTOMER_SCHEMA)


def partitioned_month_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 + S4 on a real Hive-partitioned table: lineitem written by
    year/month of the ship date, then six months across a year end read
    back -- the month set prunes directories, the date predicate pushes to
    the files."""
    from ledgerlake.session import scratch_path
    from ledgerlake.sinks.writers import write_partitioned
    from ledgerlake.sources.files import read_month_slices
    li = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_shipdate")
    path = scratch_path(spark, "lineitem_by_month")
    write_partitioned(li.withColumns({"year": F.year("l_shipdate"), "month": F.month("l_shipdate")}),
                      path, ("year", "month"))
    return read_month_slices(spark, path, "l_shipdate", slices.months_of("1998-11-01", 6))


def branches_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7 + P9 + P11: branch records as JSON documents with an array each (at
    most 1,000 suppliers of a nation in one), read back: branches in one of
    the cities, names cleaned."""
    from ledgerlake.session import scratch_path
    from ledgerlake.sources import files
    s = Tables(spark, sf_dir).supplier
    city = F.when(F.col("s_nationkey") % 3 == 0, F.lit("Hà Nội ")).otherwise(F.lit("Huế "))
    item = F.struct((F.col("s_acctbal") >= 0).alias("IsBranch"), F.concat(F.lit("  "), "s_name", F.lit(" ")).alias("Name"),
                    F.concat(city, F.col("s_nationkey").cast("string")).alias("Address"),
                    F.lpad(F.col("s_suppkey").cast("string"), 10, "0").alias("Phone"))
    docs = s.groupBy("s_nationkey", F.floor(F.col("s_suppkey") / 1000).alias("part")).agg(F.collect_list(item).alias("branches_and_atm"))
    path = scratch_path(spark, "branches")
    (docs.select("s_nationkey", "part", F.to_json(F.struct("branches_and_atm")).alias("value"))
     .write.partitionBy("s_nationkey", "part").text(path))
    return files.read_branches_json(spark, path)
