"""Constant lookup tables (S12) as small DataFrames.

They have a fixed, tiny size, so joining them with ``F.broadcast`` is
safe at any data scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake import schemas as S

_TWO = {
    "customer_types": ("customer_type_id", "type_name", S.CUSTOMER_TYPES),
    "customer_status_types": ("status_id", "status_name", S.CUSTOMER_STATUS_TYPES),
    "account_types": ("account_type_id", "type_name", S.ACCOUNT_TYPES),
    "account_status_types": ("status_id", "status_name", S.ACCOUNT_STATUS_TYPES),
    "transaction_types": ("transaction_type_id", "type_name", S.TRANSACTION_TYPES),
    "loan_types": ("loan_type_id", "type_name", S.LOAN_TYPES),
    "loan_status_types": ("status_id", "status_name", S.LOAN_STATUS_TYPES),
}

LOOKUP_NAMES = tuple(_TWO) + ("card_types",)


def lookup(spark: SparkSession, name: str) -> DataFrame:
    if name == "card_types":
        schema = T.StructType([T.StructField("card_type_id", T.IntegerType()),
                               T.StructField("type_name", T.StringType()),
                               T.StructField("monthly_fee", T.IntegerType()),
                               T.StructField("interest_rate", T.DoubleType())])
        return F.broadcast(spark.createDataFrame(S.CARD_TYPES, schema))
    key, value, rows = _TWO[name]
    schema = T.StructType([T.StructField(key, T.IntegerType()),
                           T.StructField(value, T.StringType())])
    return F.broadcast(spark.createDataFrame(rows, schema))


def lookups(spark: SparkSession) -> dict[str, DataFrame]:
    return {n: lookup(spark, n) for n in LOOKUP_NAMES}


def rows_frame(spark: SparkSession, rows, ddl: str) -> DataFrame:
    """A small constant table from rows and a DDL schema string; of fixed
    size, so hinted for broadcast."""
    return F.broadcast(spark.createDataFrame(rows, ddl))


def lookup_schema(name: str) -> T.StructType:
    if name == "card_types":
        return T.StructType([T.StructField("card_type_id", T.IntegerType()),
                             T.StructField("type_name", T.StringType()),
                             T.StructField("monthly_fee", T.IntegerType()),
                             T.StructField("interest_rate", T.DoubleType())])
    key, value, _ = _TWO[name]
    return T.StructType([T.StructField(key, T.IntegerType()), T.StructField(value, T.StringType())])


def lookups_from(spark: SparkSession, folder: str | None) -> dict[str, DataFrame]:
    """The lookup tables of an export folder (``<name>.csv`` with a header),
    each falling back to the constant table when the export lacks it.  A
    file that is there but can't be read is an error."""
    from ledgerlake.session import path_exists
    from ledgerlake.sources.files import read_csv
    out = {}
    for name in LOOKUP_NAMES:
        path = f"{folder.rstrip('/')}/{name}.csv" if folder else None
        out[name] = (read_csv(spark, path, lookup_schema(name))
                     if path and path_exists(spark, path) else lookup(spark, name))
    return out
