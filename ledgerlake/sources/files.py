"""File sources: CSV with an explicit schema (S1, S2), Parquet (S3, S6),
month-sliced partitioned Parquet (S4, S5), branch JSON (S7) and document
collections (S11)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake import schemas as S
from ledgerlake.operators import slices


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header row, comma, quote and escape '"'; explicit schema, so there
    is no inference pass and '0001' stays a string (D3).  Empty -> NULL."""
    return (spark.read.schema(schema).option("header", True).option("sep", ",")
            .option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE")
            .option("timestampFormat", "yyyy-MM-dd HH:mm:ss").option("dateFormat", "yyyy-MM-dd")
            .csv(path))


#: Column of a line that doesn't read as its schema says.
BAD_LINE = "_bad_line"


def read_csv_quarantined(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """S1 with a quarantine: (good rows, bad lines).

    A line goes to quarantine whole if it has too few or too many fields or a
    value that doesn't read as its type, instead of turning into NULLs: the
    raw ``line``, what could be read of it (``parsed``, JSON) and its
    ``file``.  Good rows and bad lines add up to the lines of the files
    (headers and blank lines aside), whatever columns are read later: a line
    is judged by all its fields.  Columns that the header has beyond the
    schema are no fault of a line; they are left out."""
    have = spark.read.option("header", True).option("quote", '"').option("escape", '"').csv(path).columns if header else schema.names
    beyond = [T.StructField(f"_beyond_{n}", T.StringType()) for n in range(len(schema), len(have))]
    raw = (spark.read.schema(T.StructType([*schema.fields, *beyond, T.StructField(BAD_LINE, T.StringType())]))
           .option("header", header).option("sep", ",").option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", BAD_LINE).option("columnPruning", False)
           .option("timestampFormat", "yyyy-MM-dd HH:mm:ss").option("dateFormat", "yyyy-MM-dd").csv(path))
    # Spark judges a line by the fields that a query reads; a condition that
    # needs them all, and always holds, keeps it from reading fewer
    raw = raw.where(F.pmod(F.xxhash64(*schema.names, *[f.name for f in beyond]), F.lit(2)).isin(0, 1))
    good = raw.where(F.col(BAD_LINE).isNull()).select(*schema.names)
    bad = raw.where(F.col(BAD_LINE).isNotNull()).select(
        F.col(BAD_LINE).alias("line"), F.to_json(F.struct(*schema.names)).alias("parsed"), F.col("_metadata.file_path").alias("file"))
    return good, bad


def land_csv(spark: SparkSession, path: str, schema: T.StructType, out: str, quarantine: str, header: bool = True) -> None:
    """A CSV export to Parquet, its bad lines to ``quarantine``."""
    from ledgerlake.sinks.writers import write_parquet
    good, bad = read_csv_quarantined(spark, path, schema, header)
    write_parquet(good, out)
    write_parquet(bad, quarantine)


def read_landing_csvs(spark: SparkSession, folder: str,
                      schemas: Mapping[str, T.StructType] = S.LANDING_CSV,
                      register: bool = True, quarantine: str | None = None) -> dict[str, DataFrame]:
    """Read ``<folder>/<name>.csv`` per table and register a temp view each.
    With ``quarantine``, bad lines are written to ``<quarantine>/<name>`` and
    are in no table."""
    from ledgerlake.sinks.writers import write_parquet
    out = {}
    for name, schema in schemas.items():
        path = f"{folder.rstrip('/')}/{name}.csv"
        if quarantine:
            df, bad = read_csv_quarantined(spark, path, schema)
            write_parquet(bad, f"{quarantine.rstrip('/')}/{name}")
        else:
            df = read_csv(spark, path, schema)
        if register:
            df.createOrReplaceTempView(name)
        out[name] = df
    return out


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """S3: Parquet with an optional schema (else the file's own)."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table, all columns."""
    return spark.table(name)


def read_month_slices(spark: SparkSession, root: str, ts_col: str,
                      months: Iterable[tuple[int, int]],
                      schema: T.StructType | None = None) -> DataFrame:
    """A year/month-partitioned Parquet root limited to some months.

    The root is read as one table (partition columns kept; no
    ``recursiveFileLookup``), and the month set becomes a filter on the
    partition columns, so only those directories are listed and read.
    A month that is absent yields zero rows of the same schema.
    """
    df = read_parquet(spark, root, schema)
    return slices.scan_months(df, ts_col, months, partition_cols=("year", "month"))


def read_branches_json(spark: SparkSession, path: str, cities=S.CITIES) -> DataFrame:
    """S7 + P9 + P11: branch records from a JSON document with an array
    ``branches_and_atm`` of {IsBranch, Name, Address, Phone}; keep branches
    in one of the cities; clean the name."""
    from ledgerlake.functions.scalars import clean_text
    from ledgerlake.operators.conform import contains_any
    item = T.StructType([T.StructField("IsBranch", T.BooleanType()),
                         T.StructField("Name", T.StringType()),
                         T.StructField("Address", T.StringType()),
                         T.StructField("Phone", T.StringType())])
    doc = T.StructType([T.StructField("branches_and_atm", T.ArrayType(item))])
    raw = spark.read.schema(doc).option("multiLine", True).json(path)
    rows = raw.select(F.explode("branches_and_atm").alias("b")).select("b.*")
    kept = rows.where(F.col("IsBranch") & contains_any(F.col("Address"), list(cities)))
    return kept.select(clean_text("Name").alias("name"), F.col("Address").alias("address"),
                       F.col("Phone").alias("phone_number"))


def read_documents(spark: SparkSession, path: str, collection: str) -> DataFrame:
    """A document collection (JSON lines) with its nested schema."""
    return spark.read.schema(S.DOCUMENTS[collection]).json(path)
