"""F1-F28 and U1-U5 on hand-made edge values."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlake.functions import scalars as FX
from ledgerlake.functions.sql_functions import register_sql_functions
from ledgerlake.plans.star import dim_date


def one(spark, col, ddl="x string", rows=(("a",),)):
    return [r[0] for r in spark.createDataFrame(list(rows), ddl).select(col).collect()]


def test_masks_keep_strings_and_nulls(spark):
    rows = [("000000000012",), (None,), ("0901234567",)]
    assert one(spark, FX.mask_account("x"), rows=rows) == ["****0012", None, "****4567"]
    assert one(spark, FX.mask_phone("x"), rows=rows) == ["****012", None, "****567"]


def test_mask_card_is_repeatable_and_in_range(spark):
    vals = one(spark, FX.mask_card("x"), rows=[("CRD0000001",), ("CRD0000001",), ("CRD0000002",)])
    assert vals[0] == vals[1]
    for v in vals:
        assert v.startswith("****") and 1000 <= int(v[4:]) <= 9999


def test_format_id_keeps_wide_numbers(spark):
    assert one(spark, FX.format_id("CUS", "x", 7), "x long", [(42,), (123456789,)]) == [
        "CUS0000042", "CUS123456789"]


def test_strip_prefix(spark):
    assert one(spark, FX.strip_prefix_int("x", "CUS"), rows=[("CUS0000042",), ("junk",), (None,)]) == [42, None, None]


def test_clean_text(spark):
    assert one(spark, FX.clean_text("x"), rows=[("\n  Chi nhánh\nHà Nội \t\n",)]) == ["Chi nhánh Hà Nội"]


def test_round_half_even(spark):
    assert one(spark, FX.round_half_even("x"), "x double", [(2.5,), (3.5,), (-2.5,)]) == [2, 4, -2]
    assert one(spark, FX.round2("x"), "x double", [(1.005,), (2.125,)]) == [1.0, 2.12]


def test_date_key_null_safe(spark):
    assert one(spark, FX.date_key("x"), "x date", [(dt.date(2024, 1, 31),), (None,)]) == [20240131, None]


def test_dim_date_calendar(spark):
    d = dim_date(spark)
    assert d.count() == 18628
    first = d.orderBy("full_date").first()
    assert first["date_id"] == 20000101 and first["day_of_week"] == 5 and first["is_weekend"]
    assert first["quarter"] == 1


def test_months_since(spark):
    v = one(spark, FX.months_since("x", F.lit("2025-06-05").cast("date")), "x date",
            [(dt.date(2020, 3, 15),)])
    assert v == [62]


def test_credit_and_installment(spark):
    df = spark.createDataFrame([(50000000.0, 8500000.0, 100000000, 12)], "l double, o double, a long, t int")
    r = df.select(FX.available_credit("l", "o").alias("av"), FX.utilisation_pct("l", "o").alias("u"),
                  FX.monthly_installment("a", "t").alias("m")).first()
    assert r["av"] == 41500000.0 and r["u"] == 17.0 and abs(r["m"] - 100000000 / 12) < 1e-6


def test_first_element_and_dates(spark):
    df = spark.createDataFrame([([3, 4], dt.date(2024, 12, 25))], "a array<int>, d date")
    r = df.select(FX.first_element("a").alias("f"),
                  FX.first_element(F.filter("a", lambda x: x > 9)).alias("g"),
                  FX.add_days("d", 15).alias("p"),
                  FX.date_cap(FX.add_days("d", 15), F.lit("2025-01-01")).alias("c"),
                  FX.iso_timestamp(F.col("d").cast("timestamp")).alias("iso")).first()
    assert r["f"] == 3 and r["g"] is None
    assert r["p"] == dt.date(2025, 1, 9) and r["c"] == dt.date(2025, 1, 1)
    assert r["iso"] == "2024-12-25T00:00:00"


def test_sql_functions_by_name(spark):
    register_sql_functions(spark)
    r = spark.sql("SELECT hide_account_number('000000000012') a, hide_phone_number('0901234567') p, "
                  "date_to_int(DATE'2024-02-29') d, add_number('CRD1') n").first()
    assert r["a"] == "****0012" and r["p"] == "****567" and r["d"] == 20240229
    assert r["n"] == one(spark, FX.mask_card("x"), rows=[("CRD1",)])[0]
    r2 = spark.range(1).select(F.call_function("hide_account_number", F.lit("12345678"))).first()[0]
    assert r2 == "****5678"


def test_round2_is_half_even_on_the_decimal_text_whole_table(spark):
    """F17 against brute force over every product of a driver table:
    half-even on the shortest decimal text of the double.  (Python's
    round() works on the exact binary value instead; the two differ only
    when that text ends in an exact 5 at the third decimal.)"""
    from decimal import ROUND_HALF_EVEN, Decimal

    from tests.conftest import SF001
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    x = (li["l_extendedprice"] * li["l_discount"])
    rows = li.select(x.alias("x"), FX.round2(x).alias("r")).collect()
    assert len(rows) == 60000
    want = [float(Decimal(repr(r["x"])).quantize(Decimal("0.01"), ROUND_HALF_EVEN)) for r in rows]
    assert [r["r"] for r in rows] == want
