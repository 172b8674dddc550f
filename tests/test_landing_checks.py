"""CSV quarantine, rules observed during a write, schema drift."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators import bank_rules, quality
from ledgerlake.operators.drift import drift
from ledgerlake.plans import roles as R
from ledgerlake.sinks.writers import write_observed
from ledgerlake.sources import files
from ledgerlake.sources.tables import Tables
from tests.conftest import SF0001

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("day", T.DateType()), T.StructField("amount", T.DecimalType(10, 2))])


def test_good_rows_and_quarantined_lines_are_all_lines(spark, tmp_path):
    bad = ["x,a,2025-01-01,1.00", "2,b,2025-01-01", "3,c,2025-01-01,1.00,more", "4,d,not a day,1.00", "5,e,2025-01-01,a lot"]
    good = ['6,"f, g",2025-01-02,2.50', '7,"say ""hi""",,', ",,,"]
    (tmp_path / "in.csv").write_text("\n".join(["id,name,day,amount", *bad, *good]) + "\n")
    files.land_csv(spark, str(tmp_path / "in.csv"), SCHEMA, str(tmp_path / "rows"), str(tmp_path / "bad"))
    rows, lines = spark.read.parquet(str(tmp_path / "rows")), spark.read.parquet(str(tmp_path / "bad"))
    assert sorted(r.line for r in lines.collect()) == sorted(bad)
    assert [(r.id, r.name) for r in rows.orderBy(F.desc("id")).collect()] == [(7, 'say "hi"'), (6, "f, g"), (None, None)]
    assert rows.count() + lines.count() == 8 and rows.columns == SCHEMA.names
    read = {json.loads(r.parsed).get("id"): r for r in lines.collect()}
    assert json.loads(read[4].parsed) == {"id": 4, "name": "d", "amount": 1.0} and read[4].file.endswith("in.csv")
    # columns that a later query doesn't read count as well
    assert [df.count() for df in files.read_csv_quarantined(spark, str(tmp_path / "in.csv"), SCHEMA)] == [3, 5]


def test_observed_counts_are_those_of_a_scan(spark, tmp_path):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 7).alias("x"), F.when(F.col("id") % 5 > 0, F.col("id")).alias("y"))
    rules = {"x is 3": F.col("x") == 3, "y over 500": F.col("y") > 500, "never": F.lit(False)}
    got = write_observed(df.repartition(7), rules, str(tmp_path / "out"), ["id", "x"])
    assert got == {r.rule: r.n_bad for r in quality.rule_counts(df, rules).collect()} and got["x is 3"] == 143
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.columns == ["id", "x"] and back.count() == 1000
    assert write_observed(df.limit(0), rules, str(tmp_path / "none"), ["id"]) == {r: 0 for r in rules}


def test_landing_is_written_and_checked_in_one_pass(spark, tmp_path):
    src = R.raw_landing(Tables(spark, SF0001))
    got = bank_rules.land_observed(spark, src, R.LINEITEM_AS_OF, str(tmp_path))
    want = bank_rules.check_landing(spark, src, R.LINEITEM_AS_OF)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    for name, df in src.items():
        back = spark.read.parquet(str(tmp_path / name))
        assert back.columns == df.columns and back.count() == df.count()


DECLARED = "id string, amount double, tags array<string>, home struct<city: string, zip: string>, gone string"


def report(spark, docs):
    texts = [d if isinstance(d, str) or d is None else json.dumps(d) for d in docs]
    got = drift(spark.createDataFrame([(t,) for t in texts], "value string"), T.StructType.fromDDL(DECLARED))
    return {(r.path, r.status): (r.declared, r.found, r.n_docs) for r in got.collect()}


def test_drift_reports_added_retyped_and_missing(spark):
    docs = [{"id": "1", "amount": 2.5, "tags": ["a"], "home": {"city": "x", "zip": "1"}},
            {"id": "2", "amount": "2,5", "tags": "a", "home": {"city": "y", "zip": 7, "it's": True}},
            {"id": None, "amount": 3, "tags": [], "home": {"city": "z", "zip": "2"}, "new field": 1}]
    got = report(spark, docs + ["{", "[1]", None])
    assert got == {
        ("", "unreadable"): (None, None, 3), ("gone", "missing"): ("string", None, 3), ("id", "missing"): ("string", "string", 1),
        ("amount", "retyped"): ("double", "variant", 1), ("tags", "retyped"): ("array<string>", "variant", 1), ("home.zip", "retyped"): ("string", "variant", 1),
        ("home.it's", "added"): (None, "boolean", 1), ("new field", "added"): (None, "bigint", 1)}


@pytest.mark.parametrize("docs", [[], ["{}"], ["{", None]])
def test_drift_of_documents_without_fields(spark, docs):
    got = report(spark, docs)
    lacking = sum(d == "{}" for d in docs)
    assert got.get(("", "unreadable"), (0, 0, 0))[2] == len(docs) - lacking
    assert {p for p, s in got if s == "missing"} == ({"id", "amount", "tags", "home.city", "home.zip", "gone"} if lacking else set())
