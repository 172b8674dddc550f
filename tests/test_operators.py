"""Operators on small hand-made frames, checked against brute force."""

import datetime as dt
import random

from pyspark.sql import functions as F

from ledgerlake.operators import analytics, latest, nest, quality, slices


def test_latest_tie_break_and_forms_agree(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(1, 10, t, 5.0), (1, 11, t, 6.0), (2, 12, t, 7.0), (2, 13, t - dt.timedelta(1), 8.0)]
    df = spark.createDataFrame(rows, "k int, id int, ts timestamp, v double")
    a = {r["k"]: r["v"] for r in latest.latest_by_rank(df, ["k"], ["ts", "id"]).collect()}
    b = {r["k"]: r["v"] for r in latest.latest_by_agg(df, ["k"], ["ts", "id"], ["v"]).collect()}
    assert a == b == {1: 6.0, 2: 7.0}


def test_running_balance_hot_key_matches_brute_force(spark):
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(3000):
        k = 0 if i % 3 == 0 else rnd.randint(1, 40)          # key 0 holds a third of rows
        rows.append((i, k, base + dt.timedelta(minutes=rnd.randint(0, 5000)), rnd.randint(-500, 500)))
    df = spark.createDataFrame(rows, "id long, k long, ts timestamp, amt long")
    opening = spark.createDataFrame([(k, 1000 * k) for k in range(0, 41)], "k2 long, bal long")
    got = {r["id"]: r["running_balance"] for r in analytics.running_balance(
        df, "k", ["ts", "id"], "amt", opening, "k2", "bal").collect()}
    want = {}
    for k in set(r[1] for r in rows):
        total = 1000 * k
        for r in sorted([r for r in rows if r[1] == k], key=lambda r: (r[2], r[0])):
            total += r[3]
            want[r[0]] = total
    assert got == want


def test_sequence_ids_match_row_number(spark):
    rows = [(i * 7 % 1001, f"n{i}") for i in range(1001)]
    df = spark.createDataFrame(rows, "k long, name string")
    got = sorted((r["k"], r["seq"]) for r in analytics.sequence_ids(df, ["k"]).collect())
    want = [(k, i + 1) for i, k in enumerate(sorted(r[0] for r in rows))]
    assert got == want


def test_fk_orphans_counts_rows_of_missing_parents(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,), (9,), (9,), (9,)], "fk int")
    parent = spark.createDataFrame([(1,), (2,)], "pk int")
    other = spark.createDataFrame([(9,), (9,)], "pk int")
    got = quality.fk_orphans(child, [("c->p", "fk", parent, "pk"), ("c->q", "fk", other, "pk")]).collect()
    assert [tuple(r) for r in got] == [("c->p", 3), ("c->q", 3)]


def test_rule_counts_and_violations(spark):
    df = spark.createDataFrame([(1, "CUS0000001"), (-5, "CUSX"), (None, None)], "a int, id string")
    rules = {"a.negative": F.col("a") < 0,
             "id.pattern": quality.pattern_rule("id", r"^CUS[0-9]{7}$"),
             **quality.required_rules(["a", "id"])}
    got = {r["rule"]: r["n_bad"] for r in quality.rule_counts(df, rules).collect()}
    assert got == {"a.negative": 1, "id.pattern": 1, "required:a": 1, "required:id": 1}
    v = quality.violations(df, rules).collect()
    assert len(v) == 2


def test_duplicate_keys(spark):
    df = spark.createDataFrame([("a@x",), ("a@x",), ("b@x",)], "email string")
    d = quality.duplicate_keys(df.select(F.struct("email").alias("personal_info")),
                               ["personal_info.email"]).collect()
    assert [(r["email"], r["n"]) for r in d] == [("a@x", 2)]


def test_month_slices_half_open_across_year_end(spark):
    days = [dt.date(2024, 9, 30), dt.date(2024, 10, 1), dt.date(2025, 3, 31), dt.date(2025, 4, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r[0] for r in slices.month_range_filter(df, "d", "2024-10-15", 6).orderBy("d").collect()]
    assert got == [dt.date(2024, 10, 1), dt.date(2025, 3, 31)]
    w = slices.half_year_windows("2024-10-15", 2)
    assert w == [(dt.date(2024, 10, 1), dt.date(2025, 4, 1)), (dt.date(2025, 4, 1), dt.date(2025, 10, 1))]
    assert slices.trailing_months("2025-06-05", 12) == (dt.date(2024, 7, 1), dt.date(2025, 7, 1))
    empty = slices.scan_months(df, "d", [(2030, 1)])
    assert empty.count() == 0 and empty.columns == ["d"]


def test_lookup_by_ids_and_nest_children(spark):
    parent = spark.createDataFrame([("c1", [2, 1, 2, 99]), ("c2", [])], "id string, ids array<long>")
    child = spark.createDataFrame([(1, "x"), (2, "y")], "_id long, v string")
    out = {r["id"]: [d["_id"] for d in r["ids"]] for r in
           nest.lookup_by_ids(parent, "id", "ids", child, "_id").collect()}
    assert out == {"c1": [1, 2], "c2": []}
    kids = spark.createDataFrame([("c1", "t2", 5), ("c1", "t1", 6)], "cid string, _id string, n int")
    n = {r["id"]: [d["_id"] for d in r["tx"]] for r in
         nest.nest_children(parent, "id", kids, "cid", "tx", sort_by=["_id"]).collect()}
    assert n == {"c1": ["t1", "t2"], "c2": []}


def test_cashflow_spending_and_balance_after(spark):
    tx = spark.createDataFrame([("c", "Deposit", "branch", 280.0), ("c", "Withdrawal", "atm", -145.0),
                                ("c", "Transfer", "online", -60.0)],
                               "k string, t string, ch string, amt double")
    s = analytics.cashflow_summary(tx, "k", "amt").first()
    assert (s["total_inflow"], s["total_outflow"], s["net_cashflow"]) == (280.0, 205.0, 75.0)
    shares = {r["type"]: r["percentage"] for r in analytics.spending_by_type(tx, "k", "t", "amt").collect()}
    assert shares == {"Deposit": 57.7, "Withdrawal": 29.9, "Transfer": 12.4}
    ch = analytics.spending_by_channel(tx, "k", "ch", "amt").first()
    assert (ch["branch"], ch["atm"], ch["online"]) == (57.7, 29.9, 12.4)
    acc = spark.createDataFrame([("A", 100)], "a string, bal long")
    t2 = spark.createDataFrame([("A", -150, 2), ("A", -150, 4), ("A", 50, 1)], "a string, amt long, ty int")
    rows = {(r["amt"], r["ty"]): (r["amount_applied"], r["balance_after"], r["overdraft_flip"])
            for r in analytics.balance_after(t2, acc, "a", "a", "bal", "amt", "ty", [2, 3]).collect()}
    assert rows[(-150, 2)] == (150, 250, True)      # withdrawal flips
    assert rows[(-150, 4)] == (-150, -50, False)    # loan payment does not
    assert rows[(50, 1)] == (50, 150, False)


def test_max_id_and_table_counts(spark):
    df = spark.createDataFrame([("CUS0000009",), ("CUS0000010",)], "id string")
    assert analytics.max_id(df, "id", "CUS").first()[0] == 10
    assert analytics.max_id(df.where("false"), "id", "CUS").first()[0] == 0
    c = {r["table_name"]: r["row_count"] for r in analytics.table_counts({"a": df, "b": df.where("false")}).collect()}
    assert c == {"a": 2, "b": 0}


def test_sequence_ids_with_a_hot_value_are_spread_and_ordered(spark):
    rows = [(0 if i % 3 == 0 else i, i) for i in range(3000)]     # value 0 holds a third
    df = spark.createDataFrame(rows, "k long, payload long")
    out = analytics.sequence_ids(df, ["k"])
    got = sorted((r["seq"], r["k"]) for r in out.collect())
    assert [s for s, _ in got] == list(range(1, 3001))
    assert [k for _, k in got] == sorted(r[0] for r in rows)
    from pyspark.sql import functions as F
    parts = (df.withColumn("__tb", F.monotonically_increasing_id())
             .repartitionByRange(6, "k", "__tb").where("k = 0")
             .select(F.spark_partition_id().alias("p")).distinct().count())
    assert parts > 1


def test_small_helpers(spark):
    from ledgerlake.operators import conform
    df = spark.createDataFrame([("a", 3, -5), ("b", 1, 7)], "x string, t int, amt int")
    assert conform.select_as(df, [("t", "type"), ("x", "id")]).columns == ["type", "id"]
    r = df.select(conform.only_for(F.col("t") == 3, F.col("x")).alias("o"),
                  analytics.signed_amount(F.col("amt"), F.lit(-1)).alias("neg"),
                  analytics.signed_amount(F.col("amt"), F.lit(0)).alias("keep")).collect()
    assert [(x["o"], x["neg"], x["keep"]) for x in r] == [("a", -5, -5), (None, -7, 7)]
    st = spark.createDataFrame([("3",), ("O",), ("Quá hạn",)], "s string")
    got = [x[0] for x in st.select(conform.normalize_status(F.col("s"), {"O": "Đang vay"})).collect()]
    assert got == ["Đã thanh toán", "Đang vay", "Quá hạn"]


def test_top_k_per_key_with_rank(spark):
    df = spark.createDataFrame([(1, i, float(i)) for i in range(5)] + [(2, 9, 1.0)], "k int, id int, v double")
    out = latest.latest_by_rank(df, ["k"], ["v", "id"], n=2, rank_col="rank")
    got = sorted((r["k"], r["id"], r["rank"]) for r in out.collect())
    assert got == [(1, 3, 2), (1, 4, 1), (2, 9, 1)]


def test_running_balance_keeps_null_keys_and_times(spark):
    t0 = dt.datetime(2024, 1, 1)
    rnd = random.Random(3)
    rows = []
    for i in range(4000):
        k = rnd.choice([None, 0, 1, 2, 2**60 + 1])
        ts = None if i % 7 == 0 else t0 if i % 3 == 0 else t0 + dt.timedelta(seconds=rnd.randint(1, 900))
        rows.append((i, k, ts, None if i % 11 == 0 else rnd.randint(-9, 9)))
    df = spark.createDataFrame(rows, "id long, k long, ts timestamp, amt long").repartition(5)
    got = {(r["id"], r["k"], r["ts"]): r["running_balance"] for r in analytics.running_balance(df, "k", ["ts", "id"], "amt").collect()}
    want, tot = {}, {}
    for i, k, ts, a in sorted(rows, key=lambda r: (r[2] is not None, r[2] or t0, r[0])):
        tot[k] = tot.get(k, 0) + (a or 0)
        want[i, k, ts] = tot[k]
    assert got == want


def test_running_balance_ranges_one_instant_holds_a_third(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, 7, t0, 1) for i in range(2000)]                                  # one instant
    rows += [(5000 + i, i % 50, t0 + dt.timedelta(seconds=i), 2) for i in range(4000)]
    df = spark.createDataFrame(rows, "id long, k long, ts timestamp, amt long")
    opening = spark.createDataFrame([(7, 100)], "ok long, ob long")
    out = analytics.running_balance(df, "k", ["ts", "id"], "amt", opening, "ok", "ob")
    got = {r["id"]: r["running_balance"] for r in out.collect()}
    want, tot = {}, {}
    for r in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        tot[r[1]] = tot.get(r[1], 100 if r[1] == 7 else 0) + r[3]
        want[r[0]] = tot[r[1]]
    assert got == want
    from pyspark.sql import functions as F
    spread = (df.repartitionByRange(8, "k", "ts", "id").where("k = 7")
              .select(F.spark_partition_id()).distinct().count())
    assert spread > 1


def test_driver_tables_as_sql_views(spark):
    from ledgerlake.sources.tables import Tables
    from tests.conftest import SF0001
    Tables(spark, SF0001).register_views()
    n = spark.sql("SELECT count(*) FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey").first()[0]
    assert n == spark.read.parquet(f"{SF0001}/orders.parquet").count()


def test_nest_children_chunked_is_whole_ordered_and_bounded(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [("hot", i, t0 + dt.timedelta(seconds=(i * 7) % 2500)) for i in range(2500)]
    rows += [("c2", 9000 + i, t0 + dt.timedelta(seconds=i)) for i in range(3)]
    df = spark.createDataFrame(rows, "cid string, tid long, ts timestamp")
    out = nest.nest_children_chunked(df, "cid", ["ts", "tid"], chunk_size=1000, as_col="tx").collect()
    sizes = sorted((r["cid"], r["chunk"], r["n"]) for r in out)
    assert sizes == [("c2", 0, 3), ("hot", 0, 1000), ("hot", 1, 1000), ("hot", 2, 500)]
    hot = [t["tid"] for r in sorted((r for r in out if r["cid"] == "hot"), key=lambda r: r["chunk"])
           for t in r["tx"]]
    assert hot == [r[1] for r in sorted((r for r in rows if r[0] == "hot"), key=lambda r: (r[2], r[1]))]


def test_order_number_orders_as_time_and_id(spark):
    """NULLs first, any sign and size of id, times of any type."""
    times = [None, dt.datetime(1, 1, 2), dt.datetime(1969, 12, 31), dt.datetime(2024, 1, 1, 0, 0, 0, 1), dt.datetime(9999, 12, 30)]
    ids = [None, -(2**63), -1, 0, 2**63 - 1]
    rows = [(1, t, i, n * 10 + k) for n, t in enumerate(times) for k, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "k int, ts timestamp, id long, v int")
    for typed in (df, df.withColumn("ts", F.col("ts").cast("timestamp_ntz")), df.withColumn("ts", F.col("ts").cast("date"))):
        numbered = typed.withColumn("o", latest.order_number(typed, ["ts", "id"]))
        assert [r.v for r in numbered.orderBy("o").collect()] == [r.v for r in typed.orderBy(F.col("ts").asc_nulls_first(), F.col("id").asc_nulls_first()).collect()]
    assert latest.order_number(df, ["id", "ts"]) is None
    assert latest.latest_by_agg(df, ["k"], ["ts", "id"], ["v"]).first().v == 44
    some = df.where("ts IS NULL")
    assert latest.latest_by_agg(some, ["k"], ["ts", "id"], ["v"]).first().v == 4
    texts = df.withColumn("v", F.col("v").cast("string"))
    assert latest.latest_by_agg(texts, ["k"], ["ts", "id"], ["v"]).collect() == [(1, "44")]
