"""Hot keys: one key holding a third of all rows.  With AQE thresholds
scaled down to the test's size, the skewed join is split at run time and
results stay whole."""

import pytest

from ledgerlake.operators import nest

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2000",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture
def small_aqe(spark):
    old = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_child_rows_split_the_hot_parent(small_aqe):
    spark = small_aqe
    n = 30000
    child = spark.range(n).selectExpr("id AS tx_id",
                                      "CASE WHEN id % 3 = 0 THEN 0 ELSE id % 500 END AS cust",
                                      "id * 2 AS amount")
    parent = spark.range(600).selectExpr("id AS cust_id", "concat('c', id) AS name")
    out = nest.child_rows(parent, "cust_id", child, "cust")
    rows = out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "isSkewJoin=true" in plan or "skew=true" in plan
    # whole result: every child once, plus one row per childless parent (500..599)
    assert len([r for r in rows if r["tx_id"] is not None]) == n
    assert sorted(r["cust_id"] for r in rows if r["tx_id"] is None) == list(range(500, 600))


def test_plain_left_join_would_not_split(small_aqe):
    """Why child_rows avoids ``parent LEFT JOIN child``: AQE cannot split
    the right side of a left outer join, so the hot parent stays in one task."""
    spark = small_aqe
    child = spark.range(30000).selectExpr("id AS tx_id",
                                          "CASE WHEN id % 3 = 0 THEN 0 ELSE id % 500 END AS cust")
    parent = spark.range(600).selectExpr("id AS cust_id")
    out = parent.join(child, parent["cust_id"] == child["cust"], "left")
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "isSkewJoin=true" not in plan and "skew=true" not in plan
