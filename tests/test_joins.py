import datetime as dt

from conftest import transfer, ts
from pyspark.sql import functions as F

from ringwatch.operators.joins import asof_join, attach_pattern_ids


def test_attach_pattern_ids(spark, make_transfers):
    tx = make_transfers([transfer(1, ts(0), "A", "B", amount=10.0), transfer(2, ts(1), "A", "C", amount=20.0)])
    rings = tx.filter(F.col("txn_id") == 1).select("timestamp", "from_account", "to_account", "amount_paid",
                                                  F.lit(7).alias("pattern_id"), F.lit(0).alias("hop"))
    dup = rings.withColumn("pattern_id", F.lit(9))
    out = {r.txn_id: r.pattern_id for r in attach_pattern_ids(tx, rings.unionByName(dup)).collect()}
    assert out == {1: 7, 2: -1}  # keep-first by (pattern_id, hop); no duplicated transfers


def test_asof_join_inclusive_backward(spark):
    left = spark.createDataFrame([("a", dt.datetime(2022, 1, 1, 10)), ("a", dt.datetime(2022, 1, 1, 12)),
                                  ("b", dt.datetime(2022, 1, 1, 9))], "k string, t timestamp_ntz")
    right = spark.createDataFrame([("a", dt.datetime(2022, 1, 1, 10), 1.0), ("a", dt.datetime(2022, 1, 1, 11), 2.0),
                                   ("b", dt.datetime(2022, 1, 1, 10), 3.0)], "k string, rt timestamp_ntz, v double")
    out = sorted((r.k, r.t.hour, r.v) for r in asof_join(left, right, ["k"], "t", "rt", ["v"]).collect())
    assert out == [("a", 10, 1.0), ("a", 12, 2.0), ("b", 9, None)]


def test_bucketed_asof_equals_plain(spark):
    import random
    rng = random.Random(2)
    base = dt.datetime(2022, 1, 1)
    left = spark.createDataFrame([(f"k{rng.randrange(3)}", base + dt.timedelta(minutes=rng.randrange(600)), i)
                                  for i in range(300)], "k string, t timestamp_ntz, lid long")
    right = spark.createDataFrame([(f"k{rng.randrange(3)}", base + dt.timedelta(minutes=rng.randrange(600)), i, float(i))
                                   for i in range(200)], "k string, rt timestamp_ntz, rid long, v double")
    a = {r.lid: (r.v, r.rid) for r in asof_join(left, right, ["k"], "t", "rt", ["v", "rid"], tie="rid").collect()}
    for b in (60, 3600, 86400):
        got = {r.lid: (r.v, r.rid) for r in
               asof_join(left, right, ["k"], "t", "rt", ["v", "rid"], tie="rid", bucket_seconds=b).collect()}
        assert got == a, b
