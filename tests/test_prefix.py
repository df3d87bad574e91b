import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from ringwatch.operators.prefix import prefix_sum
from ringwatch.operators.quantiles import quantiles


def test_prefix_sum_equals_window(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice("ab" * 5 + "c"), rng.randrange(100)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, g string, v long")
    got = {r.id: r.cum_v for r in prefix_sum(df, ["id"], ["v"], partition_cols=["g"], num_partitions=9).collect()}
    w = Window.partitionBy("g").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    want = {r.id: r.c for r in df.select("id", F.sum("v").over(w).alias("c")).collect()}
    assert got == want
    glob = {r.id: r.cum_v for r in prefix_sum(df, ["id"], ["v"], inclusive=False, num_partitions=5).collect()}
    assert glob[0] == 0 and glob[2999] == sum(r[2] for r in rows[:-1])


def test_quantiles_nearest_and_linear(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 10, 10]], "v double")
    r = quantiles(df, "v", {"med": ("linear", 0.5), "p99": ("nearest", 0.99), "p0": ("nearest", 0.0)}).first()
    assert r.med == 3.5 and r.p99 == 10.0 and r.p0 == 1.0


def test_more_partitions_than_values(spark):
    rows = [(i, "ab"[i % 2], i % 7) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, g string, v long")
    got = {r.id: r.cum_v for r in prefix_sum(df, ["id"], ["v"], partition_cols=["g"], num_partitions=600).collect()}
    w = Window.partitionBy("g").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    want = {r.id: r.c for r in df.select("id", F.sum("v").over(w).alias("c")).collect()}
    assert got == want
