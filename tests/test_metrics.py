import pytest
from pyspark.sql import functions as F

from ringwatch.operators.metrics import evaluate, flatten_metrics, pr_auc, precision_at_k, top_k

SCHEMA = "txn_id long, y int, score double, pattern_id int, amount double"


def scored(spark, ys, scores, pids=None, amounts=None):
    n = len(ys)
    pids = pids or [-1] * n
    amounts = amounts or [1.0] * n
    return spark.createDataFrame([(i, ys[i], float(scores[i]), pids[i], float(amounts[i])) for i in range(n)], SCHEMA)


def tidy(df):
    return {(r.metric, r.k): r.value for r in df.collect()}


def test_precision_at_3(spark):
    s = scored(spark, [1, 0, 1, 0, 0], [0.9, 0.8, 0.7, 0.6, 0.5])
    p = {r.k: r.precision for r in precision_at_k(s, (3,)).collect()}
    assert p[3] == pytest.approx(2 / 3)


def test_tied_precision_is_order_free(spark):
    ys = [1, 1] + [0] * 8
    a = {r.k: r.precision for r in precision_at_k(scored(spark, ys, [0.5] * 10), (5,)).collect()}
    b = {r.k: r.precision for r in precision_at_k(scored(spark, ys[::-1], [0.5] * 10), (5,)).collect()}
    assert a == b == {5: pytest.approx(0.2)}


def test_k_larger_than_rows_is_clamped(spark):
    s = scored(spark, [1, 0], [0.9, 0.1])
    assert tidy(evaluate(s, (10,), patterns=False, cost=False))[("precision_at_k", 10)] == 0.5


def test_pr_auc_average_precision(spark):
    # y 1,0,1 with scores .9,.8,.7 -> AP = (1 * 1 + 1 * 2/3) / 2
    s = scored(spark, [1, 0, 1], [0.9, 0.8, 0.7])
    assert pr_auc(s) == pytest.approx((1 + 2 / 3) / 2)


def test_pr_auc_ties_are_one_step(spark):
    s = scored(spark, [1, 0, 1, 0], [0.5, 0.5, 0.5, 0.5])
    assert pr_auc(s) == pytest.approx(0.5)


def test_errors(spark):
    with pytest.raises(ValueError):
        pr_auc(scored(spark, [0, 0], [0.1, 0.2]))
    with pytest.raises(ValueError):
        evaluate(scored(spark, [1, 0], [0.1, 0.2]), (0,))
    with pytest.raises(ValueError):
        evaluate(scored(spark, [1, 0], [0.1, float("nan")]), (1,))
    with pytest.raises(ValueError):
        evaluate(scored(spark, [1, 0], [0.1, 0.2]), (1,), pattern_threshold=0.0)


def test_ring_recall_and_hit_rate(spark):
    # ring 1: 4 rows, 1 flagged; ring 2: 2 rows, none flagged; k = 1
    ys = [1, 1, 1, 1, 1, 1, 0]
    scores = [0.99, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6]
    pids = [1, 1, 1, 1, 2, 2, -1]
    t = tidy(evaluate(scored(spark, ys, scores, pids), (1,)))
    assert t[("pattern_n_patterns", 1)] == 2
    assert t[("pattern_hit_rate", 1)] == 0.5
    assert t[("pattern_recall", 1)] == 0.0


def test_cost_at_k(spark):
    s = scored(spark, [1, 1, 0, 0], [0.9, 0.1, 0.2, 0.3], amounts=[1000, 5000, 10, 10])
    t = tidy(evaluate(s, (1,)))
    assert t[("cost_investigator_hours", 1)] == 0.5
    assert t[("cost_laundering_value_caught", 1)] == 1000.0
    assert t[("cost_laundering_value_missed", 1)] == 5000.0


def test_random_baseline_near_base_rate(spark):
    from ringwatch.operators.metrics import rank_randomly
    df = spark.range(20000).select(F.col("id").alias("txn_id"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    s = df.select("txn_id", "y", rank_randomly(df, 42).alias("score"), F.lit(-1).alias("pattern_id"),
                  F.lit(1.0).alias("amount"))
    t = tidy(evaluate(s, (1000,), patterns=False))
    assert abs(t[("precision_at_k", 1000)] - 0.1) < 0.04
    assert abs(t[("pr_auc", None)] - 0.1) < 0.03


def test_topk_is_stable_on_ties(spark):
    s = scored(spark, [0] * 5, [1.0, 2.0, 2.0, 2.0, 0.5])
    assert [r.txn_id for r in top_k(s, 3).orderBy("rank").collect()] == [1, 2, 3]


def test_flatten_names(spark):
    s = scored(spark, [1, 0, 1, 0], [0.9, 0.8, 0.7, 0.1], pids=[3, -1, 3, -1])
    names = {r.name for r in flatten_metrics(evaluate(s, (2,))).collect()}
    assert names == {"pr_auc", "base_rate", "n_rows", "n_positives", "precision_at_2", "lift_at_2",
                     "pattern_recall_at_2", "pattern_hit_rate_at_2", "value_missed_at_2"}


def test_evaluate_invariant_to_partitioning(spark):
    import random
    rng = random.Random(6)
    ys = [int(rng.random() < 0.2) for _ in range(500)]
    scores = [round(rng.random(), 2) for _ in range(500)]  # many ties
    pids = [rng.choice([-1, -1, 1, 2, 3]) for _ in range(500)]
    s = scored(spark, ys, scores, pids)
    a = tidy(evaluate(s, (10, 50, 100)))
    b = tidy(evaluate(s.repartition(13).orderBy(F.rand(1)), (10, 50, 100)))
    assert a.keys() == b.keys()
    for key in a:
        assert a[key] == pytest.approx(b[key])
