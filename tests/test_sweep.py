import random

import pytest
from pyspark.sql import functions as F

from ringwatch.operators.metrics import pr_auc, pr_auc_by
from ringwatch.operators.sweep import draw_settings, halving_tree_sweep
from ringwatch.sources.tracking import read_runs


def test_grouped_average_precision_equals_one_by_one(spark):
    rng = random.Random(2)
    rows = [(g, rng.randrange(12) / 4, int(rng.random() < 0.3)) for g in range(6) for _ in range(rng.randint(5, 300))] + [(9, 0.5, 1)]
    df = spark.createDataFrame(rows, "trial int, score double, y int").repartition(5)
    got = {r.trial: r.pr_auc for r in pr_auc_by(df, "trial").collect()}
    assert got == {g: pytest.approx(pr_auc(df.filter(F.col("trial") == g).select("score", "y")), abs=1e-12) for g in (*range(6), 9)}


def test_halving_keeps_the_better_half(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, a := rng.random(), rng.random(), int(a + rng.random() > 1.4)) for i in range(300)]
    df = spark.createDataFrame(rows, "txn_id bigint, a double, b double, is_laundering int")
    df = df.withColumn("sender_seconds_since_last_send", F.lit(0))
    settings = draw_settings(5, 1)
    assert len({tuple(s.items()) for s in settings}) == 5
    ranked = halving_tree_sweep(df.filter("txn_id % 2 = 0"), df.filter("txn_id % 2 = 1"), str(tmp_path), features=("a", "b"),
                                settings=settings, rungs=(1, 2, 3))
    assert [r["rung"] for r in ranked] == [2, 2, 1, 0, 0] and {r["trial"] for r in ranked} == set(range(5))
    scores = spark.read.parquet(f"{tmp_path}/scores")
    assert {r.rung: r.n for r in scores.groupBy("rung").agg(F.countDistinct("trial").alias("n")).collect()} == {0: 5, 1: 3, 2: 2}
    first = {r.trial: r.pr_auc for r in pr_auc_by(scores.filter("rung = 0"), "trial").collect()}
    went_on = {r["trial"] for r in ranked if r["rung"] > 0}
    assert min(first[t] for t in went_on) >= max(v for t, v in first.items() if t not in went_on)
    runs = read_runs(spark, f"{tmp_path}/runs", "tree_halving").collect()
    assert {int(r.params["trial"]): r.metrics["pr_auc"] for r in runs} == {r["trial"]: r["pr_auc"] for r in ranked}


def test_trees_grown_together_are_mllibs(spark, monkeypatch):
    """Trials grown in shared passes, going on from rung to rung, score as fits of their own from the start do."""
    from ringwatch.operators import tree_fits
    from ringwatch.operators.models import fit_tree, score_with

    monkeypatch.setattr(tree_fits, "TREE_BLOCK_ROWS", 61)
    rng = random.Random(5)
    rows = [(i, a := rng.gauss(0, 1), b := float(rng.randrange(4)), rng.choice([0.0, rng.random()]), 1.0, int(a * b + rng.gauss(0, 1) > 1.5)) for i in range(600)]
    df = spark.createDataFrame(rows, "txn_id bigint, a double, b double, c double, k double, is_laundering int").repartition(3)
    df = df.withColumns({"sender_seconds_since_last_send": F.lit(0), "amount_paid": F.lit(1.0)})
    features = ("a", "b", "c", "k")
    settings = [{"max_depth": 3, "step_size": 0.1, "subsampling": 1.0}, {"max_depth": 5, "step_size": 0.2, "subsampling": 1.0},
                {"max_depth": 4, "step_size": 0.2, "subsampling": 0.7}]
    fits = tree_fits.TreeFits(df, features, settings, 42)
    for live, rounds in (([0, 1, 2], 2), ([1, 2], 5)):
        fits.grow(live, rounds)
        for t in live:
            own = score_with(fit_tree(df, features, 42, max_iter=rounds, **settings[t]), df).select("txn_id", F.col("score").alias("own"))
            off = F.abs(F.col("score") - F.col("own"))
            most, mean = fits.model(t).score(df).join(own, "txn_id").agg(F.max(off), F.avg(off)).first()
            assert most < 1e-9 if settings[t]["subsampling"] == 1 else mean < 0.15  # rows are drawn otherwise below 1
    assert [len(x) for x in fits.trees] == [2, 5, 5]
    fits.close()


def test_rows_are_drawn_at_the_rate(spark):
    import numpy as np

    from ringwatch.operators.tree_fits import uniform

    draws = [uniform(np.arange(20_000) * 1000 - 7, s) for s in (1, 2)]
    assert all(abs((u < 0.7).mean() - 0.7) < 0.02 and u.min() >= 0 and u.max() < 1 for u in draws)
    assert abs(np.corrcoef(*draws)[0, 1]) < 0.03


def test_halving_takes_passes_by_round_not_by_trial(spark, tmp_path, monkeypatch):
    from ringwatch.operators import tree_fits

    calls, real = [], tree_fits.summed
    monkeypatch.setattr(tree_fits, "summed", lambda *a: calls.append(1) or real(*a))
    rng = random.Random(6)
    rows = [(None if i % 50 == 0 else i, a := rng.random(), rng.random(), int(a + rng.random() > 1.4)) for i in range(200)]
    df = spark.createDataFrame(rows, "txn_id bigint, a double, b double, is_laundering int")
    settings = [{"max_depth": 2, "step_size": s, "subsampling": 0.7} for s in (0.1, 0.2, 0.3, 0.4)]
    ranked = halving_tree_sweep(df, df, str(tmp_path), features=("a", "b"), settings=settings, rungs=(1, 2))
    assert [r["rung"] for r in ranked] == [1, 1, 0, 0] and len(calls) <= 1 + 2 * 2
    with pytest.raises(ValueError, match="missing"):  # as single fits
        tree_fits.TreeFits(df.withColumn("b", F.when(F.col("a") < 0.5, F.col("b"))), ("a", "b"), settings)


def test_a_heavy_sample_has_more_bins(spark, monkeypatch):
    import numpy as np

    from ringwatch.operators import tree_fits

    assert len(tree_fits.thresholds(np.arange(1.0, 201), np.full(200, 1.2), 200.0, 31)) > 31
    monkeypatch.setattr(tree_fits, "thresholds", lambda *a: np.arange(40) / 40)
    df = spark.createDataFrame([(i, i / 100, int(i > 97)) for i in range(100)], "txn_id bigint, a double, is_laundering int")
    fits = tree_fits.TreeFits(df, ("a",), [{"max_depth": 2, "step_size": 0.1, "subsampling": 1.0}])
    fits.grow([0], 1)
    assert fits.cuts[0][fits.trees[0][0].bin[0]] == 0.975  # in the last bins
    fits.close()
