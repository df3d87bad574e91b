import random

import pytest
from conftest import transfer, ts
from pyspark.sql import functions as F

from ringwatch.functions.basic import build_basic_features
from ringwatch.operators.compiled import CompiledLinear, CompiledTrees, explained_queue
from ringwatch.operators.history import build_account_history_features
from ringwatch.operators.models import PARITY_FEATURES, TREE_FEATURES, fit_edge_scorer, fit_tree, score_with


@pytest.fixture(scope="module")
def frames(spark):
    from ringwatch.sources.transfers import TRANSFER_SCHEMA
    rng = random.Random(8)
    rows = []
    for i in range(400):
        pos = rng.random() < 0.2
        rows.append(transfer(i, ts(rng.randrange(0, 200)), f"A{rng.randrange(15)}", f"A{rng.randrange(15)}", label=int(pos),
                             amount=round(rng.uniform(300, 900) if pos else rng.uniform(1, 500), 2),
                             fmt=rng.choice(["ACH", "Wire", "Cash"] if i % 3 else ["ACH", "Cheque"]),
                             rc=rng.choice(["Euro", "Yen"])))
    f = build_account_history_features(build_basic_features(spark.createDataFrame(rows, TRANSFER_SCHEMA)), None)
    f = f.na.fill(0, ["sender_seconds_since_last_send"])
    return f.filter("txn_id % 3 > 0").cache(), f.cache()


def _same(model, compiled, df):
    a = score_with(model, df).select("txn_id", "score")
    b = compiled.score(df).select("txn_id", F.col("score").alias("other"))
    rows = a.join(b, "txn_id").collect()
    assert len(rows) == df.count() and max(abs(r.score - r.other) for r in rows) < 1e-12


@pytest.mark.parametrize("features", [PARITY_FEATURES, TREE_FEATURES])
def test_compiled_trees_equal_transform(frames, features):
    """Codes of values unseen in training and missing numbers included."""
    train, every = frames
    model = fit_tree(train, features, max_iter=6, max_depth=4)
    odd = every.withColumn("log_amount", F.when(F.col("txn_id") % 7 > 0, F.col("log_amount")))
    odd = odd.withColumn("payment_format", F.when(F.col("txn_id") % 5 > 0, F.col("payment_format")).otherwise("Seashells"))
    odd = odd.withColumn("payment_format", F.when(F.col("txn_id") % 11 > 0, F.col("payment_format")))
    compiled = CompiledTrees.of(model)
    _same(model, compiled, odd)
    plan = compiled.score(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "UDF" not in plan


def test_contributions_add_up_and_follow_the_path(frames):
    train, every = frames
    compiled = CompiledTrees.of(fit_tree(train, PARITY_FEATURES, max_iter=4, max_depth=3))
    rows = compiled.score(every, reasons=True).collect()

    def walk(row, node, out):
        if node.feature is None:
            return out
        child = node.left if row[compiled.features[node.feature]] <= node.threshold else node.right
        name = compiled.features[node.feature]
        out[name] = out.get(name, 0.0) + child.prediction - node.prediction
        return walk(row, child, out)

    for r in rows:
        want: dict[str, float] = {}
        for tree, w in zip(compiled.trees, compiled.weights):
            for name, v in walk(r, tree, {}).items():
                want[name] = want.get(name, 0.0) + w * v
        got = {c.feature: c.value for c in r.contributions}
        assert r.base + sum(got.values()) == pytest.approx(r.margin, abs=1e-12)
        assert all(got[c] == pytest.approx(want.get(c, 0.0), abs=1e-12) for c in got) and set(want) <= set(got)


def test_queue_ranks_accounts_with_reasons(frames):
    train, every = frames
    scored = CompiledTrees.of(fit_tree(train, PARITY_FEATURES, max_iter=4)).score(every, reasons=True)
    queue = explained_queue(scored, 5, 2).collect()
    best = {}
    for r in scored.collect():
        if r.from_account not in best or (r.score, -r.txn_id) > (best[r.from_account].score, -best[r.from_account].txn_id):
            best[r.from_account] = r
    want = sorted(best.values(), key=lambda r: (-r.score, r.from_account))[:5]
    assert [(q.account, q.top_txn_id) for q in queue] == [(r.from_account, r.txn_id) for r in want]
    for q, r in zip(queue, want):
        top = sorted(((-c.value, c.feature) for c in r.contributions if c.value > 0))[:2]
        assert [x.feature for x in q.reasons] == [f for _, f in top]


def test_compiled_linear_equals_transform(frames):
    train, every = frames
    cols = ["log_amount", "hour", "amount_ratio", "sender_n_sent_before"]
    model = fit_edge_scorer(train, cols)
    _same(model, CompiledLinear.of(model), every)


def test_single_leaf(frames):
    """A model that found nothing to split on: one leaf per tree, no reasons."""
    train, every = frames
    compiled = CompiledTrees.of(fit_tree(train.withColumn("hour", F.lit(1)), ("hour",), max_iter=2))
    r = compiled.score(every, reasons=True).first()
    assert r.contributions == [] and r.margin == pytest.approx(r.base)
