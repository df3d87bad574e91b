import datetime as dt
import random

from conftest import transfer, ts
from pyspark.sql import functions as F

from ringwatch.operators.history import HISTORY_FEATURES, build_account_history_features
from ringwatch.operators.models import _assert_no_labels
from ringwatch.operators.monitoring import alert_forecast, alert_queue, ego_network, leak_audit, parity, psi, staleness
from ringwatch.operators.scaler import EdgeScaler


def _rows(n=120, seed=4):
    rng = random.Random(seed)
    return [transfer(i, ts(rng.randrange(0, 200)), f"A{rng.randrange(7)}", f"A{rng.randrange(7)}",
                     amount=round(rng.uniform(1, 80), 2), label=int(rng.random() < 0.1)) for i in range(n)]


def test_leak_audit_is_empty(make_transfers):
    assert leak_audit(make_transfers(_rows()), ts(100)).count() == 0


def test_leak_audit_sees_a_sample_that_looks_ahead(make_transfers, monkeypatch):
    """The by-day sample taken over all edges (later ones included) must not pass."""
    from ringwatch.operators import graph

    def looks_ahead(e, cap, seed):
        top = graph.fanout_sample(e, 2, node="dst", seed=seed)
        days = e.select(F.col("dst").alias("account"), F.date_add("day", 1).alias("_from")).distinct()
        return days.join(top.select(F.col("dst").alias("account"), "src", "day"), "account").filter(
            F.col("day") < F.col("_from")).groupBy("account", "_from").agg(F.collect_list("src").alias("sample"))

    monkeypatch.setattr(graph, "in_samples", looks_ahead)
    found = {r.feature for r in leak_audit(make_transfers(_rows(400)), ts(100)).collect()}
    assert any(f.startswith("by_day_h1_") for f in found)


def test_alert_forecast_counts_days_without_alerts(make_transfers):
    tx = make_transfers([transfer(1, ts(0, day=1), "A", "B"), transfer(2, ts(1, day=1), "A", "B"), transfer(3, ts(0, day=4), "A", "B")])
    rows = {r.day.day: r for r in alert_forecast(tx).collect()}
    assert [rows[d].alerts for d in (1, 2, 3, 4)] == [2, 0, 0, 1]
    assert rows[4].trailing_mean == 2 / 3


def test_ego_network_keeps_every_edge(spark):
    edges = spark.createDataFrame([(i, "hub", f"b{i}") for i in range(40)] + [(100 + i, "b1", f"c{i}") for i in range(30)]
                                  + [(999, "far", "hub")], "txn_id long, src string, dst string")
    out = ego_network(edges, spark.createDataFrame([("hub",)], "account string"), 2).collect()
    assert len(out) == 70 and {r.hop for r in out} == {1, 2}


def test_ego_network_equals_breadth_first_search(spark):
    """Cycles, self transfers, parallel edges, null accounts, seeds among each other's payees."""
    rng = random.Random(11)
    name = lambda: None if rng.random() < 0.05 else f"n{rng.randrange(25)}"
    rows = [(i, name(), name()) for i in range(60)] + [(100, "n1", "n1"), (101, "n1", "n2"), (102, "n1", "n2")]
    edges = spark.createDataFrame(rows, "txn_id long, src string, dst string")
    seeds = spark.createDataFrame([("n1",), ("n2",), ("n1",), (None,)], "account string")
    for hops in (1, 2, 5, 40):
        dist, frontier = {"n1": 0, "n2": 0}, ["n1", "n2"]
        for d in range(1, hops):
            frontier = sorted({t for _, f, t in rows if f in frontier and t is not None} - dist.keys())
            dist.update({a: d for a in frontier})
        want = sorted((i, f, t or "", dist[f] + 1) for i, f, t in rows if f in dist)
        got = sorted((r.txn_id, r.src, r.dst or "", r.hop) for r in ego_network(edges, seeds, hops).collect())
        assert got == want


def test_ego_network_with_a_cap(spark):
    edges = spark.createDataFrame([(i, "hub", f"b{i}") for i in range(40)] + [(100 + i, f"b{i}", "hub") for i in range(40)],
                                  "txn_id long, src string, dst string")
    out = ego_network(edges, spark.createDataFrame([("hub",)], "account string"), 6, fanout=4).collect()
    assert len(out) == 8 and len({r.txn_id for r in out}) == 8
    assert {r.dst for r in out if r.hop == 1} == {r.src for r in out if r.hop == 2}


def test_alert_reasons_are_scaled(spark):
    f = spark.createDataFrame([(1, "A", 9.0, 1000.0, 1.0), (2, "B", 8.0, 900.0, 0.0)], "txn_id long, from_account string, score double, big double, small double")
    scaler = EdgeScaler({"big": 7.0, "small": 0.0}, {"big": 1.0, "small": 0.1})
    rows = {r.account: r.reasons for r in alert_queue(f, ["big", "small"], scaler, 5, 1).collect()}
    assert rows == {"A": "small", "B": "small"} or rows["A"] == "small"


def test_parity_detects_a_difference(make_transfers):
    tx = make_transfers(_rows())
    a = build_account_history_features(tx, None)
    b = a.withColumn("sender_n_sent_before", F.when(F.col("txn_id") == 3, 99).otherwise(F.col("sender_n_sent_before")))
    d = {r.feature: r.differing for r in parity(a, b, "txn_id", list(HISTORY_FEATURES)).collect()}
    assert d["sender_n_sent_before"] == 1 and sum(d.values()) == 1


def test_label_columns_rejected_as_features():
    import pytest
    with pytest.raises(ValueError):
        _assert_no_labels(["hour", "is_laundering"])


def test_psi_zero_for_same_distribution(spark):
    df = spark.range(1000).select((F.col("id") % 7).cast("double").alias("v"))
    assert abs(psi(df, df, F.col("v")).first().psi) < 1e-12


def test_staleness_ages(make_transfers):
    tx = make_transfers([transfer(1, ts(0), "A", "B"), transfer(2, ts(5), "B", "C")])
    got = {r.account: r.age_seconds for r in staleness(tx, ts(10)).collect()}
    assert got == {"A": 36000, "B": 18000, "C": 18000}
