import datetime as dt
import os
import random

from conftest import transfer, ts
from pyspark.sql import functions as F

from ringwatch.operators.history import HISTORY_FEATURES, build_account_history_features
from ringwatch.sources.tracking import log_run, read_runs
from ringwatch.streaming.history_stream import apply_batch, assemble_features, late_transfers, run_stream


def _compare(stream, batch):
    s, b = ({r.txn_id: r for r in x.collect()} for x in (stream, batch))
    assert s.keys() == b.keys()
    for k in b:
        for c in HISTORY_FEATURES:
            assert s[k][c] == b[k][c], (k, c)


def _deliver(spark, deliveries, root, **kw):
    for i, tx in enumerate(deliveries):
        tx.write.parquet(f"{root}/source/d={i}")
        run_stream(spark, f"{root}/source", tx.schema, f"{root}/out", f"{root}/checkpoint", **kw)
    return f"{root}/out"


def test_stream_equals_batch_over_several_deliveries(spark, make_transfers, tmp_path):
    rng = random.Random(9)
    rows = [transfer(i, ts(rng.randrange(0, 90 * 4) / 4), f"A{rng.randrange(5)}", f"A{rng.randrange(5)}",
                     amount=round(rng.uniform(1, 50), 2)) for i in range(150)]
    rows.sort(key=lambda r: (r[1], r[0]))
    scorer = lambda d: d.withColumn("score", F.col("amount_paid") * F.col("in_out_ratio_before"))
    parts = [rows[:40], rows[40:41], rows[41:110], rows[110:]]
    out = _deliver(spark, [make_transfers(p).repartition(3) for p in parts], tmp_path, scorer=scorer)
    decisions = assemble_features(spark, out)
    assert decisions.filter(F.col("score").isNull()).count() == 0
    assert late_transfers(spark, out).count() == 0
    _compare(decisions, build_account_history_features(make_transfers(rows), None))
    # Sends of the last day keep their minutes, older ones are one row per account.
    sent = spark.read.parquet(f"{out}/state/sent").filter("epoch = 3")
    newest = max(r[1] for r in rows)
    old = sent.filter(F.col("timestamp") <= F.lit((newest - dt.timedelta(days=1)).isoformat(sep=" ")).cast("timestamp_ntz"))
    assert old.groupBy("account").count().filter("count > 1").count() == 0


def test_every_transfer_is_decided_or_late_once(spark, make_transfers, tmp_path):
    first = [transfer(1, ts(10), "A", "B"), transfer(2, ts(11), "C", "D")]
    # 3: behind A's mark though C has none that new; 4: behind D's mark (payee); 5: on time for both; 6: same minute, smaller id
    second = [transfer(3, ts(9), "A", "E"), transfer(4, ts(10.5), "E", "D"), transfer(5, ts(10.2), "A", "B"), transfer(0, ts(10), "F", "A")]
    third = [transfer(7, ts(12), "A", "D")]
    out = _deliver(spark, [make_transfers(x) for x in (first, second, third)], tmp_path)
    late = {r.txn_id: r for r in late_transfers(spark, out).collect()}
    done = {r.txn_id: r for r in assemble_features(spark, out).collect()}
    assert set(late) == {3, 4, 0} and set(done) == {1, 2, 5, 7}
    assert late[3].from_account == "A" and late[3].amount_paid == 100.0  # whole transfers
    assert done[7].sender_n_sent_before == 2 and done[7].receiver_n_received_before == 1  # late ones touch no account
    _compare(assemble_features(spark, out), build_account_history_features(make_transfers(first + [second[2]] + third), None))


def test_a_retried_batch_replaces_its_output(spark, make_transfers, tmp_path):
    a, b = make_transfers([transfer(1, ts(0), "A", "B")]), make_transfers([transfer(2, ts(1), "A", "B")])
    for epoch, batch in ((0, a), (1, b), (1, b)):
        apply_batch(batch, str(tmp_path), epoch)
    rows = {r.txn_id: r.sender_n_sent_before for r in assemble_features(spark, str(tmp_path)).collect()}
    assert rows == {1: 0, 2: 1}


def test_run_tracking_round_trip(spark, tmp_path):
    path = str(tmp_path / "runs")
    rid = log_run(spark, path, "baselines", {"model": "random", "seed": 42}, {"pr_auc": 0.1}, {"phase": "2"})
    log_run(spark, path, "other", {"model": "x"}, {"pr_auc": 0.2})
    runs = read_runs(spark, path, "baselines").collect()
    assert len(runs) == 1 and runs[0].run_id == rid
    assert runs[0].params["seed"] == "42" and runs[0].metrics["pr_auc"] == 0.1
    assert os.path.isdir(os.path.join(path, "experiment=other"))


def test_each_meeting_is_stored_once_and_no_table_of_all_pairs_is_rewritten(spark, make_transfers, tmp_path):
    from ringwatch.streaming.history_stream import apply_batch

    days = [[("A", "B"), ("A", "C"), ("A", "B")], [("A", "B"), ("B", "A")], [("B", "A"), ("A", "C"), ("C", "C")]]
    rows = [[transfer(10 * d + i, ts(24 * d + i), *p) for i, p in enumerate(day)] for d, day in enumerate(days)]
    for epoch, day in enumerate(rows):
        apply_batch(make_transfers(day), str(tmp_path), epoch)
    met = spark.read.parquet(f"{tmp_path}/met")
    assert sorted((r.epoch, r.from_account, r.to_account, r.txn_id) for r in met.collect()) == [
        (0, "A", "B", 0), (0, "A", "C", 1), (1, "B", "A", 11), (2, "C", "C", 22)]
    _compare(assemble_features(spark, str(tmp_path)), build_account_history_features(make_transfers(sum(rows, [])), None))
    assert not (tmp_path / "state" / "pairs").exists()
