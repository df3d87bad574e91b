import random
import re
from decimal import Decimal

import pytest
from conftest import transfer, ts

from ringwatch.operators.history import HISTORY_FEATURES, build_account_history_features

BLOCKS = [1, 1 << 17]


def _feats(df, as_of=None, **kw):
    return {r["txn_id"]: r for r in build_account_history_features(df, as_of, **kw).collect()}


def _by_hand(rows):
    """E1-E9 by a straight reading: for each transfer, look at all earlier ones."""
    out = {}
    order = sorted(rows, key=lambda r: (r[1], r[0]))
    for i, r in enumerate(order):
        sent = [x for x in order[:i] if x[3] == r[3]]
        got = [x for x in order[:i] if x[5] == r[5]]
        day = [x for x in sent if (r[1] - x[1]).total_seconds() < 86400]
        out[r[0]] = {"sender_n_sent_before": len(sent), "sender_amount_sent_before": float(sum(Decimal(str(x[8])) for x in sent)),
                     "sender_distinct_out_before": len({x[5] for x in sent}),
                     "sender_seconds_since_last_send": (r[1] - sent[-1][1]).total_seconds() if sent else None,
                     "receiver_n_received_before": len(got), "receiver_amount_received_before": float(sum(Decimal(str(x[8])) for x in got)),
                     "receiver_distinct_in_before": len({x[3] for x in got}), "sender_sent_last_24h": len(day),
                     "in_out_ratio_before": (len(got) + 1) / (len(sent) + 1)}
    return out


@pytest.mark.parametrize("block", BLOCKS)
def test_sends_before_exclude_current_row(make_transfers, block):
    df = make_transfers([transfer(1, ts(0), "A", "B"), transfer(2, ts(1), "A", "C"), transfer(3, ts(2), "A", "D")])
    f = _feats(df, id_block=block)
    assert [f[i]["sender_n_sent_before"] for i in (1, 2, 3)] == [0, 1, 2]
    assert [f[i]["sender_amount_sent_before"] for i in (1, 2, 3)] == [0.0, 100.0, 200.0]
    assert [f[i]["receiver_n_received_before"] for i in (1, 2, 3)] == [0, 0, 0]


@pytest.mark.parametrize("block", BLOCKS)
def test_distinct_partners(make_transfers, block):
    df = make_transfers([transfer(1, ts(0), "A", "B"), transfer(2, ts(1), "A", "B"), transfer(3, ts(2), "A", "C")])
    f = _feats(df, id_block=block)
    assert [f[i]["sender_distinct_out_before"] for i in (1, 2, 3)] == [0, 1, 1]


@pytest.mark.parametrize("block", BLOCKS)
def test_velocity_window_is_open_at_24h(make_transfers, block):
    df = make_transfers([transfer(1, ts(0), "A", "B"), transfer(2, ts(1), "A", "B"), transfer(3, ts(100), "A", "B"),
                         transfer(4, ts(124), "A", "B")])
    f = _feats(df, id_block=block)
    assert [f[i]["sender_sent_last_24h"] for i in (1, 2, 3, 4)] == [0, 1, 0, 0]


@pytest.mark.parametrize("block", BLOCKS)
def test_gap_seconds(make_transfers, block):
    df = make_transfers([transfer(1, ts(0), "A", "B"), transfer(2, ts(2), "A", "B")])
    f = _feats(df, id_block=block)
    assert f[1]["sender_seconds_since_last_send"] is None
    assert f[2]["sender_seconds_since_last_send"] == 7200


@pytest.mark.parametrize("block", BLOCKS)
def test_as_of_drops_rows_first(make_transfers, block):
    df = make_transfers([transfer(1, ts(0), "A", "B"), transfer(2, ts(48), "A", "B")])
    f = _feats(df, as_of=ts(24), id_block=block)
    assert list(f) == [1]
    assert f[1]["sender_n_sent_before"] == 0


@pytest.mark.parametrize("block", BLOCKS)
def test_in_out_ratio_mixes_payee_receipts_and_payer_sends(make_transfers, block):
    df = make_transfers([transfer(1, ts(0), "X", "B"), transfer(2, ts(1), "A", "B")])
    f = _feats(df, id_block=block)
    assert f[2]["in_out_ratio_before"] == 2.0  # B received once before, A sent zero times


def _random_transfers(n, seed, accounts=6, minutes=40):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b = rng.randrange(accounts), rng.randrange(accounts)
        rows.append(transfer(1000 + i * 7 % 997 + i * 1000, ts(rng.randrange(minutes) / 60.0), f"A{a}", f"A{b}",
                             amount=round(rng.uniform(0, 500), 2)))
    return rows


def test_equals_hand_count_on_ties_and_scattered_blocks(make_transfers):
    rows = _random_transfers(400, 7)
    want = _by_hand(rows)
    for block in (1, 3, 50_000, 1 << 17):
        got = _feats(make_transfers(rows), id_block=block)
        assert got.keys() == want.keys()
        for k in want:
            for c in HISTORY_FEATURES:
                assert got[k][c] == want[k][c], (block, k, c)


def test_amounts_below_a_cent_add_up(make_transfers):
    rows = [transfer(i, ts(i), "A", "B", amount=0.000123) for i in range(5)]
    f = _feats(make_transfers(rows))
    assert f[4]["sender_amount_sent_before"] == 0.000492 and f[4]["receiver_amount_received_before"] == 0.000492


def test_amounts_with_too_many_decimals_are_an_error(make_transfers):
    with pytest.raises(Exception, match="more than 8 decimals"):
        _feats(make_transfers([transfer(1, ts(0), "A", "B", amount=1.1234567891)]))


def test_windows_by_account_alone_run_on_the_minute_table(make_transfers):
    plan = build_account_history_features(make_transfers(_random_transfers(50, 1)), None)._jdf.queryExecution().optimizedPlan().toString()
    keys = re.findall(r"Window \[.*\], \[([^\]]*)\], \[", plan)
    alone = [k for k in keys if len(k.split(", ")) == 1]
    assert keys and alone
    for line in plan.splitlines():
        if re.search(r"Window .*\], \[(from|to)_account#\d+\], \[", line):
            assert "_m" in line and "txn_id" not in line  # sums of minute totals


def test_row_order_and_partitioning_do_not_change_results(make_transfers):
    rows = _random_transfers(200, 3)
    a = _feats(make_transfers(rows))
    shuffled = list(rows)
    random.Random(1).shuffle(shuffled)
    b = _feats(make_transfers(shuffled).repartition(5))
    assert a == b


def test_account_renaming_is_invariant(make_transfers):
    rows = _random_transfers(150, 11)
    renamed = [r[:3] + ("Z" + r[3],) + r[4:5] + ("Z" + r[5],) + r[6:] for r in rows]
    a, b = _feats(make_transfers(rows)), _feats(make_transfers(renamed))
    for k in a:
        assert [a[k][c] for c in HISTORY_FEATURES] == [b[k][c] for c in HISTORY_FEATURES]


def test_amounts_times_ten_scale_only_amount_features(make_transfers):
    rows = _random_transfers(150, 5)
    scaled = [r[:6] + (r[6] * 10,) + r[7:8] + (round(r[8] * 10, 2),) + r[9:] for r in rows]
    a, b = _feats(make_transfers(rows)), _feats(make_transfers(scaled))
    for k in a:
        for c in HISTORY_FEATURES:
            if "amount" in c:
                assert b[k][c] == pytest.approx(a[k][c] * 10)
            else:
                assert b[k][c] == a[k][c]
