from conftest import transfer, ts

from ringwatch.functions.basic import build_basic_features


def test_row_features(make_transfers):
    rows = [transfer(1, ts(13), "A", "A", amount=0.0, received=5.0),
            transfer(2, ts(2), "A", "B", amount=100.0, received=90.0, rc="Euro", from_bank="7", to_bank="7")]
    out = {r["txn_id"]: r for r in build_basic_features(make_transfers(rows)).collect()}
    assert out[1]["weekday"] == 4  # 2022-09-01 is a Thursday
    assert out[1]["hour"] == 13
    assert out[1]["log_amount"] == 0.0
    assert out[1]["amount_ratio"] == 1.0  # guarded division
    assert out[1]["is_self_transfer"] == 1 and out[1]["is_cross_currency"] == 0
    assert abs(out[2]["amount_ratio"] - 0.9) < 1e-12
    assert out[2]["is_cross_currency"] == 1 and out[2]["is_same_bank"] == 1 and out[2]["is_self_transfer"] == 0


def test_original_columns_kept(make_transfers):
    df = make_transfers([transfer(1, ts(0), "A", "B")])
    out = build_basic_features(df)
    assert out.columns[: len(df.columns)] == df.columns
