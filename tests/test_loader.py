from ringwatch.operators.summary import summarise
from ringwatch.sources.transfers import load_transactions_csv

CSV = """Timestamp,From Bank,Account,To Bank,Account,Amount Received,Receiving Currency,Amount Paid,Payment Currency,Payment Format,Is Laundering
2022/09/01 00:20,010,8000EBD30,010,8000EBD30,3697.34,US Dollar,3697.34,US Dollar,Reinvestment,0
2022/09/01 00:20,03208,8000F4580,001,8000F5340,0.01,US Dollar,0.01,US Dollar,Cheque,1
"""


def test_csv_positional_columns_and_strings(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text(CSV)
    df = load_transactions_csv(spark, str(p))
    rows = df.orderBy("txn_id").collect()
    assert len(rows) == 2
    assert rows[0]["from_account"] == "8000EBD30" and rows[0]["to_account"] == "8000EBD30"
    assert rows[1]["from_bank"] == "03208"  # leading zero kept
    assert rows[1]["to_bank"] == "001"
    assert str(rows[0]["timestamp"]) == "2022-09-01 00:20:00"
    assert dict(df.dtypes)["timestamp"] == "timestamp_ntz"
    assert len(set(r["txn_id"] for r in rows)) == 2


def test_summary_counts_accounts_on_both_sides(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text(CSV)
    s = summarise(load_transactions_csv(spark, str(p))).first()
    assert s["n_transactions"] == 2
    assert s["n_accounts"] == 3
    assert s["n_laundering"] == 1
    assert s["laundering_rate"] == 0.5


def test_summary_of_empty_frame_has_zero_rate(spark, make_transfers):
    s = summarise(make_transfers([])).first()
    assert s["n_transactions"] == 0 and s["laundering_rate"] == 0.0 and s["one_in"] is None
