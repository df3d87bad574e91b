import datetime as dt

from conftest import transfer, ts

from ringwatch.operators.split import time_slice
from ringwatch.sources.transfers import load_transactions_csv, load_transfers_parquet, write_transfers_parquet


def test_store_round_trip_and_pruning(spark, make_transfers, tmp_path):
    rows = [transfer(i, ts(i % 24, 1 + i % 5), f"A{i % 7}", f"B{i % 3}", amount=float(i)) for i in range(200)]
    path = str(tmp_path / "store")
    write_transfers_parquet(make_transfers(rows), path, num_files=4)
    back = load_transfers_parquet(spark, path)
    assert back.count() == 200
    sl = time_slice(back, dt.datetime(2022, 9, 2), dt.datetime(2022, 9, 3)).select("txn_id", "amount_paid")
    plan = sl._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "event_date" in plan
    assert "PushedFilters: [IsNotNull(timestamp), GreaterThanOrEqual(timestamp" in plan
    assert "ReadSchema: struct<txn_id:bigint,timestamp:timestamp_ntz,amount_paid:double>" in plan
    assert sorted(r.txn_id for r in sl.collect()) == [i for i in range(200) if 1 + i % 5 == 2]


def test_csv_to_store(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("Timestamp,From Bank,Account,To Bank,Account,Amount Received,Receiving Currency,Amount Paid,"
                 "Payment Currency,Payment Format,Is Laundering\n"
                 "2022/09/01 00:20,010,8000EBD30,010,8000EBD30,3697.34,US Dollar,3697.34,US Dollar,Reinvestment,0\n"
                 "2022/09/02 00:20,03208,8000F4580,001,8000F5340,0.01,US Dollar,0.01,US Dollar,Cheque,1\n")
    write_transfers_parquet(load_transactions_csv(spark, str(p)), str(tmp_path / "store"))
    back = load_transfers_parquet(spark, str(tmp_path / "store"))
    assert sorted(r.from_bank for r in back.collect()) == ["010", "03208"]
