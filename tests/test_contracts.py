import pytest
from conftest import transfer, ts
from pyspark.sql import functions as F

from ringwatch.functions.basic import build_basic_features
from ringwatch.operators.contracts import (RAW_TRANSACTIONS, ContractError, validate_features, validate_raw_transactions,
                                           violation_counts, write_checked)
from ringwatch.operators.history import build_account_history_features


def _good(make_transfers):
    return make_transfers([transfer(1, ts(0), "A", "B", label=1), transfer(2, ts(1), "B", "C")])


def test_valid_raw_passes(make_transfers):
    df = _good(make_transfers)
    assert validate_raw_transactions(df) is df


@pytest.mark.parametrize("col,value", [("amount_paid", -1.0), ("is_laundering", 2),
                                       ("from_account", None), ("amount_received", float("nan"))])
def test_bad_raw_values_raise(make_transfers, col, value):
    df = _good(make_transfers).withColumn(col, F.lit(value).cast(dict(_good(make_transfers).dtypes)[col]))
    with pytest.raises(ContractError):
        validate_raw_transactions(df)


def test_int_account_id_is_rejected_by_schema(make_transfers):
    df = _good(make_transfers).withColumn("from_account", F.lit(7))
    with pytest.raises(ContractError, match="from_account"):
        validate_raw_transactions(df)


def test_missing_column_rejected_extra_allowed(make_transfers):
    df = _good(make_transfers)
    validate_raw_transactions(df.withColumn("extra", F.lit(1)))
    with pytest.raises(ContractError, match="missing"):
        validate_raw_transactions(df.drop("payment_format"))


def test_quarantine_splits_rows(make_transfers):
    df = _good(make_transfers).withColumn(
        "amount_paid", F.when(F.col("txn_id") == 2, F.lit(-5.0)).otherwise(F.col("amount_paid")))
    good, bad = validate_raw_transactions(df, mode="quarantine")
    assert [r.txn_id for r in good.collect()] == [1]
    assert [r.txn_id for r in bad.collect()] == [2]


def _features(make_transfers):
    return build_account_history_features(build_basic_features(_good(make_transfers)), None)


def test_features_pass(make_transfers):
    validate_features(_features(make_transfers))


@pytest.mark.parametrize("col,value", [("hour", 25), ("sender_n_sent_before", -1), ("in_out_ratio_before", float("nan")),
                                       ("log_amount", float("nan")), ("is_same_bank", 3)])
def test_bad_features_raise(make_transfers, col, value):
    f = _features(make_transfers)
    f = f.withColumn(col, F.lit(value).cast(dict(f.dtypes)[col]))
    with pytest.raises(ContractError):
        validate_features(f)


def test_write_checked_counts_and_parts_in_one_pass(spark, make_transfers, tmp_path):
    rows = [transfer(i, ts(i % 9), "A", f"B{i}", amount=-1.0 if i % 10 == 0 else 5.0, label=2 if i % 4 == 0 else 0)
            for i in range(200)]
    df = make_transfers(rows).repartition(3).withColumn("extra", F.col("txn_id") * 2)
    out = write_checked(df, RAW_TRANSACTIONS, str(tmp_path / "t"))
    want = {r["rule"]: r["violations"] for r in violation_counts(df, RAW_TRANSACTIONS).collect()}
    assert out.violations == want and out.violations["amount_paid_negative"] == 20
    bad = {r.txn_id for r in out.quarantined.collect()}
    assert bad == {i for i in range(200) if i % 10 == 0 or i % 4 == 0}
    assert {r.txn_id for r in out.good.collect()} == set(range(200)) - bad
    assert out.good.columns == df.columns


def test_write_checked_without_rows(make_transfers, tmp_path):
    out = write_checked(make_transfers([]), RAW_TRANSACTIONS, str(tmp_path / "t"))
    assert out.good.count() == 0 and out.quarantined.count() == 0 and not any(out.violations.values())


def test_write_checked_without_violations(make_transfers, tmp_path):
    out = write_checked(_good(make_transfers), RAW_TRANSACTIONS, str(tmp_path / "t"))
    assert out.good.count() == 2 and out.quarantined.count() == 0


def test_write_checked_refuses_a_taken_name(make_transfers, tmp_path):
    with pytest.raises(ContractError, match="quarantined"):
        write_checked(_good(make_transfers).withColumn("quarantined", F.lit(1)), RAW_TRANSACTIONS, str(tmp_path / "t"))
