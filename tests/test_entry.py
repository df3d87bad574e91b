import importlib.util
import os

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


def _entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    m = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(m)
    return m


def test_entry_runs(spark):
    df = _entry().entry(spark)
    assert df.count() > 0
    assert "sender_n_sent_before" in df.columns


def test_every_oracle_has_a_query():
    m = _entry()
    assert set(m.oracle_sql()) <= set(m.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", ["q_account_history", "q_account_history_bucketed", "q_evaluate_amount",
                                  "q_degree_summary", "q_node_features_by_day", "q_boundaries"])
def test_oracle_matches_on_smallest_tables(spark, name):
    import sys
    sys.path.insert(0, os.path.join(ROOT, "scripts"))
    from oracle_check import rows_of
    m = _entry()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF}/events.parquet')")
    a = rows_of(m.queries()[name](spark, SF).toPandas())
    b = rows_of(con.execute(m.oracle_sql()[name]).df())
    assert a == b
