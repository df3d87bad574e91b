import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from conftest import transfer, ts
from ringwatch.operators.split import (assign_split, compute_boundaries, nearest_rank, select_split,
                                       snapshot_index, truncate_tail)
from ringwatch.sources.manifest import build_manifest, frozen_boundaries, read_manifest, store_once, verify_manifest


def _hourly(make_transfers, n=1000):
    return make_transfers([transfer(i, ts(i), "A", "B", label=int(i % 50 == 0)) for i in range(n)])


def test_boundaries_give_60_20_20_disjoint_in_time(make_transfers):
    df = _hourly(make_transfers)
    b = compute_boundaries(df, (0.6, 0.2))
    s = assign_split(df, b)
    counts = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert abs(counts["train"] - 600) <= 5 and abs(counts["validation"] - 200) <= 5
    assert sum(counts.values()) == 1000
    rng = {r["split"]: (r["lo"], r["hi"]) for r in
           s.groupBy("split").agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi")).collect()}
    assert rng["train"][1] < rng["validation"][0] and rng["validation"][1] < rng["test"][0]


def test_range_filter_matches_label(make_transfers):
    df = _hourly(make_transfers)
    b = compute_boundaries(df, (0.6, 0.2))
    for name in ("train", "validation", "test"):
        a = {r.txn_id for r in select_split(df, name, b).collect()}
        c = {r.txn_id for r in assign_split(df, b).filter(F.col("split") == name).collect()}
        assert a == c
    with pytest.raises(ValueError):
        select_split(df, "holdout", b)


def test_boundaries_shuffle_invariant(make_transfers):
    df = _hourly(make_transfers)
    assert compute_boundaries(df) == compute_boundaries(df.orderBy(F.rand(3)).repartition(7))


def test_tail_cut_is_strict(make_transfers):
    cutoff = dt.datetime(2022, 9, 11)
    df = make_transfers([transfer(1, dt.datetime(2022, 9, 10, 23, 59), "A", "B"),
                         transfer(2, cutoff, "A", "B"), transfer(3, dt.datetime(2022, 9, 18), "A", "B")])
    assert [r.txn_id for r in truncate_tail(df, cutoff).collect()] == [1]


def test_nearest_rank():
    assert nearest_rank(1000, 0.6) == 600  # round(599.4) + 1
    assert nearest_rank(5, 0.5) == 3
    assert nearest_rank(1, 0.99) == 1


def test_snapshot_index_counts_24h_periods_from_first_row(make_transfers):
    df = make_transfers([transfer(1, ts(6), "A", "B"), transfer(2, ts(29), "A", "B"), transfer(3, ts(31), "A", "B")])
    got = {r.txn_id: r.snapshot for r in snapshot_index(df).collect()}
    assert got == {1: 0, 2: 0, 3: 1}


def test_manifest_round_trip_and_checksum(spark, make_transfers, tmp_path):
    df = _hourly(make_transfers)
    m = build_manifest(df, "hourly", dt.datetime(2022, 10, 10), (0.6, 0.2))
    folder = f"{tmp_path}/frozen"
    with pytest.raises(FileNotFoundError):
        verify_manifest(spark, folder)
    store_once(m, folder)
    store_once(m.withColumn("manifest", F.lit("another")), folder)  # the first stays
    verify_manifest(spark, folder)
    doc = json.loads(read_manifest(spark, folder)["manifest"])
    assert set(doc["splits"]) == {"train", "validation", "test"} and doc["dataset"] == "hourly"
    assert set(doc) == {"dataset", "method", "fractions", "tail_cutoff", "tail_rows_dropped", "tail_reason", "boundaries", "splits"}
    assert frozen_boundaries(spark, folder) == compute_boundaries(truncate_tail(df, dt.datetime(2022, 10, 10)))
    row = spark.read.parquet(folder)
    row.withColumn("manifest", F.regexp_replace("manifest", "hourly", "x")).write.parquet(f"{tmp_path}/changed")
    with pytest.raises(ValueError):
        verify_manifest(spark, f"{tmp_path}/changed")
    row.withColumn("sha256", F.lit(None).cast("string")).write.parquet(f"{tmp_path}/bare")
    with pytest.raises(FileNotFoundError):
        verify_manifest(spark, f"{tmp_path}/bare")


def test_changed_rows_get_another_key(make_transfers):
    from ringwatch.plans.common import data_key
    df = _hourly(make_transfers, 50)
    key = data_key(df, "timestamp", "is_laundering")
    assert key == data_key(df.repartition(7), "timestamp", "is_laundering")
    assert key != data_key(df.filter("txn_id <> 20"), "timestamp", "is_laundering")
    assert key != data_key(df.withColumn("is_laundering", F.lit(1)), "timestamp", "is_laundering")
