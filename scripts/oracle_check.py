"""Run registered queries in Spark and their DuckDB oracles; compare rows.

usage: python scripts/oracle_check.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
import warnings
warnings.filterwarnings("ignore")

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from ringwatch.plans.catalog import oracle_sql, queries  # noqa: E402
from ringwatch.session import get_spark  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v):
    import pandas as pd
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return v


def rows_of(pdf):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False):
        out.append(tuple(norm(x.item() if hasattr(x, "item") else x) for x in rec))
    return cols, sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    pats = sys.argv[2:]
    tz = os.environ.get("CHECK_TZ")
    if os.environ.get("CHECK_BARE"):
        # The driver's own session: none of the library's defaults.
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8").getOrCreate()
    else:
        spark = get_spark(os.environ.get("CHECK_MASTER", "local[8]"), shuffle_partitions=8, extra={"spark.sql.session.timeZone": tz} if tz else None)
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, os_ = queries(), oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if pats and not any(p in name for p in pats):
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf_dir)
            pdf = sdf.toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in os_:
            print(f"rows {name}: {len(pdf)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            odf = con.execute(os_[name]).df()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        sc, sr = rows_of(pdf)
        oc, orr = rows_of(odf)
        if sc != oc:
            print(f"FAIL {name}: columns spark={sc} oracle={oc}")
            bad += 1
        elif sr != orr:
            diff = [(a, b) for a, b in zip(sr, orr) if a != b][:3]
            print(f"FAIL {name}: rows spark={len(sr)} oracle={len(orr)} first diffs={diff}")
            bad += 1
        else:
            print(f"ok   {name}: {len(sr)} rows {ts:.1f}s")
    print("bad", bad)


if __name__ == "__main__":
    main()
