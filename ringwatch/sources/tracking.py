"""Run tracking as an append-only Parquet table.

``runs(run_id, experiment, ts, params MAP<STRING,STRING>, metrics
MAP<STRING,DOUBLE>, tags MAP<STRING,STRING>)``, partitioned by experiment.
Appends are atomic per write; no service is involved.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("ts", T.TimestampNTZType(), False),
    T.StructField("params", T.MapType(T.StringType(), T.StringType()), True),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType()), True),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType()), True),
    T.StructField("experiment", T.StringType(), False),
])


def log_runs(spark: SparkSession, path: str, experiment: str, runs: list[tuple[dict, dict, dict | None]]) -> list[str]:
    """Append runs, given as (params, metrics, tags), in one write; returns their ids."""
    now = dt.datetime.now(dt.UTC).replace(microsecond=0, tzinfo=None)
    rows = [(uuid.uuid4().hex, now, {k: str(v) for k, v in params.items()}, {k: float(v) for k, v in metrics.items()},
             {k: str(v) for k, v in (tags or {}).items()}, experiment) for params, metrics, tags in runs]
    spark.createDataFrame(rows, RUN_SCHEMA).coalesce(1).write.mode("append").partitionBy("experiment").parquet(path)
    return [r[0] for r in rows]


def log_run(spark: SparkSession, path: str, experiment: str, params: dict, metrics: dict,
            tags: dict | None = None) -> str:
    """Append one run; returns its id."""
    return log_runs(spark, path, experiment, [(params, metrics, tags)])[0]


def log_metrics_frame(flat: DataFrame, path: str, experiment: str, params: dict, tags: dict | None = None) -> str:
    """Append one run whose metrics come from a ``(name, value)`` DataFrame, aggregated
    into a map on the executors (no collect)."""
    run_id = uuid.uuid4().hex
    p = F.create_map(*[x for k, v in params.items() for x in (F.lit(k), F.lit(str(v)))]) if params else \
        F.create_map().cast("map<string,string>")
    t = F.create_map(*[x for k, v in (tags or {}).items() for x in (F.lit(k), F.lit(str(v)))]) if tags else \
        F.create_map().cast("map<string,string>")
    row = flat.agg(F.map_from_entries(F.collect_list(F.struct("name", F.col("value").cast("double")))).alias("metrics"))
    row = row.select(F.lit(run_id).alias("run_id"), F.localtimestamp().cast("timestamp_ntz").alias("ts"),
                     p.alias("params"), "metrics", t.alias("tags"), F.lit(experiment).alias("experiment"))
    row.write.mode("append").partitionBy("experiment").parquet(path)
    return run_id


def read_runs(spark: SparkSession, path: str, experiment: str | None = None) -> DataFrame:
    df = spark.read.schema(RUN_SCHEMA).parquet(path)
    return df.filter(F.col("experiment") == experiment) if experiment else df
