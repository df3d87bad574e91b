"""Transfers table: schema, CSV ingest (A1), Parquet store, and the test view T.

The transfers table is fixed and positional: eleven source columns plus our
own ``txn_id``. Identifiers stay strings (leading zeros matter) and the
timestamp is a zone-less minute-resolution ``TIMESTAMP_NTZ``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The source file's column order (renamed by position, because
# the raw header repeats "Account") and its timestamp text format.
SOURCE_COLUMNS = (
    "timestamp",
    "from_bank",
    "from_account",
    "to_bank",
    "to_account",
    "amount_received",
    "receiving_currency",
    "amount_paid",
    "payment_currency",
    "payment_format",
    "is_laundering",
)
TIMESTAMP_TEXT_FORMAT = "yyyy/MM/dd HH:mm"

TRANSFER_COLUMNS = ("txn_id",) + SOURCE_COLUMNS

TRANSFER_SCHEMA = T.StructType([
    T.StructField("txn_id", T.LongType(), False),
    T.StructField("timestamp", T.TimestampNTZType(), False),
    T.StructField("from_bank", T.StringType(), False),
    T.StructField("from_account", T.StringType(), False),
    T.StructField("to_bank", T.StringType(), False),
    T.StructField("to_account", T.StringType(), False),
    T.StructField("amount_received", T.DoubleType(), False),
    T.StructField("receiving_currency", T.StringType(), False),
    T.StructField("amount_paid", T.DoubleType(), False),
    T.StructField("payment_currency", T.StringType(), False),
    T.StructField("payment_format", T.StringType(), False),
    T.StructField("is_laundering", T.IntegerType(), False),
])

# The CSV is read with every column as text; an explicit schema binds by
# position, so the duplicated header name is harmless.
_CSV_TEXT_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in SOURCE_COLUMNS])

def ntz_lit(value) -> Column:
    """A TIMESTAMP_NTZ literal built from text, so no time zone is involved."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def typed_lit(value, dtype: str) -> Column:
    """Literal of a given Spark SQL type, zone-free for timestamps."""
    if value is None:
        return F.lit(None).cast(dtype)
    if dtype in ("timestamp_ntz", "timestamp") and hasattr(value, "hour"):
        return F.lit(value.isoformat(sep=" ")).cast(dtype)
    return F.lit(value).cast(dtype)


def epoch_seconds(ts: Column | str) -> Column:
    """Whole seconds since 1970-01-01 for a TIMESTAMP_NTZ, built from its fields
    (date, hour, minute, second), so no session time zone or DST rule enters."""
    t = F.col(ts) if isinstance(ts, str) else ts
    days = F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Whole seconds from ``start`` to ``end`` (TIMESTAMP_NTZ, zone-free)."""
    return epoch_seconds(end) - epoch_seconds(start)


def whole_days_between(start: Column | str, end: Column | str) -> Column:
    """Completed 24-hour periods from ``start`` to ``end`` (truncated toward zero)."""
    return (seconds_between(start, end) / F.lit(86400)).cast("bigint")  # the cast truncates toward zero


def truncate_to_minute(ts: Column) -> Column:
    """Minute floor of a TIMESTAMP_NTZ without a round trip through a zoned type."""
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts),
                                F.hour(ts), F.minute(ts), F.lit(0))


def parse_transfer_text(df: DataFrame, strict: bool = True) -> DataFrame:
    """Cast the eleven text columns to their contract types.

    ``strict=True`` uses ANSI casts (a bad value fails the job);
    ``strict=False`` uses ``try_*`` so bad values become NULL and can be
    quarantined by the raw contract.
    """
    if strict:
        ts = F.to_timestamp_ntz(F.trim("timestamp"), F.lit(TIMESTAMP_TEXT_FORMAT))
        num = lambda c: F.trim(F.col(c)).cast("double")
        lab = F.trim(F.col("is_laundering")).cast("int")
    else:
        ts = F.try_to_timestamp(F.trim("timestamp"), F.lit(TIMESTAMP_TEXT_FORMAT)).cast("timestamp_ntz")
        num = lambda c: F.expr(f"try_cast(trim({c}) AS DOUBLE)")
        lab = F.expr("try_cast(trim(is_laundering) AS INT)")
    return df.select(
        *[c for c in df.columns if c not in SOURCE_COLUMNS],
        ts.alias("timestamp"),
        *[F.trim(F.col(c)).alias(c) for c in ("from_bank", "from_account", "to_bank", "to_account")],
        num("amount_received").alias("amount_received"),
        F.trim("receiving_currency").alias("receiving_currency"),
        num("amount_paid").alias("amount_paid"),
        F.trim("payment_currency").alias("payment_currency"),
        F.trim("payment_format").alias("payment_format"),
        lab.alias("is_laundering"),
    )


def load_transactions_csv(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """A1: scan the transfers CSV, rename by position, keep ids as strings.

    ``txn_id`` is ``monotonically_increasing_id()``: unique and stable for a
    fixed set of files and split size. Convert once with
    :func:`write_transfers_parquet` so ids are frozen for later jobs.
    """
    raw = spark.read.csv(path, schema=_CSV_TEXT_SCHEMA, header=True, mode="PERMISSIVE")
    raw = raw.withColumn("txn_id", F.monotonically_increasing_id())
    return parse_transfer_text(raw, strict=strict).select(*TRANSFER_COLUMNS)


#: The header of the source file.
CSV_HEADER = ("Timestamp,From Bank,Account,To Bank,Account,Amount Received,Receiving Currency,Amount Paid,"
              "Payment Currency,Payment Format,Is Laundering")


def write_transfers_csv(df: DataFrame, path: str) -> None:
    """Transfers as CSV text files in the source's layout, each with the header line."""
    import pyarrow as pa

    header = CSV_HEADER
    text = F.concat_ws(",", F.date_format("timestamp", TIMESTAMP_TEXT_FORMAT), *[F.col(c).cast("string") for c in SOURCE_COLUMNS[1:]])

    schema = pa.schema([("value", pa.string())])

    def with_header(batches):
        yield pa.RecordBatch.from_arrays([pa.array([header])], schema=schema)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string())], schema=schema)

    df.select(text.alias("value")).mapInArrow(with_header, "value string").write.text(path)


def write_transfers_parquet(df: DataFrame, path: str, mode: str = "overwrite", num_files: int | None = None) -> None:
    """Store transfers as Parquet partitioned by calendar day.

    Day partitions give partition pruning for the time slices every split and
    snapshot uses. Rows are range-partitioned on (timestamp, txn_id), so a day
    is written by many tasks (never one task per day) and every file covers a
    narrow time range; sorted files make min/max statistics skip row groups.
    """
    n = num_files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.withColumn("event_date", F.to_date("timestamp"))
       .repartitionByRange(n, "timestamp", "txn_id")
       .sortWithinPartitions("timestamp", "txn_id")
       .write.mode(mode).partitionBy("event_date").parquet(path))


def load_transfers_parquet(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*TRANSFER_COLUMNS, *[c for c in df.columns if c == "event_date"])


def _next_minute(value):
    """The first whole minute at or after ``value``: floor(ts) < value means ts < that minute, and likewise for >=."""
    import datetime as dt
    floor = value.replace(second=0, microsecond=0)
    return floor if floor == value else floor + dt.timedelta(minutes=1)


def transfers_from_events(spark: SparkSession, sf_dir: str, with_pattern: bool = False, start=None, end=None) -> DataFrame:
    """The transfers view T over the driver's ``events`` table (see FIXTURES.md §3), rows of
    ``[start, end)`` only. The bounds are literals on the stored ``ts``, so they reach the scan."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    if start is not None:
        ev = ev.filter(F.col("ts") >= ntz_lit(_next_minute(start)))
    if end is not None:
        ev = ev.filter(F.col("ts") < ntz_lit(_next_minute(end)))
    k = F.get_json_object("props", "$.k").cast("bigint")
    ev = ev.select("event_id", "ts", "user_id", "event_type", "value", k.alias("k"))
    u, kk = F.col("user_id"), F.col("k")
    is_pos = (F.col("event_type") == "error") & (F.col("value") > 60)
    cols = [
        F.col("event_id").alias("txn_id"),
        truncate_to_minute(F.col("ts")).alias("timestamp"),
        F.lpad((u % 7).cast("string"), 3, "0").alias("from_bank"),
        F.concat(F.lit("A"), F.lpad(u.cast("string"), 6, "0")).alias("from_account"),
        F.lpad((kk % 7).cast("string"), 3, "0").alias("to_bank"),
        F.concat(F.lit("A"), F.lpad(kk.cast("string"), 6, "0")).alias("to_account"),
        F.when(kk % 10 == 0, F.col("value") * F.lit(0.9)).otherwise(F.col("value")).alias("amount_received"),
        F.when(kk % 10 == 0, F.lit("Yen")).when(u % 2 == 0, F.lit("Euro"))
         .otherwise(F.lit("US Dollar")).alias("receiving_currency"),
        F.col("value").alias("amount_paid"),
        F.when(u % 2 == 0, F.lit("Euro")).otherwise(F.lit("US Dollar")).alias("payment_currency"),
        F.col("event_type").alias("payment_format"),
        F.when(is_pos, 1).otherwise(0).cast("int").alias("is_laundering"),
    ]
    if with_pattern:
        cols.append(F.when(is_pos & (u % 5 < 3), (F.dayofmonth("ts") * 5 + u % 5).cast("int"))
                     .otherwise(F.lit(-1)).alias("pattern_id"))
    return ev.select(*cols)


# DuckDB text of the same view, used by the oracle SQL strings.
DUCKDB_T_SQL = """
SELECT event_id AS txn_id,
  date_trunc('minute', ts) AS timestamp,
  lpad(CAST(user_id % 7 AS VARCHAR), 3, '0') AS from_bank,
  concat('A', lpad(CAST(user_id AS VARCHAR), 6, '0')) AS from_account,
  lpad(CAST(k % 7 AS VARCHAR), 3, '0') AS to_bank,
  concat('A', lpad(CAST(k AS VARCHAR), 6, '0')) AS to_account,
  CASE WHEN k % 10 = 0 THEN value * 0.9::DOUBLE ELSE value END AS amount_received,
  CASE WHEN k % 10 = 0 THEN 'Yen' WHEN user_id % 2 = 0 THEN 'Euro' ELSE 'US Dollar' END AS receiving_currency,
  value AS amount_paid,
  CASE WHEN user_id % 2 = 0 THEN 'Euro' ELSE 'US Dollar' END AS payment_currency,
  event_type AS payment_format,
  CAST(CASE WHEN event_type = 'error' AND value > 60 THEN 1 ELSE 0 END AS INTEGER) AS is_laundering,
  CAST(CASE WHEN event_type = 'error' AND value > 60 AND user_id % 5 < 3
       THEN dayofmonth(ts) * 5 + user_id % 5 ELSE -1 END AS INTEGER) AS pattern_id
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
"""
