"""A2: labelled laundering rings from the text format.

The file is a sequence of blocks::

    BEGIN LAUNDERING ATTEMPT - FAN-OUT:  Max 2-degree Fan-Out
    2021/03/14 09:26,000535,ZQ81,007,KX22,314.15,Yen,314.15,Yen,Cheque,1
    ...
    END LAUNDERING ATTEMPT - FAN-OUT

Spark reads it line by line. Lines are put in file order by (file, split start,
position in the split), and one distributed running count over them numbers
markers, rings and data lines; a data line then finds the marker above it in the
small table of markers. So a ring of any size is read by many tasks, and no
value holds a whole ring.

On purpose, data rows that sit
outside any well-formed BEGIN block (before the first BEGIN, between an END
and the next BEGIN, or under a malformed BEGIN line) are not glued onto the
previous ring but returned by :func:`parse_patterns_with_rejects` as rejects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringwatch.operators.prefix import prefix_sum
from ringwatch.sources.transfers import SOURCE_COLUMNS, TIMESTAMP_TEXT_FORMAT

# Block markers and the BEGIN line pattern (type is upper-case
# letters, hyphen and space; the detail after ":" is optional).
BEGIN_MARKER = "BEGIN LAUNDERING ATTEMPT"
END_MARKER = "END LAUNDERING ATTEMPT"
BEGIN_PATTERN = r"^BEGIN LAUNDERING ATTEMPT\s*-\s*([A-Z\- ]+?)\s*(?::\s*(.*))?$"

# The eight ring shapes.
PATTERN_TYPES = ("CYCLE", "GATHER-SCATTER", "BIPARTITE", "FAN-OUT", "SCATTER-GATHER", "STACK", "RANDOM", "FAN-IN")

RING_COLUMNS = SOURCE_COLUMNS + ("pattern_id", "pattern_type", "pattern_detail", "hop")


def parse_patterns_with_rejects(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Return (rings, rejects). ``rings`` has the 11 source columns plus
    ``pattern_id, pattern_type, pattern_detail, hop``; ``rejects`` holds data
    lines found outside a well-formed block, with the number of the marker above them."""
    line, fields = F.trim("value"), F.split("line", ",", -1)
    begin, end = F.col("line").startswith(BEGIN_MARKER), F.col("line").startswith(END_MARKER)
    lines = (spark.read.text(path)
             .select(line.alias("line"), F.col("_metadata.file_path").alias("_file"),
                     F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_at"))
             .filter("line <> ''")
             .withColumns({"_marker": (begin | end).cast("int"), "_ring": F.col("line").rlike(BEGIN_PATTERN).cast("int")})
             .withColumn("_data", ((F.col("_marker") == 0) & (F.size(fields) == len(SOURCE_COLUMNS))).cast("int")))
    lines = prefix_sum(lines, ["_file", "_start", "_at"], ["_marker", "_ring", "_data"], ["_m", "_r", "_d"])
    markers = lines.filter("_marker = 1").select(
        "_m", (F.col("_ring") == 1).alias("_inside"), (F.col("_r") - 1).cast("int").alias("pattern_id"),
        F.trim(F.regexp_extract("line", BEGIN_PATTERN, 1)).alias("pattern_type"),
        F.trim(F.regexp_extract("line", BEGIN_PATTERN, 2)).alias("pattern_detail"), F.col("_d").alias("_d0"))
    # Lines of one long ring share a marker: adaptive execution splits them.
    data = lines.filter("_data = 1").join(markers, "_m", "left")
    rejects = data.filter(~F.coalesce("_inside", F.lit(False))).select(F.col("_m").alias("marker_no"), "line")
    f = F.split("line", ",", -1)
    parsed = data.filter("_inside").select(
        F.to_timestamp_ntz(F.trim(f[0]), F.lit(TIMESTAMP_TEXT_FORMAT)).alias("timestamp"),
        *[F.trim(f[i]).alias(c) for i, c in enumerate(SOURCE_COLUMNS) if c in
          ("from_bank", "from_account", "to_bank", "to_account", "receiving_currency",
           "payment_currency", "payment_format")],
        F.trim(f[5]).cast("double").alias("amount_received"),
        F.trim(f[7]).cast("double").alias("amount_paid"),
        F.trim(f[10]).cast("int").alias("is_laundering"),
        "pattern_id", "pattern_type", "pattern_detail", (F.col("_d") - F.col("_d0") - 1).cast("int").alias("hop"))
    return parsed.select(*RING_COLUMNS), rejects


def parse_patterns(spark: SparkSession, path: str) -> DataFrame:
    return parse_patterns_with_rejects(spark, path)[0]


def rings_from_transfers(t_with_pattern: DataFrame) -> DataFrame:
    """The ring table built from a transfers frame that carries ``pattern_id``
    (FIXTURES.md §3): shape from ``pattern_id % 8``, hop in (timestamp, txn_id) order."""
    types = F.array(*[F.lit(t) for t in PATTERN_TYPES])
    ring = t_with_pattern.filter(F.col("pattern_id") >= 0).withColumn("_one", F.lit(1))
    ring = prefix_sum(ring, ["timestamp", "txn_id"], ["_one"], ["_place"], partition_cols=["pattern_id"])
    return ring.select(*SOURCE_COLUMNS, "pattern_id",
                       F.element_at(types, (F.col("pattern_id") % 8 + 1).cast("int")).alias("pattern_type"),
                       F.lit("").alias("pattern_detail"), (F.col("_place") - 1).cast("int").alias("hop"))


def write_patterns_text(rings: DataFrame, path: str) -> None:
    """Write rings as text files whose name order is ``pattern_id`` order (the parser's inverse).

    One row per line, markers included, range-partitioned on (ring, line): no value holds a
    whole ring, a large ring is split over files, and the number of files follows the
    session's shuffle partitions.
    """
    ts_text = F.date_format("timestamp", TIMESTAMP_TEXT_FORMAT)
    line = F.concat_ws(",", ts_text, "from_bank", "from_account", "to_bank", "to_account",
                       F.col("amount_received").cast("string"), "receiving_currency",
                       F.col("amount_paid").cast("string"), "payment_currency", "payment_format",
                       F.col("is_laundering").cast("string"))
    rows = rings.select("pattern_id", F.lit(1).alias("part"), "hop", line.alias("value"))
    ring = rings.groupBy("pattern_id").agg(F.min("pattern_type").alias("t"), F.min("pattern_detail").alias("d"))
    detail = F.when(F.col("d") != "", F.concat(F.lit(": "), F.col("d"))).otherwise(F.lit(""))
    head = ring.select("pattern_id", F.lit(0).alias("part"), F.lit(0).alias("hop"),
                       F.concat(F.lit(f"{BEGIN_MARKER} - "), F.col("t"), detail).alias("value"))
    foot = ring.select("pattern_id", F.lit(2).alias("part"), F.lit(0).alias("hop"),
                       F.concat(F.lit(f"{END_MARKER} - "), F.col("t")).alias("value"))
    n = int(rings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (rows.unionByName(head).unionByName(foot).repartitionByRange(n, "pattern_id", "part", "hop")
     .sortWithinPartitions("pattern_id", "part", "hop").select("value")
     .write.mode("overwrite").text(path))
