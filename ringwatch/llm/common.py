"""Helpers shared by the corpus operators: shared scratch tables, worker code, text bytes."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one Arrow batch handed to Python; whole texts are long, so batches stay short.
BATCH_ROWS = 1000


def session(spark: SparkSession) -> SparkSession:
    """Prepare the session for Python workers: short Arrow batches, the package on every executor."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that functions
    pickled by module name load from any working directory. The archive lies in the
    shared folder, written through Spark's file system."""
    sc = spark.sparkContext
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if sc.applicationId in _SHIPPED or not os.path.isdir(top):  # sent, or running from the archive itself
        return
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(top):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join(os.path.basename(top), os.path.relpath(full, top)))
    target = f"{shared_root(spark)}/llm/{sc.applicationId}-{os.path.basename(top)}.zip"
    path = sc._jvm.org.apache.hadoop.fs.Path(target)
    out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path)
    out.write(packed.getvalue())
    out.close()
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def shared_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Only a local session without that
    setting gets a private folder; a cluster without it is an error."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if root:
        return root
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    root = sc.getCheckpointDir()
    if not root:
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="ringwatch-llm-"))
        root = sc.getCheckpointDir()
    return root


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return f"{shared_root(spark)}/llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


#: Whether Spark deletes the shuffle files of a query when it ends.
_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str, compression: str = "snappy", path: str | None = None, tidy: bool = False) -> DataFrame:
    """``df`` written once as a shared table (at ``path``, to ``discard`` it early) and read back: cuts lineage, survives lost executors.
    ``tidy``: the shuffle files of the writing job go when it ends, not when the driver happens to collect garbage."""
    spark = df.sparkSession
    path = path or scratch(spark, name)
    before = spark.conf.get(_TIDY)
    spark.conf.set(_TIDY, tidy or before == "true")
    try:
        df.write.option("compression", compression).parquet(path)
    finally:
        spark.conf.set(_TIDY, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing reads any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Delete this application's scratch tables; call it once the results are stored."""
    discard(spark, f"{shared_root(spark)}/llm/{spark.sparkContext.applicationId}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with null texts as empty; other columns, whatever their names, stay out."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))


def part_of(total: int, per_group: int) -> int:
    """Number of groups so that each holds about ``per_group`` of ``total``."""
    return max(1, -(-total // per_group))


def arrow(schema: str | pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
