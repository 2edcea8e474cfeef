"""Python workers of a local session find this package where the driver does; clusters install it on the executors. Folders that
driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ready(spark: SparkSession) -> None:
    """Path for the workers, and Arrow batches small enough for whole pages, the same for all stages."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[1]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "128")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "2m")


def tasks(spark: SparkSession) -> int:
    """Four tasks a core."""
    return max(32, 4 * spark.sparkContext.defaultParallelism)


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """df dealt by a hash of columns to four tasks a core, a number that adaptive execution leaves as it is."""
    return df.repartition(tasks(df.sparkSession), F.xxhash64(*columns))


def shared(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, or, in a local session without that setting, below one of its own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """df written to a shared folder and read back: what follows reads it as often as it likes, and lost executors lose nothing."""
    path = shared(df.sparkSession, "rows")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shelved(df: DataFrame, column: str) -> DataFrame:
    """written(), in as many buckets by a column as tasks(): what groups or joins by it alone needs no shuffle. A df that lies dealt by that column
    to so many tasks gives one file a bucket."""
    spark, name = df.sparkSession, f"shelf_{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").option("path", shared(spark, "shelf")).bucketBy(tasks(spark), column).saveAsTable(name)
    found = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name only; the rows stay in the shared folder
    return found
