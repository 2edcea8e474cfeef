"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words, as a regex class body.
SPACE = r"\x20\x09-\x0D"


def shared_dir(spark: SparkSession) -> str:
    """Folder of this application below spark.checkpoint.dir, which driver and executors share; what cut() and shelved() write
    there can go when the application ends. Where the setting is missing a local session gets a folder of its own; a cluster fails."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return f"{found.rstrip('/')}/{spark.sparkContext.applicationId}"


#: Folders that cut() and shelved() wrote in this process, in order.
WRITTEN: list[str] = []


def _new_folder(spark: SparkSession, name: str) -> str:
    WRITTEN.append(f"{shared_dir(spark)}/{name}")
    return WRITTEN[-1]


def remove(spark: SparkSession, folders: list[str]) -> None:
    """Delete folders of WRITTEN that no DataFrame needs any more, in whatever store they lie."""
    jvm = spark.sparkContext._jvm
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame) -> DataFrame:
    """Write df into the shared folder and read it back: cuts the lineage and outlives a lost executor."""
    spark = df.sparkSession
    path = _new_folder(spark, uuid.uuid4().hex)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shelved(df: DataFrame, column: str, shelves: int) -> DataFrame:
    """Write df into the shared folder in so many buckets by a column and read it back: joins on it need no shuffle."""
    spark = df.sparkSession
    name = f"shelf_{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").option("path", _new_folder(spark, name)).bucketBy(shelves, column).saveAsTable(name)
    found = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name only; the rows stay in the shared folder
    return found


#: Column of keyed(), of a name that no input has.
ROW = f"_row_{uuid.UUID(int=20).hex}"


def keyed(docs: DataFrame) -> DataFrame:
    """docs with a column ROW, unique among rows whatever their ids, written once so that it stays the same."""
    return cut(docs.withColumn(ROW, F.monotonically_increasing_id()))


def first_rows(rows: DataFrame, placed: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of keyed rows: of each part of placed(row, id, part) the row of the smallest id, null ids last."""
    first = F.min(F.struct(F.col("id").isNull().alias("late"), "id", "row")).alias("h")
    kept = placed.groupBy("part").agg(first).select(F.col("h.row").alias(ROW))
    return rows.join(kept, ROW, "left_semi").select(*columns)


def small_batches(spark: SparkSession) -> None:
    """Whole texts make wide rows: Arrow batches of at most 128 rows and some 2 MB keep a Python worker's memory flat. All stages take
    the same limits, so it does not matter which of them was planned last."""
    # Workers on this machine find the package where the driver does.
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "128")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "2m")


def words(text: Column) -> Column:
    """Words of a text: runs of anything but the six ASCII white-space characters; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), "")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
