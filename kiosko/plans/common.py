"""Reading tables, cutting lineage and joins that hold for hot keys."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast only if a count has shown that it has at most so many rows.
BROADCAST_ROWS = 200_000
#: Keys that a join takes apart as hot, at most.
HOT_KEYS = 1_000
#: No key of fewer rows is hot.
HOT_ROWS = 500_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir`` or has set for checkpoints.  Where there is none, a session within one process
    takes a folder of its own; on a cluster that is an error, for each executor would write to its own disk."""
    context = spark.sparkContext
    there = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if there:
        return there
    master = context.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share; tables in between are written there")
    if not hasattr(context, "_kiosko_folder"):
        context._kiosko_folder = tempfile.mkdtemp(prefix="kiosko-")  # type: ignore[attr-defined]
    return context._kiosko_folder  # type: ignore[attr-defined]


def written(df: DataFrame, *by: str) -> DataFrame:
    """The rows of ``df`` as a table in the shared folder, parted by the columns ``by`` (of few values): computed once,
    and there whichever executor is lost.

    The table is removed when the driver ends.
    """
    folder = scratch(df.sparkSession)
    (df.write.partitionBy(*by) if by else df.write).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def scratch(spark: SparkSession) -> str:
    """A new path in the shared folder, removed with what is there when the driver ends."""
    folder = f"{shared_folder(spark)}/kiosko-{uuid.uuid4().hex}"
    path, fs = files(spark, folder)
    fs.deleteOnExit(path)
    return folder


def files(spark: SparkSession, folder: str):
    """(path, file system) of a folder."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def hinted(small: DataFrame, rows: int | None = None) -> DataFrame:
    """``small`` with a broadcast hint if it has at most ``rows`` rows; else as it is, to be joined by a shuffle.

    ``small`` is counted, so it should be a written table.
    """
    rows = BROADCAST_ROWS if rows is None else rows
    return F.broadcast(small) if small.limit(rows + 1).count() <= rows else small


def joined(big: DataFrame, small: DataFrame, keys: list[str], weight: str, rows: int | None = None, least: int | None = None) -> DataFrame:
    """The inner join of ``big`` with ``small``, which has one row a key; ``weight`` is its column with the number of rows
    of ``big`` that have the key, or more.

    ``small`` is broadcast if it has at most ``rows`` rows.  Else the keys that take more than 1 / ``HOT_KEYS`` of all
    weight (so at most ``HOT_KEYS`` of them) are broadcast, and all others, none of which is hot, meet by a shuffle.
    ``small`` is read up to four times and should be a written table.  Null keys match nothing.
    """
    side = hinted(small, rows)
    if side is not small:
        return big.join(side, keys)
    total = small.agg(F.sum(weight)).first()[0] or 0
    limit = max(HOT_ROWS if least is None else least, total / HOT_KEYS)
    hot = F.broadcast(small.where(F.col(weight) > limit))
    light = big.join(F.broadcast(small.where(F.col(weight) > limit).select(*keys)), keys, "left_anti")
    return big.join(hot, keys).unionByName(light.join(small.where(F.col(weight) <= limit), keys))


def once(col: Column) -> Column:
    """The same values, computed once a row.

    The optimiser copies what a filter or a generator reads into filters of its own further down, so an expensive array
    that is exploded would be made twice.  What isn't deterministic stays where it is.
    """
    return F.when(F.spark_partition_id() >= 0, col)
