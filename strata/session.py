"""Shared scratch space and session settings."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the operators are written for. All are ordinary session settings,
# so a cluster can override any of them.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply :data:`SETTINGS` to a session."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where that is unset, one beside the tables of the warehouse.

    Both are reached by every executor. A warehouse in the driver's own file system is not, so on a cluster
    ``spark.checkpoint.dir`` must be set then. The caller's session is not changed.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
        path = spark._jvm.org.apache.hadoop.fs.Path(base)
        own = path.getFileSystem(spark._jsc.hadoopConfiguration()).getScheme() == "file"
        if own and not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{base} is on the driver's machine alone: set spark.checkpoint.dir to a folder that all executors share")
    return base.rstrip("/")


def work_dir(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever Spark keeps it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, none if it isn't there."""
    if not path_exists(spark, path):
        return []
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target)
    return sorted(f.getPath().getName() for f in found if f.isDirectory())


def staged(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder once and read it back.

    Cuts the lineage with a real table, so a lost executor costs a re-read and not a recompute,
    and several consumers of a batch share one evaluation.
    """
    spark = df.sparkSession
    path = work_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def kept(df: DataFrame) -> DataFrame:
    """Evaluate ``df`` once into a checkpoint, for tables that a lazy result still needs.

    With ``spark.cleaner.referenceTracking.cleanCheckpoints`` Spark deletes the files when nothing
    refers to the table any more.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


class Workspace:
    """Staged tables that are deleted when the block ends; nothing lazy may outlive it."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.path = spark, work_dir(spark, label)
        self.count = 0

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_: object) -> None:
        remove(self.spark, self.path)

    def stage(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.path}/{self.count}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
