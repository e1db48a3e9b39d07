"""Session helpers: local session for tests and bench, shared table folder."""

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list = []
_caches: list = []


def on_release(forget):
    """Registers what empties a cache of frames built on intermediate tables."""
    _caches.append(forget)


def local_session(cpus=8, partitions=None, memory="12g"):
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("oddspend")
        .config("spark.sql.shuffle.partitions", str(partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables, taken from spark.checkpoint.dir.

    A temporary folder is used only on a local master that sets none; on a
    cluster a folder of one machine would be lost with that machine.
    """
    conf = spark.sparkContext.getConf()
    path = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    path = os.path.join(tempfile.gettempdir(), f"oddspend-{spark.sparkContext.applicationId}")
    os.makedirs(path, exist_ok=True)
    return path


def materialize(df: DataFrame, name: str = "step", parallel: bool = False) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back.

    Used where several later jobs need the same expensive result: the plan is
    computed once, later jobs read only the columns they need, and a lost
    executor costs a re-read instead of a re-computation. With parallel, a table
    so small that fewer scan tasks than cores would read it is spread over more
    files, because what follows is heavy on CPU.
    """
    spark = df.sparkSession

    def write(rows):
        path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        rows.write.parquet(path)
        _written.append(path)
        return spark.read.schema(df.schema).parquet(path)

    table = write(df)
    cores = spark.sparkContext.defaultParallelism
    if parallel and table.rdd.getNumPartitions() < cores:
        table = write(table.repartition(cores))
    return table


def release(spark: SparkSession) -> int:
    """Deletes every intermediate table this process wrote; frames built on them
    can no longer be used, and caches of them are emptied. Returns how many there were."""
    n = 0
    for forget in _caches:
        forget()
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    while _written:
        path = hadoop(_written.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        n += 1
    return n
