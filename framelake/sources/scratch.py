"""Tables between steps, in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_session = uuid.uuid4().hex


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Only a local master may do without: it gets a folder in its warehouse."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoint"
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/framelake-{_session}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends in files that survive lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cleanup(spark: SparkSession) -> bool:
    """Remove all that this driver has put into the shared folder; results that weren't read yet go with it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/framelake-{_session}")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
