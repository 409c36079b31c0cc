"""Small Spark helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from framelake.sources.scratch import cleanup, cut, new_path, shared_dir  # noqa: F401  the operators take them from here

BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def text_batches(spark: SparkSession) -> None:
    """Arrow batches of 1,000 rows where the session has Spark's default of 10,000, which texts of a whole table may not fit in memory with.

    The registered queries call this at their start; who calls the operators sets the size in the session's builder.
    """
    if spark.conf.get(BATCH) == "10000":
        spark.conf.set(BATCH, "1000")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
