"""A tracking store as tables: runs with their params, metrics and tags, versions of models and the aliases that name one of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.operators.order import latest

#: tables of a store; each is appended to, so a later row replaces an earlier one of the same name
TABLES = {
    "runs": "run_id bigint, name string, status string",
    "params": "run_id bigint, key string, value string",
    "metrics": "run_id bigint, key string, step bigint, value double",
    "tags": "run_id bigint, key string, set_at bigint, value string",
    "versions": "model string, version bigint, run_id bigint",
    "version_tags": "model string, version bigint, key string, set_at bigint, value string",
    "aliases": "model string, alias string, set_at bigint, version bigint",
}


def append(spark: SparkSession, path: str, **tables: DataFrame) -> None:
    """Rows of some tables added to the store at ``path``."""
    for name, rows in tables.items():
        rows.select(*[c.split(" ")[0] for c in TABLES[name].split(", ")]).write.mode("append").parquet(f"{path}/{name}")


def read(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A table of the store; one that was never written is empty."""
    fs = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
    if not fs.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs):
        return spark.createDataFrame([], TABLES[name])
    return spark.read.schema(TABLES[name]).parquet(f"{path}/{name}")


def as_maps(rows: DataFrame, keys: list[str], name: str, order: str | None = None) -> DataFrame:
    """``keys`` and a map ``name`` of key to value; of several values of a key the last by ``order`` counts, without one the greatest.

    Each task sends one value of a key on. A map holds the keys of one run or version. Null keys are passed over.
    """
    last = rows.where("key is not null").groupBy(*keys, "key").agg((F.max_by("value", F.struct(order, "value")) if order else F.max("value")).alias("value"))
    return last.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "value")))).alias(name))


def described(spark: SparkSession, path: str) -> DataFrame:
    """Runs with their maps params, metrics (of the last step) and tags; a run without any has empty ones."""
    out = read(spark, path, "runs")
    for name, order in (("params", None), ("metrics", "step"), ("tags", "set_at")):
        rows = as_maps(read(spark, path, name), ["run_id"], name, order)
        kind = rows.schema[name].dataType.simpleString()
        out = out.join(rows, "run_id", "left").withColumn(name, F.coalesce(name, F.create_map().cast(kind)))
    return out


def resolved(spark: SparkSession, path: str, alias: str) -> DataFrame:
    """(model, version, run_id, tags) that ``alias`` names in each model: of several settings the last one; version_tags as ``tags``.

    An alias that names a version that isn't there gives its model with a null run; a model without the alias gives no row.
    """
    named = latest(read(spark, path, "aliases").where(F.col("alias") == alias), ["model"], "set_at", "version").select("model", "version")
    on = ["model", "version"]
    tags = as_maps(read(spark, path, "version_tags"), on, "tags", "set_at")
    return named.join(read(spark, path, "versions"), on, "left").join(tags, on, "left").select(*on, "run_id", F.coalesce("tags", F.create_map().cast("map<string,string>")).alias("tags"))
