"""Driver tables in the shape of annotations, detections, frames, events and runs, in Spark and as the same DuckDB text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPARK = {
    "ann": ("lineitem", """select concat('seq', lpad(cast(l_suppkey % 20 as string), 2, '0')) as sequence, 1 + cast(floor(l_orderkey / 75) as bigint) as frame_index, l_partkey % 50 as target_id,
      l_partkey % 1300 as bbox_left, (l_orderkey * 7) % 740 as bbox_top, 1 + cast(l_quantity as bigint) as bbox_width, l_partkey % 40 as bbox_height,
      case when l_discount = 0 then 0 else 1 end as score, l_partkey % 12 as category, l_linenumber as line_no from {t}"""),
    "ev": ("events", """select concat('cam', cast(user_id % 4 as string)) as sequence, event_id as frame_index, event_id as arrival, unix_millis(cast(ts as timestamp)) as ts_ms,
      cast(floor(value / 10) as bigint) as n_person, event_type as cls, value / 500 as conf from {t}"""),
    "fr": ("embeddings", """select vec_id, label, transform(embedding, x -> cast(least(255, greatest(0, floor((cast(x as double) + 1) * 127.5))) as double)) as px from {t}"""),
    "runs": ("orders", """select o_orderkey as run_id, concat('trial-', cast(o_custkey % 50 as string)) as name, case when o_orderstatus = 'F' then 'FINISHED' else 'RUNNING' end as status,
      o_orderdate as start_time, o_totalprice / 600000 as metric, o_orderpriority as priority, o_custkey as custkey from {t}"""),
}
DUCK = {
    "ann": SPARK["ann"][1].replace("as string", "as varchar(10)").format(t="lineitem"),
    "ev": SPARK["ev"][1].replace("as string", "as varchar(10)").replace("unix_millis(cast(ts as timestamp))", "epoch_us(ts)//1000").format(t="events"),
    "fr": SPARK["fr"][1].replace("transform(embedding, x -> ", "list_transform(embedding, lambda x: ").format(t="embeddings"),
    "runs": SPARK["runs"][1].replace("as string", "as varchar(10)").format(t="orders"),
}
GT = """select sequence, frame_index, category % 3 as cls, bbox_left as x1, bbox_top as y1, bbox_left + bbox_width as x2, bbox_top + bbox_height as y2
  from {ann} where category between 1 and 10 and bbox_height > 0 and line_no <= 3"""
DET = """select sequence, frame_index, category % 3 as cls, bbox_left + target_id % 5 as x1, bbox_top + target_id % 3 as y1, bbox_left + bbox_width + target_id % 4 as x2,
  bbox_top + bbox_height as y2, cast((bbox_left * 7 + bbox_top * 13 + target_id * 31) % 1000 as double) / 1000 as conf
  from {ann} where category between 1 and 10 and bbox_height > 0 and line_no between 2 and 4"""
DUCK["gt"] = GT.format(ann=f"({DUCK['ann']})")
DUCK["det"] = DET.format(ann=f"({DUCK['ann']})")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of ann, ev, fr, runs, gt, det over the tables of ``sf_dir``."""
    if name in ("gt", "det"):
        return spark.sql((GT if name == "gt" else DET).format(ann="{ann}"), ann=view(spark, sf_dir, "ann"))
    base, text = SPARK[name]
    return spark.sql(text, t=table(spark, sf_dir, base))


def with_views(sql: str) -> str:
    """DuckDB SQL with those of the views that it names put in front."""
    named = [v for v in DUCK if f" {v} " in f" {sql.replace(',', ' , ').replace(')', ' ) ').replace(chr(10), ' ')} "]
    head = ", ".join(f"{v} as ({DUCK[v]})" for v in named)
    if not head:
        return sql
    if sql.lstrip().lower().startswith("with recursive "):
        return f"with recursive {head}, {sql.lstrip()[15:]}"
    return f"with {head}, {sql.lstrip()[5:]}" if sql.lstrip().lower().startswith("with ") else f"with {head} {sql}"
