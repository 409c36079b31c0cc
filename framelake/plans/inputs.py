"""Queries that write raw input files from the driver tables and read them as the jobs do: numbered annotation lines, pictures."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.operators import boxes as B
from framelake.operators import pixels as P
from framelake.plans.files import LINE_SQL, NORM_SQL, lines
from framelake.plans.registered import KEY, query, r6
from framelake.sources import files as S
from framelake.sources.adapters import view
from framelake.sources.scratch import new_path

ORDER = ["frame_index", "line_no", "target_id", "bbox_left", "bbox_top", "bbox_width", "bbox_height", "score", "category"]
PLACE_SQL = f"row_number() over (partition by sequence order by {', '.join(ORDER)})"


def files_of_lines(spark: SparkSession, sf_dir: str) -> str:
    """A file for each sequence in the order of all columns; every twelfth or so of its lines is blank."""
    rows = lines(spark, sf_dir, ORDER).withColumn("line", F.when(F.col("target_id") % 12 == 5, "").otherwise(F.col("line")))
    path = new_path(spark, "annotations")
    S.write_lines(rows, "sequence", ORDER, path)
    return path


@query(f"select sequence, n as line_no, line from (select sequence, target_id, {PLACE_SQL} as n, {LINE_SQL} as line from ann) where target_id % 12 <> 5")
def A1_numbered_lines(spark, sf_dir):
    """Lines with their number in the file; blank ones count."""
    return S.numbered_lines(spark, files_of_lines(spark, sf_dir))


@query(f"""with numbered as (select *, {PLACE_SQL} as n from ann)
select sequence, frame_index, string_agg(cls || printf(' %.6f %.6f %.6f %.6f', xc, yc, w, h) || chr(10), '' order by n) as text
from {NORM_SQL.replace('from ann', 'from numbered')} where score <> 0 and target_id not in (17, 34) and target_id % 12 <> 5 group by all""")
def A1_labels_in_file_order(spark, sf_dir):
    """Label text of each frame from the files of lines, its boxes in the order of the file."""
    parsed = B.parse_annotations(S.numbered_lines(spark, files_of_lines(spark, sf_dir)))
    return B.labels_text(parsed, KEY, "line_no")


FRAMES = 20  # small frames of which a picture is put together, one below the other


def _drawn(batches):
    """A PNG of each row of grey values: red as they are, green reversed, blue halved; every seventh or so is cut off after 30 bytes."""
    for b in batches:
        out = []
        for block, px in zip(b.column("frame_index").to_pylist(), b.column("px"), strict=True):
            g = px.values.to_numpy(zero_copy_only=False).reshape(-1, 8)
            made = P.png(np.stack([g, 255 - g, g // 2], axis=2))
            out.append(made[:30] if block % 7 == 3 else made)
        yield pa.RecordBatch.from_arrays([b.column("sequence"), b.column("frame_index"), pa.array(out, pa.binary())], ["sequence", "frame_index", "png"])


def picture_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pictures written to files, decoded and read: sequence, frame_index, width, height and the readings."""
    small = view(spark, sf_dir, "fr").withColumn("frame_index", F.floor(F.col("vec_id") / FRAMES))
    rows = F.array_sort(F.collect_list(F.struct("vec_id", "px")))  # of FRAMES small frames
    whole = small.groupBy("frame_index").agg(F.flatten(rows["px"]).alias("px"))
    whole = whole.select(F.format_string("seq%02d", F.col("frame_index") % 6).alias("sequence"), "frame_index", "px")
    path = new_path(spark, "pictures")
    S.write_blobs(whole.mapInArrow(_drawn, "sequence string, frame_index bigint, png binary"), ["sequence", "frame_index"], "png", path)
    named = [F.regexp_extract("path", r"/sequence=([^/]*)/", 1).alias("sequence"), F.regexp_extract("path", r"/frame_index=(\d+)/", 1).cast("bigint").alias("frame_index")]
    return P.readings(S.pictures(spark, path).select(*named, "height", "width", "channels", "data"))


GREY_SQL = f"""grey as (select block, n, list_transform(px, lambda p: (19595 * p + 38470 * (255 - p) + 7471 * (p // 2) + 32768) // 65536) as g
  from (select vec_id // {FRAMES} as block, count(*) * 64 as n, flatten(list(list_transform(px, lambda p: cast(p as bigint)) order by vec_id)) as px from fr group by 1)),
pixel as (select block, n, g[i + 1] as v, case when i < 8 or i >= n - 8 or i % 8 in (0, 7) then g[i + 1] else least(255, greatest(0,
  9 * g[i + 1] - (g[i - 8] + g[i - 7] + g[i - 6] + g[i] + g[i + 1] + g[i + 2] + g[i + 8] + g[i + 9] + g[i + 10]))) end as e from grey, unnest(range(n)) u(i)),
pic as (select 'seq0' || (block % 6) as sequence, block as frame_index, block % 7 <> 3 as fine, n // 8 as height, avg(v) as brightness, sqrt((n * sum(v * v) - sum(v) * sum(v)) / (n * n)) as contrast,
  (n * sum(e * e) - sum(e) * sum(e)) / (n * n) as blur from pixel group by block, n)"""


@query(f"""with {GREY_SQL} select sequence, frame_index, case when fine then 8 end as width, case when fine then height end as height, case when fine then round(brightness, 6) end as brightness,
  case when fine then round(contrast, 6) end as contrast, case when fine then round(blur, 6) end as blur from pic""")
def A4_B14_picture_readings(spark, sf_dir):
    """Readings of coloured pictures from their files; those that are cut off have none."""
    return r6(picture_readings(spark, sf_dir), *P.READ)


@query(f"with {GREY_SQL} select sequence, max(case when fine then 8 end) as width, min_by(height, frame_index) filter (fine) as height from pic group by sequence")
def A4_sequence_sizes(spark, sf_dir):
    """The size of a sequence by its first picture that can be decoded."""
    return P.sequence_sizes(picture_readings(spark, sf_dir))


@query(f"""with {GREY_SQL} select case when sequence < 'seq04' then 'train' else 'live' end as split, count(*) as n_frames, count(*) filter (not fine) as n_corrupt,
  round(avg(brightness) filter (fine), 6) as brightness, round(avg(contrast) filter (fine), 6) as contrast, round(avg(blur) filter (fine), 6) as blur from pic group by 1""")
def D2_picture_statistics(spark, sf_dir):
    """Means of each split over pictures that can be decoded, beside the count of those that can't."""
    split = F.when(F.col("sequence") < "seq04", "train").otherwise("live").alias("split")
    lost = F.count_if(F.col("brightness").isNull()).alias("n_corrupt")
    return r6(picture_readings(spark, sf_dir).groupBy(split).agg(F.count(F.lit(1)).alias("n_frames"), lost, *[F.avg(c).alias(c) for c in P.READ]), *P.READ)
