"""Whole datasets in the form of others: one JSON document of images, annotations and categories, and stores of clips with their pictures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.operators.aggregate import copied_as_kept, counted
from framelake.sources.files import expand_clip

IMAGE = "id bigint, width int, height int, file_name string"
ANNOTATION = "id bigint, image_id bigint, category_id int, bbox array<double>, area double, iscrowd int"
CATEGORY = "id int, name string"
#: lists of a document in order, with the schema of an item
LISTS = {"images": IMAGE, "annotations": ANNOTATION, "categories": CATEGORY}


def _names(schema: str) -> list[str]:
    return [c.split(" ")[0] for c in schema.split(", ")]


def write_document(tables: Sequence[DataFrame], path: str) -> None:
    """images, annotations and categories (ids dense from 1) as one JSON document in pieces: the files of ``path`` in order of name, one after the other.

    An item stands on a line of its own, with a comma before it unless it is the first of its list, so a task writes its range of
    ids without knowing those of others, and no task holds the document. A list without items is empty.
    """
    spark = tables[0].sparkSession
    frame, lines = [], None
    for k, ((name, schema), rows) in enumerate(zip(LISTS.items(), tables, strict=True)):
        frame.append((2 * k, 0, f'{"{" if not k else "], "}"{name}": ['))
        item = F.concat(F.when(F.col("id") > 1, ",").otherwise(""), F.to_json(F.struct(*_names(schema)), {"ignoreNullFields": "false"}))
        part = rows.select(F.lit(2 * k + 1).alias("section"), F.col("id").cast("bigint").alias("id"), item.alias("value"))
        lines = part if lines is None else lines.unionByName(part)
    frame.append((2 * len(LISTS), 0, "]}"))
    every = lines.unionByName(spark.createDataFrame(frame, "section int, id bigint, value string"))
    every.repartitionByRange("section", "id").sortWithinPartitions("section", "id").select("value").write.text(path)


def read_document(spark: SparkSession, path: str, pieces: bool = True) -> tuple[DataFrame, ...]:
    """images, annotations and categories of a document that ``write_document`` wrote; with ``pieces`` false, of one file of any layout, which one task reads."""
    if not pieces:
        schema = ", ".join(f"{n} array<struct<{s}>>" for n, s in LISTS.items())
        doc = spark.read.schema(schema).option("multiLine", "true").json(path)
        return tuple(doc.select(F.inline(n)) for n in LISTS)
    item = spark.read.text(path).where(r"value rlike '^,?\\{\"id\"'").select(F.regexp_replace("value", "^,", "").alias("value"))
    # an item is told by its first field after the id, which no text within it can look like
    kind = F.regexp_extract("value", r'^\{"id":\d+,"(\w+)"', 1)
    own = {"images": kind == "width", "annotations": kind == "image_id", "categories": kind == "name"}
    return tuple(item.where(own[n]).select(F.from_json("value", s).alias("_i")).select("_i.*") for n, s in LISTS.items())


def write_clips(listing: DataFrame, boxes: DataFrame, start: int, length: int | None, path: str) -> tuple[dict[str, int], list[str]]:
    """A store of clips: ``frames`` (sequence, frame_index, path, content) of each clip's window, those without boxes too, and ``labels`` (sequence, frame_index, boxes) where there are some.

    ``listing`` has sequence, frame_index, path and content, the bytes as they are in their file; null where it couldn't be read: that
    frame is kept but not copied. Gives the counters kept and copied, taken as the frames are written, and a warning where they differ. Labels are
    written for frames of the window alone. Bytes are written once and never shuffled.
    """
    on = ["sequence", "frame_index"]
    inside = listing.where(F.col("frame_index") >= start)
    inside = inside if length is None else inside.where(F.col("frame_index") < start + length)
    rows, seen = counted(inside.select(*on, "path", "content"), kept=F.lit(True), copied=F.col("content").isNotNull())
    rows.where("content is not null").write.parquet(f"{path}/frames")
    expand_clip(listing.select(*on).distinct(), boxes, on, start, length).where("boxes is not null").write.parquet(f"{path}/labels")
    counts = {n: int(seen.get[n]) for n in ("kept", "copied")}
    return counts, copied_as_kept(counts)


def read_clips(spark: SparkSession, path: str) -> DataFrame:
    """Frames of a store with their boxes, null where a frame has none."""
    return spark.read.parquet(f"{path}/frames").join(spark.read.parquet(f"{path}/labels"), ["sequence", "frame_index"], "left")


def listed_pictures(spark: SparkSession, folder: str, pattern: str = "*.jpg") -> DataFrame:
    """(sequence, frame_index, path, content) of ``<sequence>/<frame_index>.<end>`` under ``folder``, bytes as they are; other names are passed over."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    name = lambda k, kind: F.regexp_extract("path", r"([^/]+)/([^/]+)\.[^./]*$", k).try_cast(kind)
    return rows.select(name(1, "string").alias("sequence"), name(2, "bigint").alias("frame_index"), "path", "content").where("frame_index is not null")
