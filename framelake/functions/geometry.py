"""Box arithmetic as column expressions; all stay inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: fixed values: raw category to merged class (person, vehicle, two/three-wheeler); 0 and 11 have none
MERGE = {1: 0, 2: 0, 4: 1, 5: 1, 6: 1, 9: 1, 3: 2, 7: 2, 8: 2, 10: 2}
#: fixed values: class names of models with other class lists, by merged class
NAMED = {"person": 0, "pedestrian": 0, "people": 0, "car": 1, "bus": 1, "truck": 1, "van": 1, "bicycle": 2, "motorcycle": 2, "tricycle": 2, "awning-tricycle": 2, "motor": 2}
CORNERS = ("x1", "y1", "x2", "y2")


def merged_class(category: Column) -> Column:
    """The merged class of a raw category, null where it has none."""
    return F.create_map(*[F.lit(x) for kv in MERGE.items() for x in kv])[category.cast("int")]


def named_class(name: Column) -> Column:
    """The merged class of a class by its name; -1 where the name has none or is null."""
    return F.coalesce(F.create_map(*[F.lit(x) for kv in NAMED.items() for x in kv])[name], F.lit(-1))


def raw_category(named: Column, cls: Column) -> Column:
    """The category that a prompt names, where there is such a one, else the lowest of the merged class ``cls``."""
    lowest = {c: min(k for k, v in MERGE.items() if v == c) for c in set(MERGE.values())}
    return F.coalesce(F.when(named.between(0, 11), F.nullif(named, F.lit(0))), F.create_map(*[F.lit(x) for kv in lowest.items() for x in kv])[cls.cast("int")])


def pixel_corners(width: int, height: int) -> dict[str, Column]:
    """Corners in pixels of a normalised box xc, yc, w, h."""
    return {
        "x1": (F.col("xc") - F.col("w") / 2) * width, "y1": (F.col("yc") - F.col("h") / 2) * height,
        "x2": (F.col("xc") + F.col("w") / 2) * width, "y2": (F.col("yc") + F.col("h") / 2) * height,
    }


def wire_form(box: Column, width: Column, height: Column) -> Column:
    """Centre and size, as shares of the frame, of a struct of pixel corners: [x, y, w, h] of a detection event's box."""
    x1, y1, x2, y2 = (box[c] for c in CORNERS)
    return F.array((x1 + x2) / 2 / width, (y1 + y2) / 2 / height, (x2 - x1) / width, (y2 - y1) / height)


def clip01(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def side(low: Column, high: Column) -> Column:
    return F.greatest(F.lit(0), high - low)


def intersection(a: str, b: str) -> Column:
    """Overlap area of boxes with columns a_x1 .. and b_x1 ..; 0 unless both sides are positive."""
    w = F.least(F.col(f"{a}x2"), F.col(f"{b}x2")) - F.greatest(F.col(f"{a}x1"), F.col(f"{b}x1"))
    h = F.least(F.col(f"{a}y2"), F.col(f"{b}y2")) - F.greatest(F.col(f"{a}y1"), F.col(f"{b}y1"))
    return F.when((w > 0) & (h > 0), w * h).otherwise(F.lit(0)).cast("double")


def area(p: str) -> Column:
    return ((F.col(f"{p}x2") - F.col(f"{p}x1")) * (F.col(f"{p}y2") - F.col(f"{p}y1"))).cast("double")


def iou(a: str, b: str) -> Column:
    union = area(a) + area(b) - intersection(a, b)
    return F.when(union > 0, intersection(a, b) / union).otherwise(0.0)


def ios(a: str, b: str) -> Column:
    """Overlap over the smaller box."""
    return intersection(a, b) / (F.least(area(a), area(b)) + 1e-9)


def prefixed(df, p: str, columns=CORNERS):
    """``df`` with ``columns`` renamed to p + name."""
    return df.withColumnsRenamed({c: p + c for c in columns})
