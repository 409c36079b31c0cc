"""What the joins and rounds over crowded frames move."""

from framelake.operators import grid
from tests.test_grid import crowd


def test_boxes_look_only_in_grids_that_hold_boxes(spark):
    small = spark.createDataFrame(crowd(300, 3, 1, 300.0, big=0.0))  # sides below 64: three grids of nine
    rows = grid._leveled(small, "")
    held = grid._levels(rows)
    assert set(held) <= {0, 1, 2}
    assert {r[0] for r in grid._cells(rows, "", True, True, held).select("_level").distinct().collect()} <= {0, 1, 2}
    assert grid._cells(rows, "", False, True, []).count() == 0


def test_joins_move_numbers_instead_of_all_columns(spark, monkeypatch):
    seen, real = [], grid.overlapping

    def spied(left, right, keys, a="a_", b="b_"):
        seen.extend([set(left.columns), set(right.columns)])
        return real(left, right, keys, a, b)

    monkeypatch.setattr(grid, "overlapping", spied)
    rows = spark.createDataFrame(crowd(200, 4, 2, 200.0))
    grid.suppress(rows, ["frame"], 0.5).collect()
    grid.match(rows, rows.drop("conf"), ["frame", "cls"]).collect()
    corners = {"x1", "y1", "x2", "y2"}
    assert seen == [{"frame", "_id"} | corners] * 2 + [{"frame", "cls", "turn"} | corners, {"frame", "cls", "_g"} | corners]


def test_numbers_follow_the_order_within_a_frame(spark):
    rows = grid._in_order(spark.createDataFrame(crowd(500, 5, 3, 300.0)), ["frame"], "-conf", "n").orderBy("frame", "n").collect()
    by = [(r.frame, -r.conf, r.cls, r.x1, r.y1, r.x2, r.y2) for r in rows]
    assert by == sorted(by) and len({r.n for r in rows}) == len(rows)


def test_nested_boxes_move_numbers_too(spark, monkeypatch):
    seen, real = [], grid.overlapping
    monkeypatch.setattr(grid, "overlapping", lambda left, right, *more: (seen.append(set(left.columns)), real(left, right, *more))[1])
    grid.drop_nested(spark.createDataFrame(crowd(100, 6, 1, 200.0)), ["frame"], 0.8).collect()
    assert seen == [{"frame", "_id", "x1", "y1", "x2", "y2"}]
