"""Boxes that meet, found by a grid: a join on cells in place of all pairs of a page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BOX = ("x0", "y0", "x1", "y1")
#: Side of a cell, in points: a page of letter size has some 40 cells.
CELL = 128.0


def _cell(at: Column, cell: float) -> Column:
    return F.floor(at / cell)


def _in_cells(boxes: DataFrame, cell: float) -> DataFrame:
    """A row for each cell that a box touches; boxes with a null side or ends the wrong way round touch none."""
    whole = boxes.where("x0 <= x1 and y0 <= y1")
    span = lambda a, b: F.explode(F.sequence(_cell(F.col(a), cell), _cell(F.col(b), cell)))
    return whole.withColumn("__cx", span("x0", "x1")).withColumn("__cy", span("y0", "y1"))


def meeting(left: DataFrame, right: DataFrame, keys: list[str], cell: float = CELL) -> DataFrame:
    """Pairs of rows of left and right (keys, x0, y0, x1, y1, ...) whose boxes share a point, edges included; right's columns with __r_ before their names.

    Both sides go to the cells that they touch, and a pair is taken in the cell
    that holds the lower corner of what both share, so it comes once. A box of n
    cells costs n rows; a page with many boxes is many join keys. Rows with a
    null key, a null side or ends the wrong way round meet nothing.
    """
    other = _in_cells(right, cell)
    other = other.withColumnsRenamed({c: f"__r_{c}" for c in other.columns})
    mine = _in_cells(left, cell)
    on = [F.col(c) == F.col(f"__r_{c}") for c in (*keys, "__cx", "__cy")]
    share = (F.col("x0") <= F.col("__r_x1")) & (F.col("__r_x0") <= F.col("x1")) & (F.col("y0") <= F.col("__r_y1")) & (F.col("__r_y0") <= F.col("y1"))
    owner = (F.col("__cx") == _cell(F.greatest("x0", "__r_x0"), cell)) & (F.col("__cy") == _cell(F.greatest("y0", "__r_y0"), cell))
    return mine.join(other, [*on, share, owner]).drop("__cx", "__cy", "__r___cx", "__r___cy", *(f"__r_{k}" for k in keys))


def within(left: DataFrame, right: DataFrame, keys: list[str], cell: float = CELL) -> DataFrame:
    """The pairs of meeting() in which left's centre lies in right's box, its upper and right edges left out: each point is in one of two boxes that touch."""
    x, y = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    centre = left.where("x0 <= x1 and y0 <= y1").withColumn("__box", F.struct(*BOX)).withColumns({"x0": x, "x1": x, "y0": y, "y1": y})
    pairs = meeting(centre, right, keys, cell).where("x0 < __r_x1 and y0 < __r_y1")
    return pairs.withColumns({c: F.col(f"__box.{c}") for c in BOX}).drop("__box")
