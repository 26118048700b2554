"""Spatial joins as equi joins on grid cells with an exact test behind them.

Each box is listed in the cells that it covers, so two shapes that could meet share a cell.
A pair is kept only in the first cell that both boxes cover, so none comes twice and no
distinct is needed. Cells should be about as wide as the usual box.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cells(df: DataFrame, box: Column, cell: float, x: str, y: str) -> DataFrame:
    span = lambda low, high: F.sequence(F.floor(low / cell).cast("long"), F.floor(high / cell).cast("long"))
    rows = df.withColumn(x, F.explode(span(box["west"], box["east"])))
    return rows.withColumn(y, F.explode(span(box["south"], box["north"])))


def box_of_point(x: Column, y: Column, by: float = 0.0) -> Column:
    """The box around a point, widened on all sides."""
    return F.struct((x - by).alias("west"), (y - by).alias("south"), (x + by).alias("east"), (y + by).alias("north"))


def box_join(left: DataFrame, right: DataFrame, left_box: str, right_box: str, cell: float, test: Column | None = None) -> DataFrame:
    """Pairs of rows whose boxes meet and that pass a test; columns of both must differ in name.

    A shuffle by cell on either side; crowded cells are split by adaptive execution as any skewed join key.
    """
    a, b = F.col(left_box), F.col(right_box)
    meet = (a["west"] <= b["east"]) & (b["west"] <= a["east"]) & (a["south"] <= b["north"]) & (b["south"] <= a["north"])
    first = (F.col("_x") == F.floor(F.greatest(a["west"], b["west"]) / cell)) & (F.col("_y") == F.floor(F.greatest(a["south"], b["south"]) / cell))
    both = _cells(left, a, cell, "_x", "_y").join(_cells(right, b, cell, "_x", "_y"), ["_x", "_y"]).where(meet & first)
    if test is not None:
        both = both.where(test)
    return both.drop("_x", "_y")
