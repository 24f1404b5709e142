"""Radius joins between two tables of places, over a grid of cells."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import EARTH_M, haversine_m
from ..session import stage

#: Rows of one side in a cell beyond which the cell is dealt into blocks.
HOT_CELL = 50_000
CELL = ["cell_row", "cell_col"]
#: Cells are wider than the radius by this factor, so that rounding loses no pair.
MARGIN = 1.001


class Grid:
    """Rows of latitude as high as the radius; each is cut into columns as wide as the radius reaches at its
    latitude farthest from the equator. Two points within the radius lie in neighbouring rows, and, seen in the row of one of them, in
    neighbouring columns; columns go around the earth, and a row at a pole has one column."""

    def __init__(self, radius_m: float) -> None:
        self.angle = min(max(radius_m / EARTH_M * MARGIN, 1e-7), math.pi)
        self.rows = max(1, math.floor(180 / math.degrees(self.angle)))
        self.height = 180 / self.rows

    def row(self, lat: Column) -> Column:
        return F.least(F.floor((lat + 90) / self.height), F.lit(self.rows - 1)).cast("long")

    def columns(self, row: Column) -> Column:
        """Number of columns of a row."""
        south = row * self.height - 90
        far = F.greatest(F.abs(south), F.abs(south + self.height))
        reach = F.asin(F.least(F.lit(1.0), F.lit(math.sin(min(self.angle, math.pi / 2))) / F.cos(F.radians(far))))
        at_pole = far + math.degrees(self.angle) >= 90
        return F.when(at_pole, 1).otherwise(F.greatest(F.lit(1), F.floor(2 * math.pi / (reach * MARGIN)))).cast("long")

    def column(self, lng: Column, columns: Column) -> Column:
        turn = F.pmod(lng + 180, F.lit(360.0)) / 360
        return F.least(F.floor(turn * columns), columns - 1).cast("long")

    def home(self, df: DataFrame, lat: Column, lng: Column) -> DataFrame:
        """Each row once, in its cell."""
        return df.withColumn("cell_row", self.row(lat)).withColumn("cell_col", self.column(lng, self.columns(F.col("cell_row"))))

    def around(self, df: DataFrame, lat: Column, lng: Column) -> DataFrame:
        """Each row in its cell and all neighbours of it."""
        here = self.row(lat)
        rows = F.sequence(F.greatest(here - 1, F.lit(0)), F.least(here + 1, F.lit(self.rows - 1)))
        near = df.withColumn("cell_row", F.explode(rows))
        n = self.columns(F.col("cell_row"))
        c = self.column(lng, n)
        return near.withColumn("cell_col", F.explode(F.array_distinct(F.array(F.pmod(c - 1, n), c, F.pmod(c + 1, n)))))


def _located(df: DataFrame, name: str, lat: str, lng: str) -> DataFrame:
    """Rows with a position on earth, as one struct beside it."""
    y, x = F.col(lat).cast("double"), F.col(lng).cast("double")
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name)
    known = df.select(row, y.alias(f"{name}_lat"), x.alias(f"{name}_lng"))
    return known.where(F.col(f"{name}_lat").between(-90, 90) & (F.abs(F.col(f"{name}_lng")) < F.lit(float("inf"))))


def _dealt(df: DataFrame, own: DataFrame, other: DataFrame, own_key: str, other_key: str) -> DataFrame:
    """Rows of hot cells in blocks: each row in one block of its side, against every block of the other side."""
    sized = df.join(own, CELL, "left").join(other, CELL, "left").fillna(1, ["own_blocks", "other_blocks"])
    sized = sized.withColumn(own_key, F.pmod(F.xxhash64("nr"), F.col("own_blocks")))
    return sized.withColumn(other_key, F.explode(F.sequence(F.lit(0).cast("long"), F.col("other_blocks") - 1))).drop("own_blocks", "other_blocks", "nr")


def radius_join(
    points: DataFrame, places: DataFrame, radius_m: float, lat: str = "lat", lng: str = "lng", hot: int = HOT_CELL
) -> DataFrame:
    """(point, place, distance_m) of all pairs no farther apart than `radius_m`; point and place are structs of
    the rows of the two tables.

    An equi join on cells: places lie in one cell, points in up to nine, and the exact distance decides. A cell
    that holds more than `hot` rows of a side is dealt into blocks of that side, so that no task holds a whole hot
    cell. Rows without a position (null, not finite, latitude beyond 90) match nothing; repeated rows match each for itself; either table may be empty.
    """
    grid = Grid(float(radius_m))
    p = grid.around(_located(points, "point", lat, lng), F.col("point_lat"), F.col("point_lng"))
    q = grid.home(_located(places, "place", lat, lng), F.col("place_lat"), F.col("place_lng"))
    # a number per written row: equal rows of a hot cell spread as others do
    p, q = (stage(df.withColumn("nr", F.monotonically_increasing_id()), name) for df, name in ((p, "points"), (q, "places")))

    def blocks(df: DataFrame, name: str) -> DataFrame:
        n = df.groupBy(*CELL).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot)
        return n.select(*CELL, F.ceil(F.col("n") / hot).cast("long").alias(name))

    left = _dealt(p, blocks(p, "own_blocks"), blocks(q, "other_blocks"), "a", "b")
    right = _dealt(q, blocks(q, "own_blocks"), blocks(p, "other_blocks"), "b", "a")
    met = left.join(right, [*CELL, "a", "b"])
    far = haversine_m("point_lat", "point_lng", "place_lat", "place_lng")
    return met.select("point", "place", far.alias("distance_m")).where(F.col("distance_m") <= F.lit(float(radius_m)))
