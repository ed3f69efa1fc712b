"""Map tiles: counts and sums per cell for every zoom level.

Level ``z`` cuts the world into 2**z by 2**z cells of equal degrees. A cell's
key interleaves the bits of its column and row, so a parent's key is that of
its children without the last two bits, and cells that lie together have
neighbouring keys. All levels come from one shuffle, with sums before it; a level
has at most 4**z rows whatever the size of the table.

Rows without a place fall into no cell; places outside the world are moved to
its border.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.monitoring import count_rows, frauds

DEEPEST = 8


def _index(share: Column, level: int) -> Column:
    cells = 1 << level
    return F.greatest(F.least(F.floor(share * cells), F.lit(cells - 1)), F.lit(0)).cast("long")


def column_of(longitude: Column | float, level: int) -> Column:
    return _index((F.lit(longitude) + 180) / 360, level)


def row_of(latitude: Column | float, level: int) -> Column:
    """Rows are counted from the north."""
    return _index((90 - F.lit(latitude)) / 180, level)


def interleaved(x: Column, y: Column, level: int) -> Column:
    """The bits of x and y in turn, those of y first."""
    key = F.lit(0).cast("long")
    for bit in range(level):
        for part, place in ((x, 2 * bit), (y, 2 * bit + 1)):
            key = key.bitwiseOR(F.shiftleft(F.shiftright(part, bit).bitwiseAND(1), place))
    return key


def tile_pyramid(df: DataFrame, deepest: int = DEEPEST) -> DataFrame:
    """(zoom, cell, x, y, transactions, total_amount, max_score) of every cell with rows, levels 0 to ``deepest``."""
    placed = df.filter(F.col("location_lat").isNotNull() & F.col("location_lon").isNotNull()).select(
        column_of(F.col("location_lon"), deepest).alias("x"), row_of(F.col("location_lat"), deepest).alias("y"), "amount", "fraud_score"
    )
    levels = placed.withColumn("cell", interleaved(F.col("x"), F.col("y"), deepest))
    levels = levels.withColumn("zoom", F.explode(F.sequence(F.lit(0), F.lit(deepest))))
    above = f"{deepest} - zoom"
    return levels.groupBy(
        "zoom",
        F.expr(f"shiftright(cell, 2 * ({above}))").alias("cell"),
        F.expr(f"shiftright(x, {above})").alias("x"),
        F.expr(f"shiftright(y, {above})").alias("y"),
    ).agg(count_rows().alias("transactions"), F.sum("amount").alias("total_amount"), F.max("fraud_score").alias("max_score"))


def fraud_tiles(df: DataFrame, deepest: int = DEEPEST, fraud_col: str | None = None) -> DataFrame:
    """The pyramid of the frauds."""
    return tile_pyramid(frauds(df, fraud_col), deepest)


def tiles_in_view(tiles: DataFrame, zoom: int, south: float, west: float, north: float, east: float) -> DataFrame:
    """The cells of a level that touch a box, for a map that shows this box only."""
    wanted = F.col("x").between(column_of(west, zoom), column_of(east, zoom)) & F.col("y").between(row_of(north, zoom), row_of(south, zoom))
    return tiles.filter((F.col("zoom") == zoom) & wanted)
