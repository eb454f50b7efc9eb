"""Neighbourhood operators on grids of pixels with x, y.

A plane is dealt out in square tiles. Each cell goes to its tile once, with all its
columns, and as a bare value to the tiles that it lies beside: a window's result then
needs nothing from another tile and no join back. Tiles bound what a task holds, whatever
the plane's size. Keys (such as year) keep planes apart; a plane has one row for a cell.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import stored

#: Cells on a side of a tile.
TILE = 64


def _tiles(df: DataFrame, value: Column, halo: int, keys: tuple[str, ...], own: list[str]) -> DataFrame:
    """keys, tx, ty and cells: (x, y, value, own) of a tile and its halo; own is null in the halo."""
    reach = lambda c: F.sequence(F.floor((F.col(c) - halo) / TILE), F.floor((F.col(c) + halo) / TILE))
    rows = df.select(*keys, "x", "y", value.alias("value"), F.struct(*own).alias("own"))
    rows = rows.withColumn("tx", F.explode(reach("x"))).withColumn("ty", F.explode(reach("y")))
    home = (F.col("tx") == F.floor(F.col("x") / TILE)) & (F.col("ty") == F.floor(F.col("y") / TILE))
    cell = F.struct(F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y"), "value", F.when(home, F.col("own")).alias("own"))
    return rows.groupBy(*keys, "tx", "ty").agg(F.collect_list(cell).alias("cells"))


class _Tile:
    """One tile's cells: rows and columns (i, j) in a grid that has a halo, which cells are its own, and values."""

    def __init__(self, batch: pa.RecordBatch, at: int, halo: int):
        cells = batch.column("cells")[at].values
        tx, ty = batch.column("tx")[at].as_py(), batch.column("ty")[at].as_py()
        self.x, self.y = (cells.field(c).to_numpy() for c in "xy")
        self.j, self.i = self.x - (tx * TILE - halo), self.y - (ty * TILE - halo)
        self.side, self.values, self.all = TILE + 2 * halo, cells.field("value"), cells.field("own")
        self.home = np.flatnonzero(self.all.is_valid().to_numpy(zero_copy_only=False))
        self.own = self.all.take(pa.array(self.home))

    def grid(self, values: np.ndarray, default: float) -> np.ndarray:
        out = np.full((self.side, self.side), default, values.dtype)
        out[self.i, self.j] = values
        return out

    def here(self, grid: np.ndarray) -> np.ndarray:
        """A grid's values at the tile's own cells."""
        return grid[self.i[self.home], self.j[self.home]]


def _by_tile(df: DataFrame, value: Column, halo: int, keys: tuple[str, ...], own: list[str], made: dict[str, str], work: Callable[[_Tile], list[pa.Array]]) -> DataFrame:
    """The own columns of every cell with what work makes of its tile: columns with the names and types of made."""
    rows = _tiles(df, value, halo, keys, own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                tile = _Tile(batch, at, halo)
                yield pa.RecordBatch.from_arrays([tile.own, *work(tile)], names=["own", *made])

    fields = [T.StructField("own", T.StructType([df.schema[c] for c in own])), *(T.StructField(n, T.DataType.fromDDL(t)) for n, t in made.items())]
    return rows.select("tx", "ty", "cells").mapInArrow(run, T.StructType(fields)).select("own.*", *made)


def _windows(grid: np.ndarray, radius: int, join: Callable[[np.ndarray, np.ndarray], np.ndarray], empty: float) -> np.ndarray:
    """join over the square window of every cell: along rows, then along columns."""
    for axis in (0, 1):
        wide = np.pad(grid, [(radius, radius) if k == axis else (0, 0) for k in (0, 1)], constant_values=empty)
        parts = [wide.take(range(d, d + grid.shape[axis]), axis) for d in range(2 * radius + 1)]
        grid = parts[0]
        for part in parts[1:]:
            grid = join(grid, part)
    return grid


def focal_mode(df: DataFrame, radius: int = 2, *keys: str) -> DataFrame:
    """df with focal: the most frequent class of the square window, the lowest of ties; NULL is ignored."""

    def work(tile: _Tile) -> list[pa.Array]:
        known = tile.values.is_valid().to_numpy(zero_copy_only=False)
        codes = tile.values.fill_null(0).to_numpy(zero_copy_only=False)
        classes = np.unique(codes[known])
        if not len(classes):
            return [pa.nulls(len(tile.home), pa.int32())]
        counts = np.stack([_windows(tile.grid((known & (codes == c)).astype(np.int32), 0), radius, np.add, 0) for c in classes])
        best = counts.argmax(axis=0)
        found = tile.here(np.where(counts.max(axis=0) > 0, classes[best], np.iinfo(np.int32).min))
        return [pa.array(found.astype(np.int32), mask=found == np.iinfo(np.int32).min)]

    made = _by_tile(df, F.col("class").cast("int"), radius, keys, df.columns, {"focal": "int"}, work)
    return made.withColumn("focal", F.col("focal").cast(df.schema["class"].dataType))


def focal_extreme(df: DataFrame, name: str, radius: int, how: str, *keys: str) -> DataFrame:
    """keys, x, y of observed cells with the min or max of name in the square window; NULL is ignored."""
    join, empty = (np.minimum, np.inf) if how == "min" else (np.maximum, -np.inf)

    def work(tile: _Tile) -> list[pa.Array]:
        values = tile.values.fill_null(empty).to_numpy(zero_copy_only=False)
        found = tile.here(_windows(tile.grid(values, empty), radius, join, empty))
        return [pa.array(found, mask=np.isinf(found))]

    made = _by_tile(df, F.col(name).cast("double"), radius, keys, [*keys, "x", "y"], {name: "double"}, work)
    return made.withColumn(name, F.col(name).cast(df.schema[name].dataType))


def opening(df: DataFrame, name: str, erode: int, dilate: int, *keys: str) -> DataFrame:
    """Minimum, then maximum: specks narrower than the first window go."""
    return focal_extreme(focal_extreme(df, name, erode, "min", *keys), name, dilate, "max", *keys)


def contrast(df: DataFrame, band: str, *keys: str) -> DataFrame:
    """Grey-level contrast: mean squared difference of a cell's 3 x 3 neighbours' levels from its own.

    band holds whole-number levels; cells without a level or a neighbour are left out.
    """

    def work(tile: _Tile) -> list[pa.Array]:
        grid = tile.grid(tile.values.fill_null(np.nan).to_numpy(zero_copy_only=False), np.nan)
        total, n = np.zeros(grid.shape), np.zeros(grid.shape)
        wide = np.pad(grid, 1, constant_values=np.nan)
        for i in range(3):
            for j in range(3):
                if (i, j) != (1, 1):
                    apart = wide[i : i + tile.side, j : j + tile.side] - grid
                    known = ~np.isnan(apart)
                    total, n = total + np.where(known, apart * apart, 0), n + known
        mean = tile.here(np.where(n > 0, total / np.maximum(n, 1), np.nan))
        return [pa.array(mean, mask=np.isnan(mean))]

    made = _by_tile(df, F.col(band).cast("double"), 1, keys, [*keys, "x", "y"], {"contrast": "double"}, work)
    return made.where("contrast is not null")


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n cells the least one connected to it by the pairs (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while not np.array_equal(new[new], new):
            new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def _tile_components(tile: _Tile) -> list[pa.Array]:
    """label_x, label_y (the least cell of the component inside the tile), n (its cells there) and links: equal neighbours in other tiles."""
    known = tile.values.is_valid().to_numpy(zero_copy_only=False)
    codes = tile.values.fill_null(0).to_numpy(zero_copy_only=False)
    cell = tile.grid(np.arange(len(codes)), -1)
    mine = np.zeros(len(codes), bool)
    mine[tile.home] = True
    inside, across = [], []
    for di, dj in ((0, 1), (1, -1), (1, 0), (1, 1)):
        a, b = cell[: tile.side - di, max(0, -dj) : tile.side - max(0, dj)], cell[di:, max(0, dj) : tile.side + min(0, dj)]
        both = (a >= 0) & (b >= 0)
        a, b = a[both], b[both]
        same = known[a] & known[b] & (codes[a] == codes[b])
        a, b = a[same], b[same]
        together = mine[a] & mine[b]
        inside.append((a[together], b[together]))
        across += [(a[mine[a] & ~mine[b]], b[mine[a] & ~mine[b]]), (b[mine[b] & ~mine[a]], a[mine[b] & ~mine[a]])]
    order = np.lexsort((tile.x, tile.y))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    a, b = (np.concatenate(side) for side in zip(*inside))
    root = order[_roots(len(order), place[a], place[b])[place]]
    sizes = np.bincount(root[tile.home], minlength=len(codes))
    ends, others = (np.concatenate(side) for side in zip(*across))
    by = np.argsort(ends, kind="stable")
    ends, others = ends[by], others[by]
    begin, stop = np.searchsorted(ends, tile.home, "left"), np.searchsorted(ends, tile.home, "right")
    pick = np.concatenate([others[s:e] for s, e in zip(begin, stop)]) if len(begin) else others[:0]
    links = pa.ListArray.from_arrays(
        pa.array(np.r_[0, np.cumsum(stop - begin)], pa.int32()), pa.StructArray.from_arrays([pa.array(tile.x[pick], pa.int64()), pa.array(tile.y[pick], pa.int64())], names=["x", "y"])
    )
    of, none = root[tile.home], ~known[tile.home]
    return [pa.array(tile.x[of], pa.int64(), mask=none), pa.array(tile.y[of], pa.int64(), mask=none), pa.array(sizes[of], pa.int64(), mask=none), links]


def connected_count(df: DataFrame, most: int, *keys: str) -> DataFrame:
    """df with conn: the size of the 8-connected component of equal class, at most `most`.

    Components are first found inside tiles; only cells at tile borders, and the graph of
    tile components that they link, are then joined. In a round a component takes the
    least label among its neighbours' and then its label's label, so a long one settles in
    about the logarithm of its length. After `most` rounds a component smaller than that
    has settled in any case; a label that still meets another one belongs to a component
    of at least `most`. NULL is in no component.
    """
    made = {"label_x": "bigint", "label_y": "bigint", "n": "bigint", "links": "array<struct<x:bigint,y:bigint>>"}
    of = [c for c in df.columns if c != "conn"]
    named = df.select(*(F.col(c).alias(f"own_{c}") if c not in (*keys, "x", "y") else F.col(c) for c in of))
    own = named.columns
    found = stored(_by_tile(named, F.col("own_class").cast("int"), 1, keys, own, made, _tile_components), "tiles")
    label = F.struct("label_y", "label_x").alias("label")
    at_border = lambda c: F.pmod(F.col(c), F.lit(TILE)).isin(0, TILE - 1)
    border = found.where("label_x is not null").where(at_border("x") | at_border("y")).select(*keys, F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y"), F.struct("label_y", "label_x").alias("other"))
    linked = found.where(F.size("links") > 0).select(*keys, label, F.inline("links"))
    edges = stored(linked.join(border, [*keys, "x", "y"]).select(*keys, F.col("label").alias("at"), "other").distinct(), "edges")
    sizes = found.where("label_x is not null").select(*keys, label, "n").join(edges.select(*keys, F.col("at").alias("label")).distinct(), [*keys, "label"], "left_semi").distinct()
    labels = edges.select(*keys, "at").distinct().withColumn("label", F.col("at"))
    for _ in range(most):
        before = labels.select(*keys, "at", "label")
        spread = edges.join(before.withColumnRenamed("at", "other"), [*keys, "other"]).groupBy(*keys, "at").agg(F.min("label").alias("least"))
        hop = before.join(spread, [*keys, "at"], "left").select(*keys, "at", F.col("label").alias("was"), F.least("label", "least").alias("label"))
        jump = before.select(*keys, F.col("at").alias("label"), F.col("label").alias("jump"))
        least = F.least("label", "jump")
        labels = stored(hop.join(jump, [*keys, "label"]).select(*keys, "at", least.alias("label"), (least < F.col("was")).alias("moved")), "labels")
        if not labels.where("moved").limit(1).count():
            break
    labels = labels.select(*keys, "at", "label")
    totals = labels.join(sizes.withColumnRenamed("label", "at"), [*keys, "at"]).groupBy(*keys, "label").agg(F.sum("n").alias("total"))
    other = labels.select(*keys, F.col("at").alias("other"), F.col("label").alias("other_label"))
    open_ = edges.join(labels, [*keys, "at"]).join(other, [*keys, "other"]).where("label <> other_label").select(*keys, "label").distinct()
    totals = totals.join(open_.withColumn("open", F.lit(True)), [*keys, "label"], "left")
    total = F.when(F.col("open"), F.lit(most)).otherwise(F.col("total"))
    merged = labels.join(totals, [*keys, "label"]).select(*keys, F.col("at.label_y").alias("label_y"), F.col("at.label_x").alias("label_x"), total.alias("total"))
    size = F.least(F.coalesce("total", "n"), F.lit(most)).cast("int")
    counted = found.drop("links").join(merged, [*keys, "label_y", "label_x"], "left")
    return counted.select(*(F.col(f"own_{c}").alias(c) if c not in (*keys, "x", "y") else F.col(c) for c in of), F.when(F.col("label_x").isNotNull(), size).alias("conn"))


def spatial_filter(df: DataFrame, least: int = 12, most: int = 200, *keys: str) -> DataFrame:
    """Patches of `least` pixels or fewer take their window's mode."""
    with_conn = connected_count(df, min(most, least + 1), *keys)
    filtered = F.when(F.col("conn") <= least, F.coalesce("focal", "class")).otherwise(F.col("class"))
    return focal_mode(with_conn, 2, *keys).withColumn("class", filtered).drop("focal", "conn")


def within_extent(df: DataFrame, extents: DataFrame, margin: int, key: str) -> DataFrame:
    """Rows of df inside an extent (key, x0, y0, x1, y1) widened by margin, with its key.

    Extents are cut into tiles, so rows meet them by tile instead of one by one.
    """
    size = max(8, 2 * margin)
    tile = lambda c: F.floor(c / size)
    wide = extents.select(F.col(key).alias("extent"), *((F.col(c) + d * margin).alias(c) for c, d in (("x0", -1), ("y0", -1), ("x1", 1), ("y1", 1))))
    tiled = wide.withColumn("tx", F.explode(F.sequence(tile(F.col("x0")), tile(F.col("x1"))))).withColumn("ty", F.explode(F.sequence(tile(F.col("y0")), tile(F.col("y1")))))
    rows = df.withColumns({"tx": tile(F.col("x")), "ty": tile(F.col("y"))}).join(tiled, ["tx", "ty"])
    return rows.where("x between x0 and x1 and y between y0 and y1").drop("tx", "ty", "x0", "y0", "x1", "y1")


def extent_of(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.min("x").alias("x0"), F.min("y").alias("y0"), F.max("x").alias("x1"), F.max("y").alias("y1"))


