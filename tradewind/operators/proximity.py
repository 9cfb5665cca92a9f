"""Joins by distance: within a radius, and nearest k.

Both work on distinct places: rows that share a position are reduced to that position before anything
is paired, and come back by an equi-join on the position at the end. A place with a very large share
of the rows is therefore paired once, and the blow-up is that of the result alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions.geo import KM_PER_DEGREE, haversine_km
from tradewind.operators.topk import top_per_group
from tradewind.session import stored


def _places(df: DataFrame, lng: str, lat: str, prefix: str) -> DataFrame:
    """Distinct positions as ``<prefix>lng``, ``<prefix>lat``; rows without one are left out."""
    return (
        df.where(F.col(lng).isNotNull() & F.col(lat).isNotNull())
        .select(F.col(lng).cast("double").alias(f"{prefix}lng"), F.col(lat).cast("double").alias(f"{prefix}lat"))
        .distinct()
    )


def _attach(pairs: DataFrame, df: DataFrame, lng: str, lat: str, prefix: str) -> DataFrame:
    """Bring back the rows at a position."""
    rows = df.withColumn("_x", F.col(lng).cast("double")).withColumn("_y", F.col(lat).cast("double"))
    match = (F.col(f"{prefix}lng") == F.col("_x")) & (F.col(f"{prefix}lat") == F.col("_y"))
    return pairs.join(rows, match).drop("_x", "_y")


def within_radius(
    left: DataFrame,
    right: DataFrame,
    km: float,
    left_point: tuple[str, str] = ("lng", "lat"),
    right_point: tuple[str, str] = ("lng", "lat"),
    distance: str = "distance_km",
) -> DataFrame:
    """Pairs of rows at most ``km`` apart on the sphere, with the distance.

    The globe is cut into cells. Bands of latitude are as high as the radius. Within a band, cells are
    as wide as the radius at the latitude of the band's neighbours furthest from the equator, so that
    a radius never reaches past the next cell; near the poles a band is one cell. Right places have
    one home cell, left places look into the nine around them, so every pair meets exactly once.

    Column names of the two sides must differ.
    """
    height = max(km / KM_PER_DEGREE * 1.0001, 1e-6)
    bands = max(1, int(math.floor(180.0 / height)))
    height = 180.0 / bands

    def band_of(lat: Column) -> Column:
        return F.least(F.floor((lat + 90.0) / height), F.lit(bands - 1)).cast("bigint")

    def cells_in(band: Column) -> Column:
        """Cells around the globe in a band."""
        edge = F.greatest(F.abs((band - 1) * height - 90.0), F.abs((band + 2) * height - 90.0))
        # Half the chord over the cosine bounds how far a radius reaches in longitude.
        s = math.sin(min(km / (2 * 6371.0088), math.pi / 2))
        ratio = F.lit(s) / F.cos(F.radians(F.least(edge, F.lit(89.9))))
        reach = F.when((edge >= 89.9) | (ratio >= 1.0), 360.0).otherwise(F.degrees(F.asin(F.least(ratio, F.lit(1.0)))) * 2)
        return F.greatest(F.floor(F.lit(360.0) / (reach * 1.0001 + 1e-9)), F.lit(1)).cast("bigint")

    def cell_of(lng: Column, band: Column) -> Column:
        turn = (lng + 180.0) - F.floor((lng + 180.0) / 360.0) * 360.0
        return F.least(F.floor(turn / (F.lit(360.0) / cells_in(band))), cells_in(band) - 1).cast("bigint")

    a = _places(left, *left_point, "_a")
    b = _places(right, *right_point, "_b")
    homes = b.withColumn("_band", band_of(F.col("_blat"))).withColumn("_cell", cell_of(F.col("_blng"), F.col("_band")))
    looks = (
        a.withColumn("_band", F.explode(F.array(*[band_of(F.col("_alat")) + d for d in (-1, 0, 1)])))
        .where(F.col("_band").between(0, bands - 1))
        .withColumn("_n", cells_in(F.col("_band")))
        .withColumn("_mid", cell_of(F.col("_alng"), F.col("_band")))
        .withColumn(
            "_cell",
            F.explode(F.array_distinct(F.array(*[F.pmod(F.col("_mid") + d, F.col("_n")) for d in (-1, 0, 1)]))),
        )
        .drop("_n", "_mid")
    )
    apart = haversine_km(F.col("_alng"), F.col("_alat"), F.col("_blng"), F.col("_blat"))
    pairs = (
        looks.join(homes, ["_band", "_cell"])
        .select("_alng", "_alat", "_blng", "_blat", apart.alias(distance))
        .where(F.col(distance) <= km)
    )
    out = _attach(_attach(pairs, left, *left_point, "_a"), right, *right_point, "_b")
    return out.drop("_alng", "_alat", "_blng", "_blat")


#: Bits of a position within the square around all right places, and how many of them a step down the tree takes.
_BITS, _STEP = 30, 2
#: Positions up to which a cell is not split.
_LEAF = 32


def _tree(homes: DataFrame, leaf: int) -> tuple[list[DataFrame], DataFrame]:
    """The cells of each step of a tree over positions, and (step, cx, cy, _blng, _blat, ids) of the positions in its leaves.

    A cell is (cx, cy, m positions, n rows, the box x1 to x2, y1 to y2 around them). It is split into 16 while it has more than
    ``leaf`` positions, so the depth follows the data: positions leave as soon as their cell is a leaf.
    """
    lng, lat = F.col("_blng"), F.col("_blat")
    box = [F.min(lng).alias("x1"), F.max(lng).alias("x2"), F.min(lat).alias("y1"), F.max(lat).alias("y2")]
    count, west, east, south, north = homes.agg(F.count(F.lit(1)), *box).first()
    side = max(east - west, north - south) if count else 0.0
    scale = (1 << _BITS) / side if side > 0 else 0.0

    def place(value: Column, least: float | None) -> Column:
        return F.least(((value - F.lit(least or 0.0)) * scale).cast("long"), F.lit((1 << _BITS) - 1))

    def cell(step: int, of: str) -> Column:
        return F.shiftright(of, _BITS - _STEP * step)

    points = homes.withColumn("ix", place(lng, west)).withColumn("iy", place(lat, south))
    levels, leaves, dense = [], None, None
    for step in range(1, _BITS // _STEP + 1):
        rows = points.withColumns({"cx": cell(step, "ix"), "cy": cell(step, "iy")})
        if dense is not None:
            rows = rows.withColumns({"px": F.shiftright("cx", _STEP), "py": F.shiftright("cy", _STEP)}).join(dense, ["px", "py"], "left_semi")
        cells = rows.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("m"), F.sum(F.size("ids")).alias("n"), *box)
        last = step == _BITS // _STEP
        cells = stored(cells.withColumn("inner", (F.col("m") > leaf) & F.lit(not last)), "nearest-cells")
        levels.append(cells)
        ends = cells.where("not inner").select(F.lit(step).alias("step"), "cx", "cy")
        leaves = ends if leaves is None else leaves.unionByName(ends)
        dense = cells.where("inner").select(F.col("cx").alias("px"), F.col("cy").alias("py"))
        # while cells are too few for all positions, some are dense
        if last or (count <= leaf * 16**step and dense.isEmpty()):
            break
    steps = F.array(*(F.struct(F.lit(d + 1).alias("step"), cell(d + 1, "ix").alias("cx"), cell(d + 1, "iy").alias("cy")) for d in range(len(levels))))
    members = points.select("_blng", "_blat", "ids", F.inline(steps)).join(leaves, ["step", "cx", "cy"])
    return levels, members


def _leaves_around(a: DataFrame, levels: list[DataFrame], k: int) -> DataFrame:
    """(_alng, _alat, step, cx, cy): the leaves in which the k nearest of each left place can be.

    Down the tree a place keeps the cells that begin no further than the bound: the least distance within which cells
    lie as a whole that hold k rows.
    """
    at = ["_alng", "_alat"]
    outside = lambda value, low, high: F.greatest(low - value, value - high, F.lit(0.0))
    across = lambda value, low, high: F.greatest(F.abs(value - low), F.abs(value - high))
    length = lambda dx, dy: F.sqrt(dx * dx + dy * dy)
    x, y, box = F.col("_alng"), F.col("_alat"), ("x1", "x2", "y1", "y2")
    sides = [F.col("cell")[c] for c in box]
    near = length(outside(x, *sides[:2]), outside(y, *sides[2:]))
    far = length(across(x, *sides[:2]), across(y, *sides[2:]))
    keep = ("cx", "cy", "n", "inner")
    kept = None
    for step, cells in enumerate(levels, start=1):
        cell = F.struct(*keep, *box)
        if kept is None:
            first = [F.struct(*(F.lit(r[c]).alias(c) for c in (*keep, *box))) for r in cells.select(*keep, *box).collect()]  # at most 16
            kind = cells.select(cell).schema[0].dataType
            opened = a.select(*at, F.explode(F.array(*first).cast(T.ArrayType(kind))).alias("cell"))
            found = opened.select(*at, F.lit(step).alias("step"), near.alias("near"), far.alias("far"), *(F.col("cell")[c].alias(c) for c in keep))
        else:
            below = cells.select(F.shiftright("cx", _STEP).alias("px"), F.shiftright("cy", _STEP).alias("py"), cell.alias("cell"))
            # a cell that is open gives way to the cells in it, any other stays; one join for both
            opened = kept.withColumn("px", F.when(F.col("inner"), F.col("cx"))).withColumn("py", F.when(F.col("inner"), F.col("cy")))
            opened = opened.join(below, ["px", "py"], "left")
            for name, value in (("near", near), ("far", far), ("step", F.lit(step))):
                opened = opened.withColumn(name, F.when(F.col("inner"), value).otherwise(F.col(name)))
            found = opened.select(*at, "step", "near", "far", *(F.when(F.col("inner"), F.col("cell")[c]).otherwise(F.col(c)).alias(c) for c in keep))
        whole = Window.partitionBy(*at)
        within = F.sum("n").over(whole.orderBy("far").rangeBetween(Window.unboundedPreceding, Window.currentRow))
        bound = F.min(F.when(F.col("within") >= k, F.col("far"))).over(whole)
        found = found.withColumn("within", within).withColumn("bound", bound)
        kept = found.where(F.col("bound").isNull() | (F.col("near") <= F.col("bound"))).drop("within", "bound")
    return kept.select(*at, "step", "cx", "cy")


def nearest(
    left: DataFrame,
    right: DataFrame,
    k: int,
    right_id: str,
    left_point: tuple[str, str] = ("lng", "lat"),
    right_point: tuple[str, str] = ("lng", "lat"),
    distance: str = "distance",
    rank: str = "rank",
    leaf: int = _LEAF,
) -> DataFrame:
    """For every left row the ``k`` right rows with the smallest planar distance in degrees.

    Ties go to the lowest ``right_id``. The right places are counted into a tree of cells, as deep as they are dense, which is
    written to the shared folder; every left place descends it and keeps only cells that can still hold one of its k nearest.
    So a place meets about as many rows as a few leaves have, also beside or far from a dense cluster. Fewer than k rows come
    back only if there are no more.

    Column names of the two sides must differ.
    """
    a = _places(left, *left_point, "_a")
    located = right.where(F.col(right_point[0]).isNotNull() & F.col(right_point[1]).isNotNull())
    # Of one position, only the k lowest ids can ever be among the k nearest.
    b = top_per_group(
        located.select(
            F.col(right_point[0]).cast("double").alias("_blng"),
            F.col(right_point[1]).cast("double").alias("_blat"),
            F.col(right_id).alias("_bid"),
        ),
        ["_blng", "_blat"],
        [F.col("_bid")],
        k,
    )
    homes = stored(b.groupBy("_blng", "_blat").agg(F.collect_list("_bid").alias("ids")), "nearest-places")
    levels, members = _tree(homes, leaf)
    looks = _leaves_around(a, levels, k)
    dx, dy = F.col("_alng") - F.col("_blng"), F.col("_alat") - F.col("_blat")
    found = looks.join(members, ["step", "cx", "cy"]).select(
        "_alng", "_alat", F.explode("ids").alias("_bid"), F.sqrt(dx * dx + dy * dy).alias(distance)
    )
    best = top_per_group(found, ["_alng", "_alat"], [F.col(distance), F.col("_bid")], k, rank=rank)
    out = _attach(best, left, *left_point, "_a").drop("_alng", "_alat")
    return out.join(right, F.col("_bid") == F.col(right_id)).drop("_bid")
