"""Angular-distance joins as equi-joins on sky cells.

The sky is cut into declination zones of height ``h`` and each zone into right-ascension cells of
about the same width. One side of a join sits in its own cell, the other is copied into every cell its
search disc touches (2.25 on average for ``h`` = 4 radii), so a pair meets in exactly one cell and
results need no deduplication. There is no cross join and no special case at RA 0 or the poles.
Cells holding more rows than ``HOT_CELL_ROWS`` are split into parts, and the copied side is repeated
once per part.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from skyfold.functions.coords import chord, chord_to_angle, unit_vector
from skyfold.functions.staging import fixed
from skyfold.operators.curve import neighbour_bounds
from skyfold.session import discard, materialize

HOT_CELL_ROWS = 20_000
CELLS_PER_RADIUS = 4.0
ARCSEC = 1.0 / 3600.0


def _zone_cells(zone: Column, height: float, shrink: bool) -> Column:
    """Number of cells in a zone. ``shrink`` keeps the true width of a cell at most ``height``."""
    low = zone.cast("double") * height - 90.0
    high = low + height
    if shrink:
        nearest = F.when((low <= 0) & (high >= 0), F.lit(0.0)).otherwise(F.least(F.abs(low), F.abs(high)))
        return F.greatest(F.ceil(F.cos(F.radians(nearest)) * (360.0 / height)), F.lit(1)).cast("long")
    farthest = F.least(F.greatest(F.abs(low), F.abs(high)), F.lit(90.0))
    return F.greatest(F.floor(F.cos(F.radians(farthest)) * (360.0 / height)), F.lit(1)).cast("long")


def _last_zone(height: float) -> int:
    return max(0, math.ceil(180.0 / height) - 1)


def with_cell(df: DataFrame, height: float, ra: str = "ra", dec: str = "dec", name: str = "cell", shrink: bool = False) -> DataFrame:
    """Adds the cell a position lies in."""
    last = F.lit(_last_zone(height)).cast("long")
    zone = F.greatest(F.least(F.floor((F.col(dec) + 90.0) / height).cast("long"), last), F.lit(0).cast("long"))
    staged = fixed(df, {"_zone": zone})
    staged = fixed(staged, {"_cells": _zone_cells(F.col("_zone"), height, shrink)})
    slot = F.pmod(F.floor(F.pmod(F.col(ra), F.lit(360.0)) / 360.0 * F.col("_cells")).cast("long"), F.col("_cells"))
    return fixed(staged, {name: F.shiftleft(F.col("_zone"), 32) + slot}).drop("_zone", "_cells")


def in_covering_cells(df: DataFrame, radius: float, height: float, ra: str = "ra", dec: str = "dec", name: str = "cell") -> DataFrame:
    """One copy of each row per cell that its disc of ``radius`` degrees touches."""
    r = radius * (1.0 + 1e-9) + 1e-12
    last = F.lit(_last_zone(height)).cast("long")
    zero = F.lit(0).cast("long")
    low = F.greatest(F.least(F.floor((F.col(dec) - r + 90.0) / height).cast("long"), last), zero)
    high = F.greatest(F.least(F.floor((F.col(dec) + r + 90.0) / height).cast("long"), last), zero)
    near_pole = F.abs(F.col(dec)) + r >= 90.0
    half = F.when(near_pole, F.lit(180.0)).otherwise(
        F.degrees(F.asin(F.least(math.sin(math.radians(min(r, 90.0))) / F.cos(F.radians(F.col(dec))), F.lit(1.0))))
    )
    staged = fixed(df, {"_z0": low, "_z1": high, "_half": half * (1.0 + 1e-9) + 1e-12, "_lon": F.pmod(F.col(ra), F.lit(360.0))})
    staged = staged.withColumn("_zone", F.explode(F.sequence("_z0", "_z1")))
    staged = fixed(staged, {"_cells": _zone_cells(F.col("_zone"), height, False)})
    staged = fixed(
        staged,
        {
            "_s0": F.floor((F.col("_lon") - F.col("_half")) / 360.0 * F.col("_cells")).cast("long"),
            "_s1": F.floor((F.col("_lon") + F.col("_half")) / 360.0 * F.col("_cells")).cast("long"),
        },
    )
    last_slot = F.least(F.col("_s1"), F.col("_s0") + F.col("_cells") - 1)
    staged = staged.withColumn("_slot", F.explode(F.sequence(F.col("_s0"), last_slot)))
    return fixed(staged, {name: F.shiftleft(F.col("_zone"), 32) + F.pmod(F.col("_slot"), F.col("_cells"))}).drop(
        "_z0", "_z1", "_half", "_lon", "_zone", "_cells", "_s0", "_s1", "_slot"
    )


def as_points(df: DataFrame, id_col: str, ra: str = "RA", dec: str = "DEC", keep: Sequence[str] = ()) -> DataFrame:
    """``id, ra, dec, x, y, z`` plus kept columns. NULL, NaN or impossible positions fail the query."""
    lon, lat = F.col("_ra"), F.col("_dec")
    bad = lon.isNull() | lat.isNull() | F.isnan(lon) | F.isnan(lat) | (F.abs(lat) > 90.0)
    checked = F.when(bad, F.raise_error(F.lit("invalid position")).cast("double")).otherwise(F.pmod(lon.cast("double"), F.lit(360.0)))
    base = df.select(F.col(id_col).alias("id"), F.col(ra).alias("_ra"), F.col(dec).alias("_dec"), *keep)
    base = fixed(base, {"ra": checked, "dec": F.col("_dec").cast("double")}).drop("_ra", "_dec")
    return fixed(base, dict(zip("xyz", unit_vector(F.col("ra"), F.col("dec")))))


def chord2(a: str, b: str) -> Column:
    dx, dy, dz = (F.col(f"{a}.{c}") - F.col(f"{b}.{c}") for c in "xyz")
    return dx * dx + dy * dy + dz * dz


def hot_cells(owners: DataFrame, radius: float, group: Sequence[str] = (), rows_per_part: int = HOT_CELL_ROWS) -> DataFrame | None:
    """Cells with more than ``rows_per_part`` owners and their number of parts; None when there are none."""
    keys = [*group, "cell"]
    cells = with_cell(owners, min(radius * CELLS_PER_RADIUS, 180.0))
    hot = cells.groupBy(*keys).count().where(F.col("count") > rows_per_part)
    hot = materialize(hot.select(*keys, F.ceil(F.col("count") / rows_per_part).cast("int").alias("_parts")), "hot")
    return None if hot.isEmpty() else hot


def meeting_sides(
    owners: DataFrame, copies: DataFrame, radius: float, group: Sequence[str] = (), hot: DataFrame | None = None
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides of a radius join with their key columns.

    ``owners`` rows of a hot cell are spread over its parts by id and ``copies`` repeated in each part.
    Without hot cells both sides get part 0 and the plan stays a plain equi-join.
    """
    height = min(radius * CELLS_PER_RADIUS, 180.0)
    keys = [*group, "cell"]
    own, copied = with_cell(owners, height), in_covering_cells(copies, radius, height)
    if hot is None:
        own, copied = own.withColumn("part", F.lit(0)), copied.withColumn("part", F.lit(0))
    else:
        parts = F.coalesce(F.col("_parts"), F.lit(1))
        own = own.join(hot, keys, "left").withColumn("part", F.pmod(F.xxhash64("id"), parts).cast("int")).drop("_parts")
        copied = copied.join(hot, keys, "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    return own, copied, [*keys, "part"]


def _on(keys: Sequence[str], a: str, b: str) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & (F.col(f"{a}.{k}") == F.col(f"{b}.{k}"))
    return out


def radius_join(
    left: DataFrame, right: DataFrame, radius: float, left_id: str, right_id: str,
    left_pos=("RA", "DEC"), right_pos=("RA", "DEC"), rows_per_part: int = HOT_CELL_ROWS,
) -> DataFrame:
    """All pairs within ``radius`` degrees: ``left_id, right_id, sep`` (degrees)."""
    lhs, rhs = as_points(left, left_id, *left_pos), as_points(right, right_id, *right_pos)
    a, b, keys = meeting_sides(lhs, rhs, radius, hot=hot_cells(lhs, radius, (), rows_per_part))
    near = a.alias("a").join(b.alias("b"), _on(keys, "a", "b") & (chord2("a", "b") <= chord(radius) ** 2))
    return near.select(F.col("a.id").alias("left_id"), F.col("b.id").alias("right_id"), chord_to_angle(chord2("a", "b")).alias("sep"))


def _distinct_positions(points: DataFrame, payload: Sequence[str]) -> DataFrame:
    """One row per exact position: the row with the smallest id."""
    fields = ["id", *payload]
    return (
        points.groupBy("ra", "dec")
        .agg(F.min(F.struct(*fields)).alias("_first"))
        .select("ra", "dec", *[F.col(f"_first.{f}").alias(f) for f in fields])
        .withColumns(dict(zip("xyz", unit_vector(F.col("ra"), F.col("dec")))))
    )


def nearest_join(
    left: DataFrame, right: DataFrame, radius: float, left_id: str, right_id: str,
    left_pos=("RA", "DEC"), right_pos=("RA", "DEC"), left_cols: Sequence[str] = (), right_cols: Sequence[str] = (),
    strict: bool = False, rows_per_part: int = HOT_CELL_ROWS,
) -> DataFrame:
    """Nearest right row of each left row within ``radius`` degrees (ties: smallest right id).

    Columns: ``left_id, right_id, sep`` in degrees, then ``left_cols`` and ``right_cols`` under their names.
    ``strict`` leaves out pairs at exactly ``radius``. Copies of one right position are collapsed first.
    """
    payload = [f"r_{c}" for c in right_cols]
    carried = [f"l_{c}" for c in left_cols]
    lhs = as_points(left.withColumns({f"l_{c}": F.col(c) for c in left_cols}) if left_cols else left, left_id, *left_pos, keep=carried)
    rhs = as_points(right.withColumns({f"r_{c}": F.col(c) for c in right_cols}) if right_cols else right, right_id, *right_pos, keep=payload)
    a, b, keys = meeting_sides(lhs, _distinct_positions(rhs, payload), radius, hot=hot_cells(lhs, radius, (), rows_per_part))
    limit = chord(radius) ** 2
    d2 = chord2("a", "b")
    close = (d2 < limit) if strict else (d2 <= limit)
    near = a.alias("a").join(b.alias("b"), _on(keys, "a", "b") & close)
    fields = [d2.alias("d2"), F.col("b.id").alias("rid"), *[F.col(f"b.{p}").alias(p) for p in payload]]
    grouped = near.groupBy(*[F.col(f"a.{k}").alias(k) for k in keys], F.col("a.id").alias("left_id")).agg(
        F.min(F.struct(*fields)).alias("best"), *[F.first(f"a.{c}").alias(c) for c in carried]
    )
    return grouped.select(
        "left_id", F.col("best.rid").alias("right_id"), chord_to_angle(F.col("best.d2")).alias("sep"),
        *[F.col(c).alias(c[2:]) for c in carried], *[F.col(f"best.{p}").alias(p[2:]) for p in payload],
    )


#: Degrees of the finest search; closer pairs are searched at this radius.
FINEST = 2.0**-24
#: A search of at most so many rows is broadcast, so that the field is not shuffled again for it.
FEW_ROWS = 20_000


def nearest_other(df: DataFrame, id_col: str, pos=("RA", "DEC"), group: Sequence[str] = ()) -> DataFrame:
    """Nearest other row of each row, without a radius limit, inside each group.

    Columns: group keys, ``id, other_id, sep`` (ties: smallest id). Each row is searched once, at the power of two above
    a bound of its own distance (:mod:`skyfold.operators.curve`), so a clump is searched finely and an empty field
    widely, and a search meets a few rows either way. Copies of one position are each other's nearest and never enter
    the search. A group of one row yields nothing.
    """
    group = list(group)
    points = as_points(df, id_col, *pos, keep=group)
    copies = points.groupBy(*group, "ra", "dec").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"))
    copies = materialize(copies.withColumns(dict(zip("xyz", unit_vector(F.col("ra"), F.col("dec"))))), "positions")
    crowded = copies.where(F.col("n") > 1)
    members = points.join(crowded.select(*group, "ra", "dec", "first_id"), [*group, "ra", "dec"])
    second = members.where(F.col("id") != F.col("first_id")).groupBy(*group, "ra", "dec").agg(F.min("id").alias("second_id"))
    same_place = members.join(second, [*group, "ra", "dec"]).select(
        *group, "id", F.when(F.col("id") == F.col("first_id"), F.col("second_id")).otherwise(F.col("first_id")).alias("other_id"), F.lit(0.0).alias("sep")
    )
    reach = chord_to_angle(F.least(F.col("bound"), F.lit(4.0))) * (1.0 + 1e-9)
    level = F.greatest(F.ceil(F.log2(reach / FINEST)), F.lit(0)).cast("int")
    bounded = neighbour_bounds(copies.select(*group, F.col("first_id").alias("id"), "ra", "dec", "x", "y", "z", "n"), group)
    field = materialize(bounded.withColumn("level", F.coalesce(level, F.lit(0))).drop("bound"), "field")
    searches = [same_place]
    for row in field.where("n = 1").groupBy("level").count().orderBy("level").collect():
        radius = min(FINEST * 2.0 ** row["level"], 180.0)
        waiting = field.where((F.col("n") == 1) & (F.col("level") == row["level"]))
        a, b, keys = meeting_sides(field, waiting, radius, group)
        if row["count"] <= FEW_ROWS:
            b = F.broadcast(b)
        d2 = chord2("a", "b")
        close = F.lit(True) if radius >= 180.0 else (d2 <= chord(radius) ** 2)
        near = a.alias("a").join(b.alias("b"), _on(keys, "a", "b") & (F.col("a.id") != F.col("b.id")) & close)
        found = near.groupBy(*[F.col(f"b.{k}").alias(k) for k in group], F.col("b.id").alias("id")).agg(F.min(F.struct(d2.alias("d2"), F.col("a.id").alias("oid"))).alias("best"))
        searches.append(found.select(*group, "id", F.col("best.oid").alias("other_id"), chord_to_angle(F.col("best.d2")).alias("sep")))
    out = materialize(reduce(DataFrame.unionByName, searches), "nearest")
    discard(copies)
    discard(field)
    return out
