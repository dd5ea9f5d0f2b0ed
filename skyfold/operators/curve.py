"""Bounds of nearest-neighbour distances from space-filling curves.

Points are sorted along a Z-order curve, and each measures the distance to the rows before and after it. A curve cuts some
close pairs apart, but of three curves that are shifted by a third against each other one keeps a point and its
surroundings together, so the least of the six distances is within a small factor of the distance to the nearest
point, in a clump as in an empty field. It is the distance to a real point, so a search to it always finds one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

SHIFTS = 3
BITS = 30
#: Masks of the usual spreading of 30 bits to every second place.
SPREAD = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555))


def _spread(value: Column) -> Column:
    for shift, mask in SPREAD:
        value = value.bitwiseOR(F.shiftleft(value, shift)).bitwiseAND(F.lit(mask))
    return value


def z_order(shift: int, ra: str = "ra", dec: str = "dec", x: str = "x", y: str = "y") -> Column:
    """Place along the curve: a band around the equator in (RA, DEC), each cap in the plane of its pole."""
    cap = F.when(F.col(dec) > 45.0, 1).when(F.col(dec) < -45.0, 2).otherwise(0).cast("long")
    u = F.when(cap == 0, F.col(ra) / 360.0).otherwise((F.col(x) + 1.0) / 2.0)
    v = F.when(cap == 0, (F.col(dec) + 45.0) / 360.0).otherwise((F.col(y) + 1.0) / 2.0)
    number = lambda w: F.floor((w + F.lit(shift / SHIFTS)) / 2.0 * F.lit(float(1 << BITS))).cast("long")
    return F.shiftleft(cap, 2 * BITS) + _spread(number(u)) + F.shiftleft(_spread(number(v)), 1)


def _with_bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lowers ``bound`` (a squared chord) to the distance of the row before and after, in sorted batches of a partition."""

    def joined(first: pa.RecordBatch | None, second: pa.RecordBatch) -> pa.Table:
        return pa.Table.from_batches([first.slice(first.num_rows - 1), second] if first is not None else [second])

    def apart(table: pa.Table) -> np.ndarray:
        """Squared chord of each row and the next one, infinite across groups."""
        xyz = np.stack([table.column(c).to_numpy() for c in "xyz"])
        group = table.column("group").combine_chunks()
        same = pc.equal(group.slice(1), group.slice(0, len(group) - 1)).to_numpy(zero_copy_only=False)
        return np.where(same, ((xyz[:, 1:] - xyz[:, :-1]) ** 2).sum(axis=0), np.inf)

    def lowered(batch: pa.RecordBatch, before: float, after: float, within: np.ndarray) -> pa.RecordBatch:
        gaps = np.concatenate(([before], within, [after]))
        bound = np.minimum(batch.column("bound").to_numpy(), np.minimum(gaps[:-1], gaps[1:]))
        return batch.set_column(batch.schema.get_field_index("bound"), "bound", pa.array(bound))

    last, before, within = None, np.inf, np.zeros(0)
    for batch in batches:
        if not batch.num_rows:
            continue
        gaps = apart(joined(last, batch))
        if last is not None:
            yield lowered(last, before, gaps[0], within)
            before, gaps = gaps[0], gaps[1:]
        last, within = batch, gaps
    if last is not None:
        yield lowered(last, before, np.inf, within)


def neighbour_bounds(points: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """``points`` (distinct ``ra, dec`` with ``x, y, z``) with ``bound``: a squared chord to some other point of the group.

    Infinite for a point that meets no other of its group, as in a group of one. The partitions end the runs, so the
    first and last row of one may have a looser bound.
    """
    columns = points.columns
    now = points.withColumn("group", F.to_json(F.struct(*group)) if group else F.lit("")).withColumn("bound", F.lit(float("inf")))
    for shift in range(SHIFTS):
        ranged = now.withColumn("code", z_order(shift)).repartitionByRange("group", "code").sortWithinPartitions("group", "code").drop("code")
        now = ranged.mapInArrow(_with_bounds, ranged.schema)
    return now.select(*columns, "bound")
