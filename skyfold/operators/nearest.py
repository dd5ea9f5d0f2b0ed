"""Nearest rows in the cells of a radius join, one per seeker and scope.

Joining all pairs and taking the smallest sorts every pair, with all that it carries, before it drops one. Here both sides
of a cell lie side by side in a sorted partition, owners first, and only the nearest pair of each seeker leaves it. A
partition holds the owners of one cell, of which a hot cell has many parts, and some rows at once of seekers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from skyfold.functions.coords import chord, unit_vector
from skyfold.operators.spatial import hot_cells, meeting_sides

#: Rows taken from a partition at once, and pairs worked on at once.
ROWS_AT_ONCE = 1 << 16
PAIRS_AT_ONCE = 1 << 20
#: Cells of so many pairs are worked on by themselves, smaller ones together.
PAIRS_OF_A_CELL = 4096


def _firsts(d2: np.ndarray, seeker: np.ndarray, owner: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of pairs sorted by seeker and owner, the first of the nearest of each (seeker, segment)."""
    if not len(d2):
        return seeker, owner, d2
    begins = np.flatnonzero(np.concatenate(([True], (seeker[1:] != seeker[:-1]) | (segment[1:] != segment[:-1]))))
    run = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(d2))))
    least = np.flatnonzero(d2 == np.minimum.reduceat(d2, begins)[run])
    least = least[np.concatenate(([True], run[least][1:] != run[least][:-1]))]
    return seeker[least], owner[least], d2[least]


def _nearest_pairs(xyz: np.ndarray, seeks: np.ndarray, group: np.ndarray, segment: np.ndarray, limit: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of seekers and their nearest owners below ``limit`` in rows sorted by group, owners first, and the squared chords."""
    first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    owners = np.bincount(group, ~seeks, len(first)).astype(np.int64)
    sought = np.bincount(group, seeks, len(first)).astype(np.int64)
    found = []
    big = owners * sought >= PAIRS_OF_A_CELL
    for g in np.flatnonzero(big):
        begin, n = first[g], owners[g]
        mine = xyz[:, begin : begin + n]
        step = max(1, PAIRS_AT_ONCE // n)
        for at in range(begin + n, begin + n + sought[g], step):
            rows = np.arange(at, min(at + step, begin + n + sought[g]))
            d2 = np.square(mine[0] - xyz[0, rows, None])
            d2 += np.square(mine[1] - xyz[1, rows, None])
            d2 += np.square(mine[2] - xyz[2, rows, None])
            if segment[begin] == segment[begin + n - 1]:
                k = d2.argmin(axis=1)
                d2 = d2[np.arange(len(rows)), k]
                found.append((rows[d2 < limit], (begin + k)[d2 < limit], d2[d2 < limit]))
            else:
                i, k = np.nonzero(d2 < limit)
                found.append(_firsts(d2[i, k], rows[i], begin + k, segment[begin + k]))
    rest = np.flatnonzero(seeks & ~big[group] & (owners[group] > 0))
    n = owners[group[rest]]
    ends = np.cumsum(n)
    at = 0
    while at < len(rest):
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS_AT_ONCE, side="right")))
        rows, times = rest[at:upto], n[at:upto]
        seeker = np.repeat(rows, times)
        owner = np.arange(len(seeker)) + np.repeat(first[group[rows]] - (np.cumsum(times) - times), times)
        d2 = np.square(xyz[0, owner] - xyz[0, seeker])
        d2 += np.square(xyz[1, owner] - xyz[1, seeker])
        d2 += np.square(xyz[2, owner] - xyz[2, seeker])
        near = np.flatnonzero(d2 < limit)
        found.append(_firsts(d2[near], seeker[near], owner[near], segment[owner[near]]))
        at = upto
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(column) for column in zip(*found))


def _changes(column: pa.ChunkedArray) -> np.ndarray:
    """Whether each row but the first differs from the one before; nulls are equal."""
    codes = column.combine_chunks().dictionary_encode("encode")
    places = codes.indices.to_numpy(zero_copy_only=False)
    return places[1:] != places[:-1]


def nearest_in_cells(owners: DataFrame, seekers: DataFrame, radius: float, rows_per_part: int | None = None) -> DataFrame:
    """The nearest owner of each seeker in each scope of owners, strictly within ``radius`` degrees, cell by cell.

    ``owners`` has ``id, ra, dec, scope, row`` and ``seekers`` ``id, ra, dec, kept``. Returns ``scope, seeker,
    kept, d2, owner, row`` (``d2`` a squared chord; ties: smallest id, then smallest row). A seeker whose disc touches
    several cells has a row for each that holds an owner, so the caller takes the smallest.
    """
    hot = hot_cells(owners, radius, ()) if rows_per_part is None else hot_cells(owners, radius, (), rows_per_part)
    own, copied, keys = meeting_sides(owners, seekers, radius, hot=hot)
    kinds = {f.name: f.dataType for f in [*owners.schema, *seekers.schema]}
    seeker_kind = seekers.schema["id"].dataType
    nothing = lambda kind: F.lit(None).cast(kind)
    place = [*keys, "ra", "dec"]
    a = own.select(*place, F.lit(False).alias("seeks"), "scope", F.col("id").alias("owner"), "row", nothing(seeker_kind).alias("seeker"), nothing(kinds["kept"]).alias("kept"))
    b = copied.select(
        *place, F.lit(True).alias("seeks"), nothing(kinds["scope"]).alias("scope"), nothing(owners.schema["id"].dataType).alias("owner"), nothing(kinds["row"]).alias("row"),
        F.col("id").alias("seeker"), "kept",
    )
    both = a.unionByName(b).repartition(*keys).sortWithinPartitions(*keys, "seeks", "scope", "owner", "row")
    # The unit vectors are worked out again after the shuffle: two numbers travel in place of three.
    both = both.withColumns(dict(zip("xyz", unit_vector(F.col("ra"), F.col("dec"))))).drop("ra", "dec")
    limit = chord(radius) ** 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(table: pa.Table) -> tuple[list[pa.RecordBatch], pa.Table]:
            places = np.stack([table.column(k).to_numpy() for k in keys])
            new = (places[:, 1:] != places[:, :-1]).any(axis=0)
            group = np.cumsum(np.concatenate(([0], new)))
            segment = np.cumsum(np.concatenate(([0], new | _changes(table.column("scope")))))
            seeks = table.column("seeks").to_numpy()
            xyz = np.stack([table.column(c).to_numpy() for c in "xyz"])
            seeker, owner, d2 = _nearest_pairs(xyz, seeks, group, segment, limit)
            left, right = table.select(["seeker", "kept"]).take(seeker), table.select(["scope", "owner", "row"]).take(owner)
            out = pa.table({"scope": right["scope"], "seeker": left["seeker"], "kept": left["kept"], "d2": d2, "owner": right["owner"], "row": right["row"]})
            begin = int(np.searchsorted(group, group[-1]))
            return out.combine_chunks().to_batches(), table.slice(begin, int((~seeks[begin:]).sum()))

        open_cell, held, rows = [], [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= ROWS_AT_ONCE:
                out, rest = found(pa.Table.from_batches([*open_cell, *held]).combine_chunks())
                yield from out
                open_cell, held, rows = rest.to_batches(), [], 0
        if rows:
            yield from found(pa.Table.from_batches([*open_cell, *held]).combine_chunks())[0]

    schema = StructType([StructField(n, seeker_kind if n == "seeker" else owners.schema["id"].dataType if n == "owner" else kinds[n]) for n in ("scope", "seeker", "kept")])
    schema = schema.add("d2", "double").add("owner", owners.schema["id"].dataType).add("row", kinds["row"])
    return both.mapInArrow(run, schema)
