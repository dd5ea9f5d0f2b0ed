"""Exposure-level selection."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from skyfold.functions.healpix import disc_pixels, npix
from skyfold.functions.photometry import flux_to_mag, flux_to_magerr
from skyfold.operators.ids import dense_ids
from skyfold.operators.quantiles import exact_median
from skyfold.session import discard, materialize

FIELD_RADIUS_DEG = 1.1
#: First part of the sequence that :func:`homogenize` takes at once, and the pixels of the exposures that one of its groups holds, about.
PART_ROWS = 200_000
GROUP_PIXELS = 1_000_000
#: Width of its regions, in field radii.
REGION_RADII = 12.0


def footprint_pixels(exposures: DataFrame, nside: int = 1024, radius_deg: float = FIELD_RADIUS_DEG, ra: str = "telra", dec: str = "teldec") -> DataFrame:
    """Pixels whose centre lies within the field of each exposure."""
    return disc_pixels(exposures, nside, ra, dec, radius_deg)


def max_depth_map(exposures: DataFrame, nside: int = 1024, radius_deg: float = FIELD_RADIUS_DEG) -> DataFrame:
    """Largest T_EFF * EXPTIME over each pixel and band."""
    covered = footprint_pixels(exposures.withColumn("_depth", F.col("t_eff") * F.col("exptime")), nside, radius_deg)
    return covered.groupBy("band", "pix").agg(F.max("_depth").alias("max_depth"))


def _regions(df: DataFrame, size_deg: float, turn: int) -> DataFrame:
    """Adds ``_region``: cells of about ``size_deg``, moved by a third of a cell each turn, so that no place is near an edge in every turn."""
    shift = turn % 3 / 3.0
    zone = F.floor((F.col("_dec") + 90.0) / size_deg + shift).cast("long")
    middle = F.least(F.greatest((zone + 0.5 - shift) * size_deg - 90.0, F.lit(-90.0)), F.lit(90.0))
    cells = F.greatest(F.floor(F.cos(F.radians(middle)) * (360.0 / size_deg)), F.lit(1)).cast("long")
    slot = F.pmod(F.floor(F.pmod(F.col("_ra"), F.lit(360.0)) / 360.0 * cells + shift).cast("long"), cells)
    return df.withColumn("_region", F.shiftleft(zone, 32) + slot)


def _in_sequence(share: float, limits: dict[str, float]):
    """Function for ``applyInPandas`` that decides what it can of one region's exposures, in their order.

    ``_ahead`` is the first exposure of other regions on a pixel. One that has to wait holds up those after it on its pixels;
    one whose pixels are deep enough already need not wait.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["rank", "pix"], kind="stable")
        pixels, place = np.unique(rows["pix"].to_numpy(), return_inverse=True)
        depth, shut = np.zeros(len(pixels)), np.full(len(pixels), np.inf)
        depth[place] = rows["depth"].to_numpy(float)
        shut[place] = rows["_ahead"].fillna(np.inf).to_numpy(float)
        gain, rank, limit = rows["gain"].fillna(0.0).to_numpy(float), rows["rank"].to_numpy(), limits[rows["mode"].iloc[0]]
        starts = np.flatnonzero(np.r_[True, rank[1:] != rank[:-1]])
        found = []
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(rank)], strict=True):
            own = place[a:b]
            levels = np.sort(depth[own])
            low = int(share * (b - a - 1))
            part = share * (b - a - 1) - low
            level = (1.0 - part) * levels[low] + part * levels[low + 1] if part else levels[low]
            full = not level < limit
            if not full and rank[a] > shut[own].min():
                shut[own] = np.minimum(shut[own], rank[a])
                continue
            if not full:
                np.add.at(depth, own, gain[a:b])
            found.append((a, not full))
        out = rows.iloc[[a for a, _ in found]][["mode", "band", "expnum", "rank"]]
        return out.assign(accepted=[taken for _, taken in found])

    return run


def homogenize(
    exposures: DataFrame, percent: float = 90.0, sum_threshold: float = 10 * 0.3 * 90, num_threshold: float = 10, nside: int = 1024,
    radius_deg: float = FIELD_RADIUS_DEG, bands: Sequence[str] = ("g", "r", "i", "z"), part_rows: int = PART_ROWS, group_pixels: int = GROUP_PIXELS,
) -> DataFrame:
    """Greedy selection towards even depth: ``mode, expnum, band, accepted, rank``.

    Exposures come by T_EFF * EXPTIME, best first (ties: smallest number); one is taken while the depth that
    ``percent`` of its pixels exceed is below the threshold. ``mode`` is ``sum`` (seconds) or ``num`` (exposures).

    The sequence is cut into parts, each four times as long as the one before. Depth only grows, so whatever already is
    deep enough when its part begins is rejected at once; of a long list that is nearly all. The others are
    decided in rounds, region by region: a region takes its first exposures in order and decides each that no
    undecided one of another region precedes on a pixel. Regions are wide against a field and move every round, so a
    chain of exposures that wait for each other takes a round per edge it crosses, not one per exposure.
    """
    share = (100.0 - percent) / 100.0
    limits = {"sum": float(sum_threshold), "num": float(num_threshold)}
    depth = F.col("t_eff").cast("double") * F.col("exptime").cast("double")
    ranked = exposures.where(F.col("band").isin(list(bands))).withColumns({"_score": -depth, "depth": depth})
    ranked = dense_ids(ranked, ["_score", "expnum"], "rank").select("band", "expnum", "rank", "depth", "telra", "teldec")
    centres = ranked.groupBy("band", "rank").agg(F.min("telra").alias("_ra"), F.min("teldec").alias("_dec"))
    ranked = materialize(ranked.join(centres, ["band", "rank"]), "ranked")
    last = ranked.agg(F.max("rank")).first()[0]
    place, unit = ["mode", "band", "pix"], ["mode", "band", "rank"]
    limit = F.when(F.col("mode") == "sum", F.lit(limits["sum"])).otherwise(F.lit(limits["num"]))
    # A field has about as many pixels as its area holds; a group is that many exposures, at least one.
    field = max(1.0, 2.0 * math.pi * (1.0 - math.cos(math.radians(min(radius_deg, 180.0)))) / (4.0 * math.pi) * npix(nside))
    most = max(1, int(group_pixels / field))
    run = _in_sequence(share, limits)
    decided, reached = [], None
    begin, end, turn = 0, part_rows, 0
    while last is not None and begin <= last:
        base = footprint_pixels(ranked.where((F.col("rank") >= begin) & (F.col("rank") < end)), nside, radius_deg)
        modes = F.array(*[F.struct(F.lit(m).alias("mode"), g.alias("gain")) for m, g in (("sum", F.col("depth")), ("num", F.lit(1.0)))])
        base = base.withColumn("_m", F.explode(modes)).select("_m.mode", "band", "expnum", "rank", "_m.gain", "_ra", "_dec", "pix")
        if reached is None:
            waiting = materialize(base, "coverage")
        else:
            # The percentile lies between two neighbours in order; it is at the limit if both are, or if it is reached between them.
            position = F.lit(share) * (F.count(F.lit(1)) - 1)
            known = base.join(reached, place, "left").withColumn("depth", F.coalesce("depth", F.lit(0.0)))
            under = F.col("depth") < limit
            state = known.groupBy(*unit).agg(
                F.first("expnum").alias("expnum"), F.floor(position).alias("_low"), (position - F.floor(position)).alias("_part"),
                F.count_if(under).alias("_under"), F.max(F.when(under, F.col("depth"))).alias("_below"), F.min(F.when(~under, F.col("depth"))).alias("_above"),
            )
            between = (F.col("_under") == F.col("_low") + 1) & (F.col("_part") > 0) & ((1.0 - F.col("_part")) * F.col("_below") + F.col("_part") * F.col("_above") >= limit)
            full = (F.col("_under") <= F.col("_low")) | F.coalesce(between, F.lit(False))
            state = materialize(state.select(*unit, "expnum", full.alias("_full")), "state")
            decided.append(state.where("_full").select("mode", "expnum", "band", (~F.col("_full")).alias("accepted"), "rank"))
            waiting = materialize(base.join(state.where("NOT _full").select(*unit), unit, "left_semi"), "coverage")
        while not waiting.isEmpty():
            placed = _regions(waiting, min(REGION_RADII * radius_deg, 180.0), turn)
            heads = placed.groupBy(*place, "_region").agg(F.min("rank").alias("_head"))
            heads = heads.groupBy(*place).agg(F.array_sort(F.collect_list(F.struct("_head", "_region"))).alias("_heads"))
            first = F.dense_rank().over(W.partitionBy("mode", "band", "_region").orderBy("rank"))
            group = placed.withColumn("_nth", first).where(F.col("_nth") <= most).drop("_nth", "_ra", "_dec").join(heads, place)
            ahead = F.get(F.filter("_heads", lambda h: h["_region"] != F.col("_region")), F.lit(0))["_head"]
            group = group.withColumn("_ahead", ahead.cast("double")).drop("_heads")
            group = group.withColumn("depth", F.lit(0.0)) if reached is None else group.join(reached, place, "left").withColumn("depth", F.coalesce("depth", F.lit(0.0)))
            kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in waiting.schema if f.name in ("mode", "band", "expnum", "rank"))
            ready = group.groupBy("mode", "band", "_region").applyInPandas(run, f"{kinds}, accepted boolean")
            ready = materialize(ready.select("mode", "expnum", "band", "accepted", "rank"), "decided")
            decided.append(ready)
            gains = waiting.join(ready.where("accepted").select(*unit), unit, "left_semi").groupBy(*place).agg(F.sum("gain").alias("depth"))
            grown = gains if reached is None else reached.unionByName(gains).groupBy(*place).agg(F.sum("depth").alias("depth"))
            deeper = materialize(grown, "reached")
            following = materialize(waiting.join(ready.select(*unit), unit, "left_anti"), "coverage")
            discard(waiting)
            discard(reached)
            waiting, reached, turn = following, deeper, turn + 1
        begin, end = end, 4 * end + part_rows
    if not decided:
        return ranked.select(F.lit("sum").alias("mode"), "expnum", "band", F.lit(True).alias("accepted"), "rank").where(F.lit(False))
    return reduce(DataFrame.unionByName, decided)


def closest_exposure(exposures: DataFrame, target: float = 2.0, keys: Sequence[str] = ("tag", "band")) -> DataFrame:
    """Exposure whose T_EFF is nearest to the target, per tag and band (ties: smallest number)."""
    best = F.min(F.struct(F.abs(F.col("t_eff") - target).alias("d"), F.col("expnum").alias("expnum")))
    return exposures.groupBy(*keys).agg(best.alias("_b")).select(*keys, F.col("_b.expnum").alias("expnum"))


def exposure_magnitudes(detections: DataFrame, zeropoints: DataFrame) -> DataFrame:
    """Magnitudes with one zeropoint per exposure, the median over its CCDs."""
    zero = exact_median(zeropoints, ["EXPNUM"], "MAG_ZERO", "EXP_ZERO")
    joined = detections.join(zero, "EXPNUM")
    return joined.withColumns(
        {"EXP_MAG_PSF": flux_to_mag(F.col("FLUX_PSF"), F.col("EXP_ZERO")), "EXP_MAGERR_PSF": flux_to_magerr(F.col("FLUX_PSF"), F.col("FLUXERR_PSF"))}
    )


def largest_exposures(detections: DataFrame, k: int = 5) -> DataFrame:
    """The k exposures with most detections."""
    return detections.groupBy("EXPNUM").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "EXPNUM").limit(k)


