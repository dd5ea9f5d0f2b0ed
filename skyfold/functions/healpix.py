"""HEALPix indexing (Gorski et al. 2005) as staged integer columns.

Every function takes a DataFrame and adds columns. Values used several times are computed once by ``fixed``:
the optimizer merges plain projections and would copy a deep expression into each of its uses, while the
output of a one-row ``inline`` is an attribute. Both stay inside whole-stage codegen.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from skyfold.functions.staging import fixed

FULL_SKY_DEG2 = 4.0 * math.pi * (180.0 / math.pi) ** 2


def npix(nside: int) -> int:
    return 12 * nside * nside


def pixel_area_deg2(nside: int) -> float:
    return FULL_SKY_DEG2 / npix(nside)


def max_pixel_radius_deg(nside: int) -> float:
    """Largest centre-to-corner distance of any pixel."""
    phi, za = math.pi / (4.0 * nside), 2.0 / 3.0
    zb = 1.0 - (1.0 - 1.0 / nside) ** 2 / 3.0
    sa, sb = math.sqrt(1.0 - za * za), math.sqrt(1.0 - zb * zb)
    cosine = sa * math.cos(phi) * sb + za * zb
    return math.degrees(math.acos(min(1.0, cosine)))


def _order(nside: int) -> int:
    order = nside.bit_length() - 1
    if nside < 1 or 1 << order != nside:
        raise ValueError(f"nested ordering needs a power of two, got nside={nside}")
    return order


def _long(column: Column) -> Column:
    return F.floor(column).cast("long")


def _spread(name: str, order: int) -> Column:
    """Bit i of ``name`` moved to bit 2i."""
    out = F.lit(0).cast("long")
    for i in range(order):
        out = out + F.shiftleft(F.shiftright(F.col(name), i).bitwiseAND(F.lit(1).cast("long")), 2 * i)
    return out


def _gather(name: str, order: int, odd: int) -> Column:
    """Bit 2i+odd of ``name`` moved to bit i."""
    out = F.lit(0).cast("long")
    for i in range(order):
        out = out + F.shiftleft(F.shiftright(F.col(name), 2 * i + odd).bitwiseAND(F.lit(1).cast("long")), i)
    return out


def with_pixel(
    df: DataFrame, nside: int, lon: str = "RA", lat: str = "DEC", nest: bool = False, name: str = "pix"
) -> DataFrame:
    """Pixel index of each position (``nest`` picks the ordering)."""
    n = nside
    z, za, tt = F.col("_hz"), F.col("_hza"), F.col("_htt")
    staged = df.withColumns(
        {"_hz": F.sin(F.radians(F.col(lat))), "_hs": F.abs(F.cos(F.radians(F.col(lat)))),
         "_htt": F.pmod(F.col(lon), F.lit(360.0)) / 90.0}
    ).withColumn("_hza", F.abs(z))
    belt = za <= 2.0 / 3.0
    # Distance from the pole in ring units, written with the sine so that it keeps its digits there.
    staged = staged.withColumns(
        {"_hbelt": belt, "_htp": tt - F.floor(tt), "_hcap": n * F.col("_hs") / F.sqrt((1.0 + za) / 3.0)}
    )
    staged = fixed(
        staged,
        {
            "_hjp": F.when(F.col("_hbelt"), _long(n * (0.5 + tt) - n * z * 0.75)).otherwise(_long(F.col("_htp") * F.col("_hcap"))),
            "_hjm": F.when(F.col("_hbelt"), _long(n * (0.5 + tt) + n * z * 0.75)).otherwise(_long((1.0 - F.col("_htp")) * F.col("_hcap"))),
        },
    )
    jp, jm = F.col("_hjp"), F.col("_hjm")
    temps = ["_hz", "_hs", "_htt", "_hza", "_hbelt", "_htp", "_hcap", "_hjp", "_hjm"]
    if not nest:
        staged = staged.withColumn("_hir", F.when(F.col("_hbelt"), n + 1 + jp - jm).otherwise(jp + jm + 1))
        ir = F.col("_hir")
        shift = 1 - F.pmod(ir, F.lit(2))
        # (jp + jm - n + shift + 1) is always even
        ring_belt = F.pmod(F.shiftright(jp + jm - n + shift + 1, 1), F.lit(4 * n).cast("long"))
        ring_cap = F.pmod(_long(tt * ir), 4 * ir)
        pix = (
            F.when(F.col("_hbelt"), 2 * n * (n - 1) + (ir - 1) * (4 * n) + ring_belt)
            .when(z > 0, 2 * ir * (ir - 1) + ring_cap)
            .otherwise(npix(n) - 2 * ir * (ir + 1) + ring_cap)
        )
        return staged.withColumn(name, pix.cast("long")).drop(*temps, "_hir")
    order = _order(n)
    last = F.lit(n - 1).cast("long")
    fp, fm = F.shiftright(jp, order), F.shiftright(jm, order)
    face_belt = F.when(fp == fm, fp.bitwiseOR(F.lit(4).cast("long"))).when(fp < fm, fp).otherwise(fm + 8)
    quarter = F.least(F.floor(tt).cast("long"), F.lit(3).cast("long"))
    cjp, cjm = F.least(jp, last), F.least(jm, last)
    staged = fixed(
        staged,
        {
            "_hface": F.when(F.col("_hbelt"), face_belt).when(z >= 0, quarter).otherwise(quarter + 8),
            "_hix": F.when(F.col("_hbelt"), jm.bitwiseAND(last)).when(z >= 0, n - cjm - 1).otherwise(cjp),
            "_hiy": F.when(F.col("_hbelt"), n - jp.bitwiseAND(last) - 1).when(z >= 0, n - cjp - 1).otherwise(cjm),
        },
    )
    pix = F.col("_hface") * (n * n) + _spread("_hix", order) + 2 * _spread("_hiy", order)
    return staged.withColumn(name, pix.cast("long")).drop(*temps, "_hface", "_hix", "_hiy")


def _isqrt(value: Column) -> Column:
    """Exact integer square root for values below 2**52."""
    root = F.floor(F.sqrt(value.cast("double"))).cast("long")
    return root


def _with_ring(df: DataFrame, nside: int, pix: str) -> DataFrame:
    """Adds ``_rz`` (sine latitude), ``_rphi`` (radians) and ``_rs`` (cosine latitude) of a ring pixel centre."""
    n, total, ncap = nside, npix(nside), 2 * nside * (nside - 1)
    p = F.col(pix).cast("long")
    north, south = p < ncap, p >= total - ncap
    ring = (
        F.when(north, F.shiftright(1 + _isqrt(1 + 2 * p), 1))
        .when(south, F.shiftright(1 + _isqrt(2 * (total - p) - 1), 1))
        .otherwise(F.floor((p - ncap) / (4 * n)).cast("long") + n)
    )
    staged = fixed(df, {"_ring": ring})
    i = F.col("_ring")
    along = (
        F.when(north, p + 1 - 2 * i * (i - 1))
        .when(south, 4 * i + 1 - ((total - p) - 2 * i * (i - 1)))
        .otherwise(p - ncap - 4 * n * (i - n) + 1)
    )
    staged = staged.withColumn("_along", along)
    cap = (i * i).cast("double") * (4.0 / total)
    half = F.when(F.pmod(i + n, F.lit(2)) == 1, 1.0).otherwise(0.5)
    belt_z = (2 * n - i).cast("double") * (2.0 / (3.0 * n))
    z = F.when(north, 1.0 - cap).when(south, cap - 1.0).otherwise(belt_z)
    s = F.when(north | south, F.sqrt(cap * (2.0 - cap))).otherwise(F.sqrt(1.0 - belt_z * belt_z))
    phi = F.when(north | south, (F.col("_along") - 0.5) * (math.pi / 2) / i).otherwise(
        (F.col("_along") - half) * (math.pi / (2.0 * n))
    )
    return staged.withColumns({"_rz": z, "_rs": s, "_rphi": phi}).drop("_ring", "_along")


def with_pixel_center(
    df: DataFrame, nside: int, pix: str = "pix", nest: bool = False, lon: str = "lon", lat: str = "lat"
) -> DataFrame:
    source = pix
    if nest:
        df, source = nest_to_ring(df, nside, pix, "_rpix"), "_rpix"
    out = _with_ring(df, nside, source).withColumns(
        {lon: F.pmod(F.degrees(F.col("_rphi")), F.lit(360.0)), lat: F.degrees(F.atan2(F.col("_rz"), F.col("_rs")))}
    )
    return out.drop("_rz", "_rs", "_rphi", "_rpix")


def nest_to_ring(df: DataFrame, nside: int, pix: str = "pix", name: str = "ring") -> DataFrame:
    n, order = nside, _order(nside)
    staged = fixed(df, {"_nf": F.floor(F.col(pix) / (n * n)).cast("long"), "_nl": F.pmod(F.col(pix), F.lit(n * n).cast("long"))})
    staged = fixed(staged, {"_nx": _gather("_nl", order, 0), "_ny": _gather("_nl", order, 1)})
    face, ix, iy = F.col("_nf"), F.col("_nx"), F.col("_ny")
    row = F.floor(face / 4).cast("long")
    # Longitude (in eighths) of the face's southern corner: even faces of the belt start at zero.
    start = F.when(row == 1, 2 * F.pmod(face, F.lit(4))).otherwise(2 * F.pmod(face, F.lit(4)) + 1)
    staged = staged.withColumns({"_njr": (row + 2) * n - ix - iy - 1, "_nst": start})
    jr = F.col("_njr")
    staged = staged.withColumn("_nr", F.when(jr < n, jr).when(jr > 3 * n, 4 * n - jr).otherwise(F.lit(n).cast("long")))
    nr = F.col("_nr")
    before = (
        F.when(jr < n, 2 * nr * (nr - 1))
        .when(jr > 3 * n, npix(n) - 2 * (nr + 1) * nr)
        .otherwise(2 * n * (n - 1) + (jr - n) * (4 * n))
    )
    shift = F.when((jr >= n) & (jr <= 3 * n), F.pmod(jr - n, F.lit(2))).otherwise(0)
    staged = staged.withColumns({"_nb": before, "_njp": F.floor((F.col("_nst") * nr + ix - iy + 1 + shift) / 2).cast("long")})
    jp = F.col("_njp")
    wrapped = F.when(jp > 4 * n, jp - 4 * n).when(jp < 1, jp + 4 * n).otherwise(jp)
    return staged.withColumn(name, (F.col("_nb") + wrapped - 1).cast("long")).drop(
        "_nf", "_nl", "_nx", "_ny", "_njr", "_nst", "_nr", "_nb", "_njp"
    )


def ring_to_nest(df: DataFrame, nside: int, pix: str = "pix", name: str = "nest") -> DataFrame:
    """By way of the pixel centre, which lies well inside its pixel."""
    centered = with_pixel_center(df, nside, pix, lon="_clon", lat="_clat")
    return with_pixel(centered, nside, "_clon", "_clat", nest=True, name=name).drop("_clon", "_clat")


def parent_pixel(pix: Column, nside: int, parent_nside: int) -> Column:
    """Nested parent at a lower resolution."""
    steps = _order(nside) - _order(parent_nside)
    if steps < 0:
        raise ValueError("parent_nside must not exceed nside")
    return F.shiftright(pix, 2 * steps)


def nested_range(pixel: int, parent_nside: int, nside: int = 2048) -> tuple[int, int]:
    """Half-open range of child pixels."""
    factor = 4 ** (_order(nside) - _order(parent_nside))
    return pixel * factor, (pixel + 1) * factor


def degrade_ring(df: DataFrame, nside: int, parent_nside: int, pix: str = "pix", name: str = "parent") -> DataFrame:
    staged = ring_to_nest(df, nside, pix, "_dn").withColumn("_dp", parent_pixel(F.col("_dn"), nside, parent_nside))
    return nest_to_ring(staged, parent_nside, "_dp", name).drop("_dn", "_dp")


def _ring_geometry(df: DataFrame, nside: int, ring: str, prefix: str) -> DataFrame:
    """First pixel, length, half-pixel shift and colatitude of a ring (1 .. 4*nside-1)."""
    n, total, ncap = nside, npix(nside), 2 * nside * (nside - 1)
    r = F.col(ring)
    staged = fixed(df, {f"{prefix}nr": F.when(r > 2 * n, 4 * n - r).otherwise(r)})
    nr = F.col(f"{prefix}nr")
    cap = (nr * nr).cast("double") * (4.0 / total)
    in_cap = nr < n
    length = F.when(in_cap, 4 * nr).otherwise(F.lit(4 * n).cast("long"))
    start = F.when(in_cap, 2 * nr * (nr - 1)).otherwise(ncap + (nr - n) * (4 * n))
    belt_z = (2 * n - nr).cast("double") * (2.0 / (3.0 * n))
    theta = F.when(in_cap, F.atan2(F.sqrt(cap * (2.0 - cap)), 1.0 - cap)).otherwise(F.acos(belt_z))
    shifted = F.when(in_cap | (F.pmod(nr - n, F.lit(2)) == 0), 0.5).otherwise(0.0)
    south = nr != r
    columns = {
        f"{prefix}len": length, f"{prefix}shift": shifted, f"{prefix}start": F.when(south, total - start - length).otherwise(start),
        f"{prefix}theta": F.when(south, math.pi - theta).otherwise(theta),
    }
    return fixed(staged, columns).drop(f"{prefix}nr")


def _ring_above(n: int, z: Column) -> Column:
    """Ring just north of a position, 0 above the first ring."""
    cap = _long(n * F.sqrt(3.0 * (1.0 - F.abs(z))))
    return F.when(F.abs(z) <= 2.0 / 3.0, _long(n * (2.0 - 1.5 * z))).when(z > 0, cap).otherwise(4 * n - cap - 1)


def with_interpolation(df: DataFrame, nside: int, lon: str, lat: str, name: str = "taps") -> DataFrame:
    """The four ring-ordered pixels around a position and their bilinear weights.

    Adds ``array<struct<pix: long, weight: double>>``.
    """
    n, total = nside, npix(nside)
    staged = fixed(
        df,
        {"_iz": F.sin(F.radians(F.col(lat))), "_iph": F.radians(F.pmod(F.col(lon), F.lit(360.0))), "_ith": F.radians(90.0 - F.col(lat))},
    )
    staged = fixed(staged, {"_ia": _ring_above(n, F.col("_iz"))})
    first, last = F.lit(1).cast("long"), F.lit(4 * n - 1).cast("long")
    staged = fixed(staged, {"_ra": F.greatest(F.col("_ia"), first), "_rb": F.least(F.col("_ia") + 1, last)})
    drops = ["_iz", "_iph", "_ith", "_ia", "_ra", "_rb"]
    for ring, p in (("_ra", "_u"), ("_rb", "_l")):
        staged = _ring_geometry(staged, n, ring, p)
        staged = fixed(staged, {f"{p}t": F.col("_iph") / (2.0 * math.pi / F.col(f"{p}len")) - F.col(f"{p}shift")})
        i = _long(F.col(f"{p}t"))
        staged = fixed(
            staged,
            {
                f"{p}w": F.col(f"{p}t") - i, f"{p}p1": F.col(f"{p}start") + F.pmod(i, F.col(f"{p}len")),
                f"{p}p2": F.col(f"{p}start") + F.pmod(i + 1, F.col(f"{p}len")),
            },
        )
        drops += [p + part for part in ("len", "shift", "start", "theta", "t", "w", "p1", "p2")]
    top, bottom = F.col("_ia") == 0, F.col("_ia") == 4 * n - 1
    share = (
        F.when(top, F.col("_ith") / F.col("_ltheta"))
        .when(bottom, (F.col("_ith") - F.col("_utheta")) / (math.pi - F.col("_utheta")))
        .otherwise((F.col("_ith") - F.col("_utheta")) / (F.col("_ltheta") - F.col("_utheta")))
    )
    staged = fixed(staged, {"_is": share})
    s = F.col("_is")
    # At a pole the missing ring is the pole itself: its weight is spread over the four pixels around it.
    quarter = F.when(top, (1.0 - s) / 4.0).when(bottom, s / 4.0).otherwise(0.0)
    upper = [F.when(top, quarter).otherwise((1.0 - s) * w + quarter) for w in (1.0 - F.col("_uw"), F.col("_uw"))]
    lower = [F.when(bottom, quarter).otherwise(s * w + quarter) for w in (1.0 - F.col("_lw"), F.col("_lw"))]
    across = lambda p: (p + 2).bitwiseAND(F.lit(3).cast("long"))
    first = [F.when(top, across(F.col(f"_lp{k}"))).otherwise(F.col(f"_up{k}")) for k in (1, 2)]
    second = [F.when(bottom, across(F.col(f"_up{k}")) + (total - 4)).otherwise(F.col(f"_lp{k}")) for k in (1, 2)]
    taps = [F.struct(p.cast("long").alias("pix"), w.alias("weight")) for p, w in zip(first + second, upper + lower)]
    return staged.withColumn(name, F.array(*taps)).drop(*drops, "_is")


def disc_pixels(
    df: DataFrame, nside: int, lon: str, lat: str, radius_deg: float, inclusive: bool = False, name: str = "pix"
) -> DataFrame:
    """One row per ring-ordered pixel of the disc around each position.

    Default: pixels whose centre lies in the disc. ``inclusive`` widens the disc by the largest pixel
    radius, so no overlapping pixel is missed.
    """
    n = nside
    radius = min(radius_deg + (max_pixel_radius_deg(n) if inclusive else 0.0), 180.0)
    top, low = F.radians(F.least(F.col(lat) + radius, F.lit(90.0))), F.radians(F.greatest(F.col(lat) - radius, F.lit(-90.0)))

    staged = df.withColumns(
        {
            "_dr1": F.greatest(_ring_above(n, F.sin(top)), F.lit(1).cast("long")),
            "_dr2": F.least(_ring_above(n, F.sin(low)) + 1, F.lit(4 * n - 1).cast("long")),
        }
    ).withColumn("_dr", F.explode(F.sequence("_dr1", "_dr2")))
    staged = _ring_geometry(staged, n, "_dr", "_d")
    lat0 = F.radians(F.col(lat))
    # cos(dphi) on the ring; out of [-1, 1] means none or all of the ring
    reach = F.lit(math.cos(math.radians(radius))) - F.cos("_dtheta") * F.sin(lat0)
    staged = fixed(staged, {"_dc": F.try_divide(reach, F.sin("_dtheta") * F.cos(lat0))})
    c = F.col("_dc")
    pole = F.abs(F.col(lat)) >= 90.0 - 1e-12
    inside_pole = F.abs(F.degrees(F.col("_dtheta")) - (90.0 - F.col(lat))) <= radius
    whole = (pole & inside_pole) | (~pole & (c <= -1.0))
    staged = staged.where(whole | (~pole & (c <= 1.0)))
    half = F.when(whole, F.lit(math.pi)).otherwise(F.acos(F.greatest(F.least(c, F.lit(1.0)), F.lit(-1.0))))
    phi0 = F.radians(F.pmod(F.col(lon), F.lit(360.0)))
    step = 2.0 * math.pi / F.col("_dlen")
    staged = staged.withColumns(
        {
            "_di1": F.when(whole, F.lit(0).cast("long")).otherwise(F.ceil((phi0 - half) / step - F.col("_dshift")).cast("long")),
            "_di2": F.when(whole, F.col("_dlen") - 1).otherwise(_long((phi0 + half) / step - F.col("_dshift"))),
        }
    ).where(F.col("_di1") <= F.col("_di2"))
    staged = staged.withColumn("_di2", F.least(F.col("_di2"), F.col("_di1") + F.col("_dlen") - 1))
    staged = staged.withColumn("_di", F.explode(F.sequence("_di1", "_di2")))
    pix = (F.col("_dstart") + F.pmod(F.col("_di"), F.col("_dlen"))).cast("long")
    return staged.withColumn(name, pix).drop(
        "_dr1", "_dr2", "_dr", "_dlen", "_dshift", "_dstart", "_dtheta", "_dc", "_di1", "_di2", "_di"
    )
