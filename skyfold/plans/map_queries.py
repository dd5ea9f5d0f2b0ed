"""Sky maps. The oracle computes ring pixels from the published formulas in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyfold.functions.healpix import disc_pixels, npix, parent_pixel, pixel_area_deg2, with_pixel, with_pixel_center
from skyfold.functions.selections import catalog_selection
from skyfold.operators import locus, maps, masks
from skyfold.operators.coadd import add_extended_class, add_extinction, coadd_healpix
from skyfold.operators.stats import sigma_clipped
from skyfold.operators.zeropoints import zeropoint_pairs
from skyfold.plans import views
from skyfold.plans.column_queries import GALACTIC_SQL, LOCUS_INPUT_SQL, _CUT, _cls, _sep_sql, gaia_expr
from skyfold.plans.shared import good, objects, rounded
from skyfold.plans.views import oracle
from skyfold.schema import BANDS, OBJECT_ID, band_columns
from skyfold.session import materialize


def ring_sql(nside: int, ra: str = "RA", dec: str = "DEC") -> str:
    """Ring pixel of a position as one SQL expression."""
    n, z, t = nside, f"sin(radians({dec}))", f"(({ra}) % 360)/90e0"
    a, b = f"floor({n}*(5e-1 + {t}) - {n}*{z}*75e-2)", f"floor({n}*(5e-1 + {t}) + {n}*{z}*75e-2)"
    ir = f"({n} + 1 + {a} - {b})"
    belt = f"{2 * n * (n - 1)} + ({ir} - 1)*{4 * n} + (floor(({a} + {b} - {n} + 2 - ({ir} % 2))/2) % {4 * n} + {4 * n}) % {4 * n}"
    cap = f"({n}*sqrt(3*(1 - abs({z}))))"
    tp = f"({t} - floor({t}))"
    ic = f"(floor({tp}*{cap}) + floor((1 - {tp})*{cap}) + 1)"
    ip = f"(floor({t}*{ic}) % (4*{ic}))"
    return f"CAST(CASE WHEN abs({z}) <= 2e0/3 THEN {belt} WHEN {z} > 0 THEN 2*{ic}*({ic} - 1) + {ip} ELSE {npix(n)} - 2*{ic}*({ic} + 1) + {ip} END AS BIGINT)"


def nested_sql(nside: int, source: str, ra: str = "RA", dec: str = "DEC") -> str:
    """Rows of ``source`` with the nested pixel ``nest`` of a position, and ``face``, ``ix`` and ``iy`` it is made of."""
    n, order = nside, nside.bit_length() - 1
    spread = lambda v: " + ".join(f"((CAST({v} AS BIGINT) & {1 << k}) << {k})" for k in range(order))
    return f"""
        SELECT * EXCLUDE (z_, t_, belt_, p_, m_), face*{n * n} + {spread("ix")} + 2*({spread("iy")}) AS nest FROM (
            SELECT *,
                CAST(CASE WHEN belt_ AND p_ // {n} = m_ // {n} THEN 4 + (p_ // {n}) % 4 WHEN belt_ AND p_ // {n} < m_ // {n} THEN p_ // {n}
                     WHEN belt_ THEN 8 + m_ // {n} WHEN z_ >= 0 THEN least(floor(t_), 3) ELSE 8 + least(floor(t_), 3) END AS BIGINT) AS face,
                CAST(CASE WHEN belt_ THEN m_ % {n} WHEN z_ >= 0 THEN {n - 1} - least(m_, {n - 1}) ELSE least(p_, {n - 1}) END AS BIGINT) AS ix,
                CAST(CASE WHEN belt_ THEN {n - 1} - p_ % {n} WHEN z_ >= 0 THEN {n - 1} - least(p_, {n - 1}) ELSE least(m_, {n - 1}) END AS BIGINT) AS iy
            FROM (
                SELECT *, abs(z_) <= 2e0/3 AS belt_,
                    CAST(floor(CASE WHEN abs(z_) <= 2e0/3 THEN {n}*(5e-1 + t_ - 75e-2*z_) ELSE (t_ - floor(t_))*{n}*sqrt(3*(1 - abs(z_))) END) AS BIGINT) AS p_,
                    CAST(floor(CASE WHEN abs(z_) <= 2e0/3 THEN {n}*(5e-1 + t_ + 75e-2*z_) ELSE (1 - t_ + floor(t_))*{n}*sqrt(3*(1 - abs(z_))) END) AS BIGINT) AS m_
                FROM (SELECT *, sin(radians({dec})) AS z_, (({ra}) % 360)/90e0 AS t_ FROM {source})
            )
        )"""


def healpix_index(spark, sf):
    """Ring pixels at three resolutions, and counts of objects in each."""
    sizes = (8, 64, 1024)
    df = views.detections(spark, sf).select("RA", "DEC")
    for nside in sizes:
        df = with_pixel(df, nside, name=f"p{nside}")
    each = F.array(*[F.struct(F.lit(nside).cast("long").alias("nside"), F.col(f"p{nside}").alias("pix")) for nside in sizes])
    return df.select(F.inline(each)).groupBy("nside", "pix").agg(F.count(F.lit(1)).alias("n"))


HEALPIX_SQL = oracle(
    " UNION ALL ".join(f"SELECT {ring_sql(n)} AS pix, count(*) AS n, CAST({n} AS BIGINT) AS nside FROM detections_v GROUP BY 1" for n in (8, 64, 1024)), "detections_v",
)


def healpix_nested(spark, sf):
    """Fine nested index of each object and its parent; the parent must be the pixel at the lower resolution."""
    df = coadd_healpix(views.reference(spark, sf))
    df = with_pixel(df.withColumn("parent", parent_pixel(F.col("HPX2048"), 2048, 64)), 64, nest=True, name="direct")
    df = with_pixel_center(df, 2048, "HPX2048", nest=True)
    return rounded(df.select("OBJID", "HPX2048", "parent", "direct", "lon", "lat"))


NESTED_SQL = oracle(
    f"""
    SELECT OBJID, nest AS HPX2048, nest >> 10 AS parent, direct,
        round((((CASE WHEN face BETWEEN 4 AND 7 THEN 2*(face - 4) ELSE 2*(face % 4) + 1 END)*nr + ix - iy + 1 + shift)/2e0 - (shift + 1)/2e0 + 4*nr) % (4*nr)*90/nr, 6) AS lon,
        round(degrees(asin(CASE WHEN jr < 2048 THEN 1 - nr*nr/3e0/2048/2048 WHEN jr > 3*2048 THEN nr*nr/3e0/2048/2048 - 1 ELSE (2*2048 - jr)*2e0/3/2048 END)), 6) AS lat
    FROM (
        SELECT *, CASE WHEN jr < 2048 THEN jr WHEN jr > 3*2048 THEN 4*2048 - jr ELSE 2048 END AS nr, CASE WHEN jr BETWEEN 2048 AND 3*2048 THEN (jr - 2048) % 2 ELSE 0 END AS shift
        FROM (SELECT *, (2 + face // 4)*2048 - ix - iy - 1 AS jr FROM ({nested_sql(2048, "reference_v")}))
    ) JOIN (SELECT OBJID, nest AS direct FROM ({nested_sql(64, "reference_v")})) USING (OBJID)
    """, "reference_v",
)


def footprint_counts(spark, sf):
    df = add_extended_class(objects(spark, sf), "griz")
    picks = {"r": catalog_selection("r"), "griz": catalog_selection("griz"), "any": catalog_selection("any"), "star": catalog_selection("r", extclass="star")}
    return maps.footprint_counts(df, 16, picks)


FOOTPRINT_SQL = oracle(
    f"SELECT {ring_sql(16)} AS pix, count(*) FILTER (WHERE {_CUT['r']}) AS r, count(*) FILTER (WHERE {' AND '.join(_CUT.values())}) AS griz, count(*) AS any, "
    f"count(*) FILTER (WHERE {_CUT['r']} AND {_cls('R')} IN (0, 1)) AS star FROM objects_v GROUP BY 1", "objects_v",
)


def density(spark, sf):
    return rounded(maps.galaxy_density(objects(spark, sf), 16))


DENSITY_SQL = oracle(
    f"""
    SELECT nest AS pix, round(count(*)/{pixel_area_deg2(16)!r}::double, 6) AS density FROM ({nested_sql(16, "objects_v")})
    WHERE WAVG_MAG_AUTO_I > 195e-1 AND WAVG_MAG_AUTO_I < 205e-1 AND WAVG_SPREAD_MODEL_I > 5e-3 GROUP BY nest
    """, "objects_v",
)


def log_density(spark, sf):
    return rounded(maps.log_density(objects(spark, sf), 16))


LOG_DENSITY_SQL = oracle(
    f"SELECT pix, n, round(log10(n/{pixel_area_deg2(16)!r}::double), 6) AS log_density FROM (SELECT {ring_sql(16)} AS pix, count(*) AS n FROM objects_v WHERE MAG_PSF_G < 23 GROUP BY 1)", "objects_v",
)


def teff_map(spark, sf):
    df = objects(spark, sf)
    median = maps.exposure_map(df, 8).withColumnRenamed("t_eff", "median_t_eff")
    return rounded(median.join(maps.exposure_map(df, 8, "mean").withColumnRenamed("t_eff", "mean_t_eff"), ["band", "pix"]))


TEFF_MAP_SQL = oracle(
    "SELECT band, pix, round(median(t), 6) AS median_t_eff, round(avg(t), 6) AS mean_t_eff FROM ("
    + " UNION ALL ".join(f"SELECT '{b}' AS band, {ring_sql(8)} AS pix, T_EFF_{b.upper()} AS t FROM objects_v" for b in "grizY") + ") GROUP BY band, pix", "objects_v",
)


DEPTH_BEST = ["MAG_PSF", "MAGERR_PSF", "MAG_AUTO", "MAGERR_AUTO", "SPREAD_MODEL", "SPREADERR_MODEL", "FLAGS", "T_EFF", "EXPTIME"]
DEPTH_FIELDS = ["MAG_PSF", "MAGERR_PSF", "MAG_AUTO", "MAGERR_AUTO", "WAVG_MAG_PSF", "WAVG_SPREAD_MODEL"]


def _shards(spark, sf):
    """What the depth maps read of the objects, and their shard."""
    df = objects(spark, sf, DEPTH_BEST, gather=True).select(OBJECT_ID, "RA", "DEC", *band_columns(DEPTH_FIELDS, BANDS))
    return materialize(df.withColumn("HPX", F.floor((F.col("DEC") + 60.0) / 45.0).cast("long")), "objects")


def depth_map(spark, sf):
    return rounded(maps.depth_map(_shards(spark, sf), OBJECT_ID, nside=4, kind="PSF"))


def depth_map_auto(spark, sf):
    return rounded(maps.depth_map(_shards(spark, sf), OBJECT_ID, nside=4, snr=5.0, kind="AUTO"))


def sparse_depth(spark, sf):
    return rounded(maps.sparse_depth_map(_shards(spark, sf), OBJECT_ID, nside=4))


def _depth_sql(kind: str, target: str, start: str, cut: str, stars: bool) -> str:
    """Depth per band and pixel by its definition: every pair of objects of a shard, every slope at every grid point."""
    parts = " UNION ALL ".join(
        f"SELECT CAST(floor((DEC + 60)/45) AS BIGINT) AS hpx, '{b}' AS band, TRUE_ID AS id, RA, DEC, MAG_{kind}_{b.upper()} AS mag, MAGERR_{kind}_{b.upper()} AS err, "
        f"{cut}_{b.upper()} AS cut, WAVG_SPREAD_MODEL_{b.upper()} AS spread FROM objects_v"
        for b in "grizY"
    )
    return oracle(
        f"""
        , rows_ AS ({parts}
        ), bins AS (
            SELECT hpx, band, least(CAST(floor((cut - {start})/1e-1 + 1e-9) AS BIGINT), CAST(round((299e-1 - {start})*10) AS BIGINT) - 1) AS bin, count(*) AS n
            FROM rows_ WHERE cut >= {start} AND cut <= 299e-1 GROUP BY 1, 2, 3
        ), ends AS (
            SELECT hpx, band, {start} + 1e-1*arg_min(bin, (-n, bin)) - 3 AS bright FROM bins GROUP BY 1, 2
        ), chosen AS (
            SELECT r.* FROM rows_ r JOIN ends e USING (hpx, band) WHERE cut - bright > 0 AND cut < 30 {"AND abs(spread) < 2e-3" if stars else ""}
        ), pairs AS (
            SELECT hpx, band, id, arg_min(other, (d, other)) AS other FROM (
                SELECT a.hpx, a.band, a.id, b.id AS other,
                    pow(sin(radians(b.DEC - a.DEC)/2), 2) + cos(radians(a.DEC))*cos(radians(b.DEC))*pow(sin(radians(b.RA - a.RA)/2), 2) AS d
                FROM chosen a JOIN chosen b ON a.hpx = b.hpx AND a.band = b.band AND a.id <> b.id
            ) GROUP BY 1, 2, 3
        ), slopes AS (
            SELECT p.hpx, p.band, (log10(b.err) - log10(a.err))/(b.mag - a.mag) AS v
            FROM pairs p JOIN chosen a ON (a.hpx, a.band, a.id) = (p.hpx, p.band, p.id) JOIN chosen b ON (b.hpx, b.band, b.id) = (p.hpx, p.band, p.other)
            WHERE b.mag - a.mag > 5e-1
        ), widths AS (
            SELECT hpx, band, pow(count(*), -2e-1)*stddev_samp(v) AS h FROM slopes GROUP BY 1, 2 HAVING count(*) > 1
        ), sums AS (
            SELECT hpx, band, g, sum(exp(-5e-1*pow((g/999e0 - v)/h, 2))) AS s FROM slopes JOIN widths USING (hpx, band), range(1000) t(g) WHERE h > 0 GROUP BY 1, 2, 3
        ), modes AS (
            SELECT hpx, band, arg_max(g, (s, -g))/999e0 AS slope FROM sums GROUP BY 1, 2
        )
        SELECT band, {ring_sql(4)} AS pix, round(median(mag - (log10(err) - log10({target}))/nullif(slope, 0)), 6) AS maglim
        FROM chosen JOIN modes USING (hpx, band) GROUP BY 1, 2
        """, "objects_v",
    )


_POGSON = "25e-1/ln(10e0)"
DEPTH_SQL = _depth_sql("PSF", f"({_POGSON}/10)", "17e0", "MAG_PSF", True)
DEPTH_AUTO_SQL = _depth_sql("AUTO", f"({_POGSON}/5)", "17e0", "MAG_AUTO", False)
SPARSE_DEPTH_SQL = (
    "SELECT pix, " + ", ".join(f"max(maglim) FILTER (WHERE band = '{b}') AS MAGLIM_{b.upper()}" for b in "grizY")
    + f" FROM ({_depth_sql('PSF', '1e-1', '15e0', 'WAVG_MAG_PSF', True)}) GROUP BY pix"
)


def _dust(spark, sf):
    """A map with a value in every pixel, from the whole orders table: mean price by pixel number."""
    return views.table(spark, sf, "orders").groupBy((F.col("o_orderkey") % npix(8)).alias("pix")).agg((F.avg("o_totalprice") / 1e6).alias("ebv"))


def ebv_interp(spark, sf):
    df = views.reference(spark, sf).withColumn(OBJECT_ID, F.col("OBJID"))
    out = add_extinction(df, "griz", _dust(spark, sf), 8)
    return rounded(out.select("OBJID", "EBV", *[f"EXTINCTION_{b.upper()}" for b in "griz"]))


def _ring_geometry_sql(ring: str, p: str, n: int = 8) -> str:
    """First pixel, length, shift and colatitude of a ring."""
    nr = f"(CASE WHEN {ring} > {2 * n} THEN {4 * n} - {ring} ELSE {ring} END)"
    cap = f"{nr} < {n}"
    before = f"(CASE WHEN {cap} THEN 2*{nr}*({nr} - 1) ELSE {2 * n * (n - 1)} + ({nr} - {n})*{4 * n} END)"
    length = f"(CASE WHEN {cap} THEN 4*{nr} ELSE {4 * n} END)"
    cosine = f"(CASE WHEN {cap} THEN 1 - {nr}*{nr}/{3e0 * n * n!r}::double ELSE ({2 * n} - {nr})*2e0/{3 * n} END)"
    return (
        f"CASE WHEN {ring} > {2 * n} THEN {npix(n)} - {before} - {length} ELSE {before} END AS {p}start, {length} AS {p}len, "
        f"CASE WHEN {cap} OR ({nr} - {n}) % 2 = 0 THEN 5e-1 ELSE 0e0 END AS {p}shift, acos(CASE WHEN {ring} > {2 * n} THEN -1 ELSE 1 END*{cosine}) AS {p}theta"
    )


EBV_SQL = oracle(
    f"""
    , dust AS (SELECT o_orderkey % {npix(8)} AS pix, avg(o_totalprice)/1e6 AS ebv FROM orders GROUP BY 1
    ), placed AS (SELECT OBJID, sin(b) AS z, pi()/2 - b AS th, CASE WHEN l < 0 THEN l + 2*pi() ELSE l END AS ph
        FROM (SELECT OBJID, atan2({GALACTIC_SQL[1]}, {GALACTIC_SQL[0]}) AS l, asin({GALACTIC_SQL[2]}) AS b FROM reference_v)
    ), ringed AS (SELECT *, CAST(CASE WHEN abs(z) <= 2e0/3 THEN floor(8*(2 - 15e-1*z)) WHEN z > 0 THEN floor(8*sqrt(3*(1 - z))) ELSE 31 - floor(8*sqrt(3*(1 + z))) END AS BIGINT) AS ia FROM placed
    ), between_rings AS (SELECT *, greatest(ia, 1) AS ra_, least(ia + 1, 31) AS rb_ FROM ringed
    ), shaped AS (SELECT *, {_ring_geometry_sql("ra_", "u")}, {_ring_geometry_sql("rb_", "l")} FROM between_rings
    ), along AS (SELECT *, ph*ulen/(2*pi()) - ushift AS ut, ph*llen/(2*pi()) - lshift AS lt,
        CASE WHEN ia = 0 THEN th/ltheta WHEN ia = 31 THEN (th - utheta)/(pi() - utheta) ELSE (th - utheta)/(ltheta - utheta) END AS s FROM shaped
    ), whole AS (SELECT *, CAST(floor(ut) AS BIGINT) AS ui, CAST(floor(lt) AS BIGINT) AS li,
        CASE WHEN ia = 0 THEN (1 - s)/4 WHEN ia = 31 THEN s/4 ELSE 0 END AS q FROM along
    ), taps AS (
        SELECT OBJID, unnest([
            {{'pix': CASE WHEN ia = 0 THEN (lstart + (li + llen) % llen + 2) % 4 ELSE ustart + (ui + ulen) % ulen END, 'w': CASE WHEN ia = 0 THEN q ELSE (1 - s)*(1 - ut + ui) + q END}},
            {{'pix': CASE WHEN ia = 0 THEN (lstart + (li + 1) % llen + 2) % 4 ELSE ustart + (ui + 1) % ulen END, 'w': CASE WHEN ia = 0 THEN q ELSE (1 - s)*(ut - ui) + q END}},
            {{'pix': CASE WHEN ia = 31 THEN (ustart + (ui + ulen) % ulen + 2) % 4 + {npix(8) - 4} ELSE lstart + (li + llen) % llen END, 'w': CASE WHEN ia = 31 THEN q ELSE s*(1 - lt + li) + q END}},
            {{'pix': CASE WHEN ia = 31 THEN (ustart + (ui + 1) % ulen + 2) % 4 + {npix(8) - 4} ELSE lstart + (li + 1) % llen END, 'w': CASE WHEN ia = 31 THEN q ELSE s*(lt - li) + q END}}]) AS tap
        FROM whole
    ), summed AS (SELECT OBJID, CASE WHEN count(ebv) FILTER (WHERE tap.w > 0) = count(*) FILTER (WHERE tap.w > 0) THEN sum(tap.w*ebv) FILTER (WHERE tap.w > 0) END AS EBV
        FROM taps LEFT JOIN dust ON dust.pix = tap.pix GROUP BY OBJID)
    SELECT OBJID, round(EBV, 6) AS EBV, round(3186e-3*EBV, 6) AS EXTINCTION_G, round(214e-2*EBV, 6) AS EXTINCTION_R, round(1569e-3*EBV, 6) AS EXTINCTION_I, round(1196e-3*EBV, 6) AS EXTINCTION_Z FROM summed
    """, "reference_v",
)


def disc_footprint(spark, sf):
    """Pixels whose centre lies in the field of each exposure."""
    pix = disc_pixels(views.exposures(spark, sf), 32, "telra", "teldec", 3.0)
    return pix.groupBy("expnum").agg(F.count(F.lit(1)).alias("n"), F.min("pix").alias("first"), F.max("pix").alias("last"), F.sum("pix").alias("total"))


_CENTERS = (
    "SELECT pix, CASE WHEN pix < 1984 THEN degrees(asin(1 - i*i*4e0/12288)) WHEN pix >= 12288 - 1984 THEN -degrees(asin(1 - i*i*4e0/12288)) ELSE degrees(asin((64 - i)*2e0/96)) END AS lat, "
    "CASE WHEN pix < 1984 THEN (pix + 1 - 2*i*(i - 1) - 5e-1)*90/i WHEN pix >= 12288 - 1984 THEN (4*i + 1 - (12288 - pix - 2*i*(i - 1)) - 5e-1)*90/i "
    "ELSE (pix - 1984 - 128*(i - 32) + 1 - CASE WHEN (i + 32) % 2 = 1 THEN 1e0 ELSE 5e-1 END)*90/32 END AS lon FROM (SELECT pix, CASE WHEN pix < 1984 THEN CAST(floor((1 + sqrt(1 + 2*pix))/2) AS BIGINT) "
    "WHEN pix >= 12288 - 1984 THEN CAST(floor((1 + sqrt(2*(12288 - pix) - 1))/2) AS BIGINT) ELSE CAST(floor((pix - 1984)/128) AS BIGINT) + 32 END AS i FROM range(12288) t(pix))"
)
DISC_SQL = oracle(
    f"SELECT expnum, count(*) AS n, min(pix) AS first, max(pix) AS last, CAST(sum(pix) AS BIGINT) AS total FROM exposures_v e JOIN ({_CENTERS}) c ON c.lat BETWEEN e.teldec - 3001e-3 AND e.teldec + 3001e-3 "
    f"AND {_sep_sql('e.telra', 'e.teldec', 'c.lon', 'c.lat')} <= 3 GROUP BY expnum", "exposures_v",
)

STAR_R = "abs(WAVG_SPREAD_MODEL_R) < 2e-3 AND NEPOCHS_R > 1"


def astrom_external(spark, sf):
    df = objects(spark, sf).withColumn("MAG_PSF_R", F.col("MAG_PSF_R") - 1.5)
    return rounded(maps.external_astrometry(df, views.reference(spark, sf), OBJECT_ID, "OBJID", nside=4), digits=4)


EXTERNAL_SQL = oracle(
    f"SELECT pix, round(median(s), 4) AS value, count(*) AS n FROM (SELECT {ring_sql(4, 'o.RA', 'o.DEC')} AS pix, 36e5*{_sep_sql('o.RA', 'o.DEC', 'r.RA', 'r.DEC')} AS s FROM objects_v o JOIN reference_v r ON o.TRUE_ID = r.OBJID "
    f"WHERE {STAR_R} AND MAG_PSF_R - 15e-1 > 16 AND MAG_PSF_R - 15e-1 < 19) GROUP BY pix", "objects_v", "reference_v",
)


def astrom_internal(spark, sf):
    return rounded(maps.internal_astrometry(objects(spark, sf), good(spark, sf), nside=4, band="griz"), digits=4)


INTERNAL_SQL = oracle(
    f"SELECT pix, round(median(s), 4) AS value, count(*) AS n FROM (SELECT {ring_sql(4, 'o.RA', 'o.DEC')} AS pix, 36e5*{_sep_sql('o.RA', 'o.DEC', 'd.RA', 'd.DEC')} AS s FROM objects_v o JOIN good_v d ON o.TRUE_ID = d.TRUE_ID "
    f"WHERE {STAR_R} AND o.MAG_PSF_R > 17 AND o.MAG_PSF_R < 21) WHERE s/1e3 > 1e-5 GROUP BY pix", "objects_v", "good_v",
)


def gaia_offsets(spark, sf):
    gaia = views.reference(spark, sf).select("OBJID", "RA", "DEC", (F.col("R") - 0.5).alias("PHOT_G_MEAN_MAG_AB"))
    df = objects(spark, sf).withColumns({"WAVG_MAG_PSF_Z": F.col("WAVG_MAG_PSF_I") - 0.1})
    return rounded(maps.gaia_photometry(df, gaia, OBJECT_ID, "OBJID", nside=2))


def _gaia_matches_sql(mags: dict[str, str], spread: str, where: str) -> str:
    """Stars next to a reference row, with predicted and observed magnitude; a star is near its own reference row only."""
    named = ", ".join(f"{m} AS {b}" for b, m in mags.items())
    return f"""
        SELECT left_id, right_id, RA, DEC, {gaia_expr("edr3")} AS G_PRED, G_OBS FROM (
            SELECT o.TRUE_ID AS left_id, r.OBJID AS right_id, o.RA, o.DEC, r.R - 5e-1 AS G_OBS, o.G, o.R, o.I, o.Z
            FROM (SELECT TRUE_ID, RA, DEC, {spread} AS spread, NEPOCHS_R, {named} FROM objects_v WHERE {where}) o
            JOIN reference_v r ON o.TRUE_ID = r.OBJID AND {_sep_sql("o.RA", "o.DEC", "r.RA", "r.DEC")} < 5e-1/3600
            WHERE r.R - 5e-1 < 20 AND abs(spread) < 2e-3 AND o.R > 16 AND o.R < 20 AND NEPOCHS_R > 1 AND o.G - o.I > 5e-1 AND o.G - o.I < 15e-1
                AND o.G < 90 AND o.R < 90 AND o.I < 90 AND o.Z < 90
        )"""


_WAVG_MAGS = {"G": "WAVG_MAG_PSF_G", "R": "WAVG_MAG_PSF_R", "I": "WAVG_MAG_PSF_I", "Z": "(WAVG_MAG_PSF_I - 1e-1)"}
GAIA_OFFSETS_SQL = oracle(
    f"SELECT {ring_sql(2)} AS pix, round(median(G_PRED - G_OBS), 6) AS value, count(*) AS n FROM ({_gaia_matches_sql(_WAVG_MAGS, 'WAVG_SPREAD_MODEL_R', 'TRUE')}) GROUP BY 1",
    "objects_v", "reference_v",
)


def gaia_shifted(spark, sf):
    """The variant that moves magnitudes to another zeropoint solution first."""
    gaia = views.reference(spark, sf).select("OBJID", "RA", "DEC", (F.col("R") - 0.5).alias("PHOT_G_MEAN_MAG_AB"))
    df = objects(spark, sf).withColumn("MAG_PSF_Z", F.col("MAG_PSF_I") - 0.1)
    df = df.withColumns({f"MAG_ZERO_{b}": F.lit(30.0) for b in "GRIZ"} | {f"ALT_ZPT_{b}": F.lit(30.0) + (F.col("TRUE_ID") % 15) / 1e2 for b in "GRIZ"})
    return rounded(maps.gaia_matches(df, gaia, OBJECT_ID, "OBJID", field="", zero_shift=True).select("left_id", "right_id", "G_PRED", "G_OBS"))


_SHIFT = "((30e0 + (TRUE_ID % 15)/1e2) - 30e0)"
_SHIFTED_MAGS = {"G": f"MAG_PSF_G + {_SHIFT}", "R": f"MAG_PSF_R + {_SHIFT}", "I": f"MAG_PSF_I + {_SHIFT}", "Z": f"MAG_PSF_I - 1e-1 + {_SHIFT}"}
GAIA_SHIFTED_SQL = oracle(
    f"SELECT left_id, right_id, round(G_PRED, 6) AS G_PRED, round(G_OBS, 6) AS G_OBS FROM ({_gaia_matches_sql(_SHIFTED_MAGS, 'SPREAD_MODEL_R', f'abs({_SHIFT}) < 1e-1')})",
    "objects_v", "reference_v",
)


def photom_offsets(spark, sf):
    df = objects(spark, sf)
    other = df.withColumn("WAVG_MAG_PSF_R", F.col("WAVG_MAG_PSF_R") + (F.col("TRUE_ID") % 7) / 1e3)
    return rounded(maps.catalog_photometry(df, other, OBJECT_ID, "TRUE_ID", "r", nside=4))


PHOTOM_SQL = oracle(
    f"SELECT {ring_sql(4)} AS pix, round(median(WAVG_MAG_PSF_R - (WAVG_MAG_PSF_R + (TRUE_ID % 7)/1e3)), 6) AS value, count(*) AS n FROM objects_v WHERE {STAR_R} AND WAVG_MAG_PSF_R > 16 AND WAVG_MAG_PSF_R < 20 "
    "AND WAVG_MAG_PSF_R + (TRUE_ID % 7)/1e3 > 16 AND WAVG_MAG_PSF_R + (TRUE_ID % 7)/1e3 < 20 GROUP BY 1", "objects_v",
)


def rms_map_weighted(spark, sf):
    df = objects(spark, sf).withColumn("WAVG_MAG_PSF_R", F.col("WAVG_MAG_PSF_R") - 1.9)
    return rounded(maps.weighted_rms_photometry(df, "r", nside=4))


RMS_SQL = oracle(
    f"SELECT {ring_sql(4)} AS pix, round(median(WAVG_MAGRMS_PSF_R), 6) AS value, count(*) AS n FROM objects_v WHERE {STAR_R} AND WAVG_MAG_PSF_R - 19e-1 > 16 AND WAVG_MAG_PSF_R - 19e-1 < 17 AND WAVG_MAGRMS_PSF_R < 90 GROUP BY 1", "objects_v",
)


def rms_map_detections(spark, sf):
    df = good(spark, sf).withColumn("MAG_PSF", F.col("MAG_PSF") - 1.0)
    return rounded(maps.detection_rms_photometry(df, nside=4))


RMS_DET_SQL = oracle(
    f"SELECT {ring_sql(4)} AS pix, round(median(rms), 6) AS value, count(rms) AS n FROM (SELECT TRUE_ID, median(RA) AS RA, median(DEC) AS DEC, stddev_samp(MAG_PSF - 1) AS rms FROM good_v WHERE abs(SPREAD_MODEL) < 2e-3 "
    "AND MAG_PSF - 1 > 16 AND MAG_PSF - 1 < 18 GROUP BY TRUE_ID) GROUP BY 1", "good_v",
)


def zp_diff_maps(spark, sf):
    first = views.zeropoints(spark, sf)
    second = first.withColumn("MAG_ZERO", F.col("MAG_ZERO") - (F.col("CCDNUM") % 9) / 1e3)
    pairs = zeropoint_pairs(first, second).withColumn("CELL", F.floor(F.col("ra_2") / 30).cast("long"))
    return rounded(maps.zeropoint_difference_maps(pairs, pix="CELL"))


ZP_DIFF_SQL = oracle(
    "SELECT pix, " + ", ".join(f"round(max({f}) FILTER (WHERE BAND = '{b}'), 6) AS {f}_{b}" for b in "griz" for f in ("first", "second", "diff")) + ", "
    + ", ".join(
        f"round((max(first) FILTER (WHERE BAND = '{a}') - max(first) FILTER (WHERE BAND = '{b}')) - (max(second) FILTER (WHERE BAND = '{a}') - max(second) FILTER (WHERE BAND = '{b}')), 6) AS color_{a}{b}" for a, b in ("gr", "ri", "iz")
    )
    + " FROM (SELECT CAST(floor(RA/30) AS BIGINT) AS pix, BAND, median(MAG_ZERO) AS first, median(MAG_ZERO - (CCDNUM % 9)/1e3) AS second, median(MAG_ZERO - (MAG_ZERO - (CCDNUM % 9)/1e3)) AS diff FROM zeropoints_v GROUP BY 1, 2) GROUP BY pix",
    "zeropoints_v",
)


def _locus_stars(spark, sf):
    df = views.reference(spark, sf).withColumns(
        {"BDF_S2N": F.expr("pow(1e1, (OBJID % 70)/1e1 - 2e0)"), "BDF_T": F.expr("(OBJID % 31 - 25)/1e2"), "EBV": F.expr("(OBJID % 100)/1e3"), "MAG_PSF_G": F.col("G"), "MAG_PSF_R": F.col("R"), "MAG_PSF_I": F.col("I")}
    )
    return locus.filter_stars(df).withColumn("pix", F.floor(F.col("RA") / 60).cast("long"))


def colour_locus(spark, sf):
    return rounded(locus.color_locus(_locus_stars(spark, sf)))


_AXES = {
    "along": "cos(atan(m))*(gr - 3e-1) + sin(atan(m))*(ri - (m*3e-1 + b))", "across": "(-m*g0 + (m + 1)*r0 - i0 - b)/sqrt(m*m + (m + 1)*(m + 1) + 1)",
}
_OKC = "gr < 11e-1 AND gr > 3e-1 AND abs(ri) < 1 AND g0 < 20 AND r0 < 20 AND i0 < 20"
LOCUS_SQL = oracle(
    f", stars AS (SELECT *, CAST(floor(RA/60) AS BIGINT) AS pix, g0 - r0 AS gr, r0 - i0 AS ri FROM ({LOCUS_INPUT_SQL})), counts AS (SELECT pix, count(*) AS n_all FROM stars GROUP BY pix), "
    "few AS (SELECT * FROM stars WHERE pix IN (SELECT pix FROM counts WHERE n_all > 10)), "
    f"f1 AS (SELECT pix, regr_slope(ri, gr) AS m, regr_intercept(ri, gr) AS b FROM few WHERE {_OKC} GROUP BY pix), "
    f"p1 AS (SELECT s.*, {_AXES['along']} AS p1, {_AXES['across']} AS p2 FROM few s JOIN f1 USING (pix)), "
    "clip AS (SELECT pix, 3*74e-2*(quantile_cont(p2, 75e-2) - quantile_cont(p2, 25e-2)) AS clip FROM p1 WHERE p1 > -2e-1 AND p1 < 6e-1 GROUP BY pix HAVING count(*) >= 10), "
    f"f2 AS (SELECT pix, regr_slope(ri, gr) AS m, regr_intercept(ri, gr) AS b FROM p1 JOIN clip USING (pix) WHERE {_OKC} AND abs(p2) < clip GROUP BY pix HAVING count(*) >= 10), "
    f"p2 AS (SELECT s.pix, {_AXES['along']} AS p1, {_AXES['across']} AS p2 FROM few s JOIN f2 USING (pix)), "
    "med AS (SELECT *, median(p2) OVER (PARTITION BY pix) AS c FROM p2 WHERE p1 > -2e-1 AND p1 < 6e-1), mad AS (SELECT pix, 14826e-4*median(abs(p2 - c)) AS width, count(*) AS k FROM med GROUP BY pix) "
    "SELECT pix, CASE WHEN n_all <= 10 THEN n_all ELSE k END AS n, round(CASE WHEN k >= 10 THEN width END, 6) AS width, round(CASE WHEN k >= 10 THEN m END, 6) AS slope, round(CASE WHEN k >= 10 THEN b END, 6) AS intercept "
    "FROM counts LEFT JOIN f2 USING (pix) LEFT JOIN mad USING (pix)", "reference_v",
)


def release_residuals(spark, sf):
    df = objects(spark, sf)
    other = df.withColumns({f"WAVG_MAG_PSF_{b}": F.col(f"WAVG_MAG_PSF_{b}") + (F.col("TRUE_ID") % 11 - 5) / 1e3 for b in "GRIZ"} | {"WAVG_SPREAD_MODEL_R": F.col("WAVG_SPREAD_MODEL_R") + 1e-4})
    res = maps.release_residuals(df, other, OBJECT_ID, "TRUE_ID", ["g", "r", "i", "z"])
    return rounded(sigma_clipped(res, ["band"], "residual"))


RESIDUAL_SQL = oracle(
    " UNION ALL ".join(
        f"SELECT '{b}' AS band, round(median(d), 6) AS median, round(avg(d), 6) AS mean, round(stddev_pop(d), 6) AS sigma, count(*) AS n FROM (SELECT (WAVG_MAG_PSF_{b.upper()} + (TRUE_ID % 11 - 5)/1e3) - WAVG_MAG_PSF_{b.upper()} AS d FROM objects_v "
        f"WHERE WAVG_MAG_PSF_{b.upper()} > 17 AND WAVG_MAG_PSF_{b.upper()} < 22 AND WAVG_MAG_PSF_{b.upper()} + (TRUE_ID % 11 - 5)/1e3 > 17 AND WAVG_MAG_PSF_{b.upper()} + (TRUE_ID % 11 - 5)/1e3 < 22 AND WAVG_SPREAD_MODEL_R + 1e-4 < 2e-3)"
        for b in "griz"
    ), "objects_v",
)


def mask_lookup(spark, sf):
    """Bits of the masks under each detection. Two overlapping rasters come from the customer table."""
    raster = views.table(spark, sf, "customer").selectExpr(
        "concat('T', c_custkey % 2) AS tile", "cast(c_custkey % 60 as int) AS xpix", "cast(floor(c_custkey/60) % 25 as int) AS ypix", "cast(pow(2, c_custkey % 10) as int) AS value"
    ).groupBy("tile", "xpix", "ypix").agg(F.bit_or("value").alias("value"))
    df = views.detections(spark, sf)
    cells = df.select(F.col("det_id").alias("id"), F.floor(F.col("RA") / 4).cast("int").alias("xpix"), F.floor((F.col("DEC") + 60) / 3).cast("int").alias("ypix"))
    placed = cells.where("xpix < 60 AND ypix < 25").withColumn("tile", F.explode(F.array(F.lit("T0"), F.lit("T1"))))
    out = masks.mask_values(df, raster, placed, "det_id")
    return out.groupBy("TRUE_ID", F.col("mask").cast("long").alias("mask")).agg(F.count(F.lit(1)).alias("n"))


MASK_SQL = oracle(
    ", raster AS (SELECT concat('T', c_custkey % 2) AS tile, CAST(c_custkey % 60 AS INT) AS xpix, CAST(floor(c_custkey/60) % 25 AS INT) AS ypix, bit_or(CAST(pow(2, c_custkey % 10) AS INT)) AS value FROM customer GROUP BY 1, 2, 3) "
    "SELECT TRUE_ID, CAST(CASE WHEN floor(RA/4) < 60 AND floor((DEC + 60)/3) < 25 THEN coalesce(a.value, 0) | coalesce(b.value, 0) ELSE 8192 END AS BIGINT) AS mask, count(*) AS n FROM detections_v d LEFT JOIN raster a ON a.tile = 'T0' AND a.xpix = floor(RA/4) "
    "AND a.ypix = floor((DEC + 60)/3) LEFT JOIN raster b ON b.tile = 'T1' AND b.xpix = floor(RA/4) AND b.ypix = floor((DEC + 60)/3) GROUP BY 1, 2", "detections_v",
)

TILES = {"tile": "s_suppkey", "ra0": views.BASE_RA.format(k="s_suppkey"), "dec0": views.BASE_DEC.format(k="s_suppkey"), "scale": "5e-1", "x0": "525e-2", "y0": "475e-2",
         "xmin": "5e-1", "xmax": "95e-1", "ymin": "1e0", "ymax": "9e0"}
RASTER = {"tile": "1 + c_custkey % 10", "xpix": "cast(floor(c_custkey/10) % 10 as int)", "ypix": "cast(floor(c_custkey/100) % 10 as int)", "value": "cast(pow(2, c_custkey % 12) as int)"}


def mask_tiles(spark, sf):
    """Mask bits from positions alone: covering tiles by sky cells, tangent plane, raster."""
    tiles = views.table(spark, sf, "supplier").selectExpr(*[f"{e} AS {n}" for n, e in TILES.items()])
    raster = views.table(spark, sf, "customer").selectExpr(*[f"{e} AS {n}" for n, e in RASTER.items()]).groupBy("tile", "xpix", "ypix").agg(F.bit_or("value").alias("value"))
    df = views.detections(spark, sf)
    out = masks.mask_values(df, raster, masks.tile_coordinates(df, tiles, "det_id"), "det_id")
    return out.groupBy("TRUE_ID", F.col("mask").cast("long").alias("mask")).agg(F.count(F.lit(1)).alias("n"))


MASK_TILES_SQL = oracle(
    f"""
    , tiles AS (SELECT {", ".join(f"{e} AS {n}" for n, e in TILES.items())} FROM supplier
    ), raster AS (
        SELECT tile, xpix, ypix, bit_or(value) AS value FROM (SELECT {", ".join(f"{e} AS {n}" for n, e in RASTER.items())} FROM customer) GROUP BY ALL
    ), d AS (
        SELECT *, row_number() OVER () AS id, radians(RA) AS r, radians(DEC) AS p FROM detections_v
    ), plane AS (
        SELECT id, tile, scale, x0, y0, xmin, xmax, ymin, ymax, cos(p)*sin(r - radians(ra0)) AS a,
               cos(radians(dec0))*sin(p) - sin(radians(dec0))*cos(p)*cos(r - radians(ra0)) AS b,
               sin(radians(dec0))*sin(p) + cos(radians(dec0))*cos(p)*cos(r - radians(ra0)) AS c
        FROM d JOIN tiles ON abs(DEC - dec0) < 15
    ), placed AS (
        SELECT id, tile, x0 - degrees(a/c)/scale AS x, y0 + degrees(b/c)/scale AS y, xmin, xmax, ymin, ymax FROM plane WHERE c > 0
    ), hits AS (
        SELECT id, bit_or(coalesce(value, 0)) AS bits
        FROM placed LEFT JOIN raster ON raster.tile = placed.tile AND xpix = CAST(floor(x) AS INT) AND ypix = CAST(floor(y) AS INT)
        WHERE x > xmin AND x < xmax AND y > ymin AND y < ymax GROUP BY id
    )
    SELECT TRUE_ID, CAST(coalesce(bits, 8192) AS BIGINT) AS mask, count(*) AS n FROM d LEFT JOIN hits USING (id) GROUP BY 1, 2
    """, "detections_v",
)

QUERIES = {
    "healpix_index": (healpix_index, HEALPIX_SQL),
    "healpix_nested": (healpix_nested, NESTED_SQL),
    "footprint_counts": (footprint_counts, FOOTPRINT_SQL),
    "density": (density, DENSITY_SQL),
    "log_density": (log_density, LOG_DENSITY_SQL),
    "teff_map": (teff_map, TEFF_MAP_SQL),
    "depth_map": (depth_map, DEPTH_SQL),
    "depth_map_auto": (depth_map_auto, DEPTH_AUTO_SQL),
    "sparse_depth": (sparse_depth, SPARSE_DEPTH_SQL),
    "ebv_interp": (ebv_interp, EBV_SQL),
    "disc_footprint": (disc_footprint, DISC_SQL),
    "astrom_external": (astrom_external, EXTERNAL_SQL),
    "astrom_internal": (astrom_internal, INTERNAL_SQL),
    "gaia_offsets": (gaia_offsets, GAIA_OFFSETS_SQL),
    "gaia_shifted": (gaia_shifted, GAIA_SHIFTED_SQL),
    "photom_offsets": (photom_offsets, PHOTOM_SQL),
    "rms_map_weighted": (rms_map_weighted, RMS_SQL),
    "rms_map_detections": (rms_map_detections, RMS_DET_SQL),
    "zp_diff_maps": (zp_diff_maps, ZP_DIFF_SQL),
    "colour_locus": (colour_locus, LOCUS_SQL),
    "release_residuals": (release_residuals, RESIDUAL_SQL),
    "mask_lookup": (mask_lookup, MASK_SQL),
    "mask_tiles": (mask_tiles, MASK_TILES_SQL),
}
