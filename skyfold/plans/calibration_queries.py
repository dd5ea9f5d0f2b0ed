"""Zeropoints, exposures and calibration."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyfold.operators import calibration, survey, zeropoints
from skyfold.plans import views
from skyfold.plans.column_queries import NORTH, ROW_SQL, SOUTH, _interp_sql, _linear_sql, _rows, _sep_sql
from skyfold.plans.map_queries import _CENTERS, ring_sql
from skyfold.plans.shared import as_long, calibrated, rounded
from skyfold.plans.views import oracle

CAL = ["MAG_PSF", "MAGERR_PSF", "MAG_AUTO", "MAGERR_AUTO", "MAG_ZERO", "SIGMA_MAG_ZERO"]


def calibrated_mags(spark, sf):
    return rounded(_rows(as_long(calibrated(spark, sf), "ZP_FLAG"), *CAL, "ZP_FLAG"))


def zp_load(spark, sf):
    """A table stored with negative zeropoints is turned before the cuts."""
    flipped = views.zeropoints(spark, sf).withColumn("MAG_ZERO", -F.col("MAG_ZERO"))
    return rounded(zeropoints.load_zeropoints(flipped).select("EXPNUM", "CCDNUM", "MAG_ZERO"))


def blacklist_apply(spark, sf):
    bad = zeropoints.load_blacklist([views.blacklist(spark, sf), zeropoints.bad_ccds(views.detections(spark, sf), 0.9)])
    return zeropoints.without_blacklisted(views.detections(spark, sf), bad).groupBy("EXPNUM", "CCDNUM").agg(F.count(F.lit(1)).alias("n"))


BLACKLIST_SQL = oracle(
    "SELECT EXPNUM, CCDNUM, count(*) AS n FROM detections_v d WHERE NOT EXISTS (SELECT 1 FROM blacklist_v b WHERE b.expnum = d.EXPNUM AND b.ccdnum = d.CCDNUM) "
    "AND (EXPNUM, CCDNUM) NOT IN (SELECT (EXPNUM, CCDNUM) FROM detections_v GROUP BY EXPNUM, CCDNUM HAVING avg(CASE WHEN SPREAD_MODEL < -5e-3 THEN 1 ELSE 0 END) > 9e-1) GROUP BY EXPNUM, CCDNUM",
    "detections_v", "blacklist_v",
)


def bad_ccd(spark, sf):
    return zeropoints.bad_ccds(views.detections(spark, sf), 0.15)


BAD_SQL = oracle("SELECT EXPNUM AS expnum, CCDNUM AS ccdnum FROM detections_v GROUP BY EXPNUM, CCDNUM HAVING avg(CASE WHEN SPREAD_MODEL < -5e-3 THEN 1 ELSE 0 END) > 15e-2", "detections_v")


def mjd_lookup(spark, sf):
    mjd = views.exposures(spark, sf).select(F.col("expnum").alias("EXPNUM"), (F.col("nite") % 10000 + 5e-1).alias("MJD_OBS"), (F.col("exptime") + 1.0).alias("EXPTIME"))
    return rounded(_rows(zeropoints.lookup_exposure(views.detections(spark, sf), mjd), "MJD_OBS", "EXPTIME"))


MJD_SQL = oracle(
    f"SELECT {ROW_SQL.replace('EXPNUM', 'd.EXPNUM', 1)}, round(e.nite % 10000 + 5e-1, 6) AS MJD_OBS, round(e.exptime + 1, 6) AS EXPTIME FROM detections_v d JOIN exposures_v e ON d.EXPNUM = e.expnum",
    "detections_v", "exposures_v",
)


def tag_update(spark, sf):
    df = views.detections(spark, sf).withColumn("TAG", F.lit("OLD"))
    listed = views.exposures(spark, sf).where("tag <> 'TAG_P'").select(F.col("expnum").alias("EXPNUM"), F.col("tag").alias("TAG"))
    return zeropoints.update_from_exposures(df, listed).groupBy("EXPNUM", "TAG").agg(F.count(F.lit(1)).alias("n"))


TAG_SQL = oracle(
    "SELECT d.EXPNUM, CASE WHEN e.tag <> 'TAG_P' THEN e.tag ELSE 'OLD' END AS TAG, count(*) AS n FROM detections_v d JOIN exposures_v e ON d.EXPNUM = e.expnum GROUP BY 1, 2", "detections_v", "exposures_v",
)


def _second(spark, sf):
    shift = {"MAG_ZERO": F.col("MAG_ZERO") - (F.col("CCDNUM") % 9) / 1e3, "RA": F.col("RA") + 1e-3, "DEC": F.col("DEC") - 1e-3}
    return views.zeropoints(spark, sf).withColumns(shift)


def zp_pairs(spark, sf):
    pairs = zeropoints.zeropoint_pairs(views.zeropoints(spark, sf), _second(spark, sf))
    return rounded(pairs.select("EXPNUM", "CCDNUM", "BAND", "dzero", (F.col("sep") * 3600.0).alias("sep_arcsec")))


PAIRS_SQL = oracle(f"SELECT EXPNUM, CCDNUM, BAND, round((CCDNUM % 9)/1e3, 6) AS dzero, round(3600*{_sep_sql('RA', 'DEC', '(RA + 1e-3)', '(DEC - 1e-3)')}, 6) AS sep_arcsec FROM zeropoints_v", "zeropoints_v")


def zp_unpaired(spark, sf):
    return zeropoints.unpaired_zeropoints(views.zeropoints(spark, sf), views.zeropoints(spark, sf).where("CCDNUM % 5 <> 0"))


UNPAIRED_SQL = oracle("SELECT EXPNUM, CCDNUM, CAST(1 AS BIGINT) AS n_1, CAST(0 AS BIGINT) AS n_2 FROM zeropoints_v WHERE CCDNUM % 5 = 0", "zeropoints_v")


def constant_zp(spark, sf):
    df = zeropoints.constant_zeropoints(views.exposures(spark, sf))
    return df.groupBy("EXPNUM", "BAND").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("CCDNUM").cast("long")).alias("ccds"), F.round(F.max("MAG_ZERO"), 6).alias("zero"), F.round(F.max("RA_MEAN"), 7).alias("ra"))


CONSTANT_SQL = oracle(
    "SELECT expnum AS EXPNUM, band AS BAND, CAST(62 AS BIGINT) AS n, CAST(1953 AS BIGINT) AS ccds, CASE band WHEN 'i' THEN 30e0 WHEN 'z' THEN 2967e-2 ELSE 1e0 END AS zero, round(telra, 7) AS ra FROM exposures_v", "exposures_v",
)


def reference_match(spark, sf):
    det, ref = views.detections(spark, sf).select("det_id", "RA", "DEC"), views.reference(spark, sf).select("OBJID", "RA", "DEC", "G")
    merged = calibration.merge_reference(det, ref, "det_id", "OBJID", 1.0)
    return rounded(merged.select("OBJID", (F.col("sep") * 3600.0).alias("sep_arcsec"), "G"))


NEAREST_DET_SQL = oracle(
    f"SELECT OBJID, round(3600*min(s), 6) AS sep_arcsec, round(any_value(G), 6) AS G FROM (SELECT r.OBJID, r.G, {_sep_sql('r.RA', 'r.DEC', 'd.RA', 'd.DEC')} AS s FROM reference_v r JOIN detections_v d ON d.TRUE_ID = r.OBJID) GROUP BY OBJID",
    "reference_v", "detections_v",
)


def _merged(spark, sf):
    """Every detection with its own reference row; ten groups of CCDs per band keep the clip groups large."""
    ref = views.reference(spark, sf).drop("RA", "DEC")
    df = views.detections(spark, sf).join(ref, F.col("TRUE_ID") == F.col("OBJID"))
    return df.withColumn("EXPNUM", F.col("EXPNUM") % 50)


def standard_mags(spark, sf):
    df = calibration.add_standard_mag(_merged(spark, sf))
    return rounded(df.groupBy("EXPNUM", "BAND").agg(F.count_if("STD_OK").alias("n_ok"), F.avg("MAG_STD").alias("mean_mag"), F.avg("MAGERR_STD").alias("mean_err")))


_STD = "CASE BAND " + " ".join(f"WHEN '{b}' THEN {_linear_sql('refcat', b)[0]}" for b in "grizY") + " END"
_OK = "CASE BAND " + " ".join(f"WHEN '{b}' THEN {_linear_sql('refcat', b)[1]}" for b in "grizY") + " END"
_ERR = "CASE BAND " + " ".join(f"WHEN '{b}' THEN {'DZ' if b == 'Y' else 'D' + b.upper()}" for b in "grizY") + " END"
STD_SQL = oracle(f"SELECT EXPNUM % 50 AS EXPNUM, BAND, count(*) FILTER (WHERE {_OK}) AS n_ok, round(avg({_STD}), 6) AS mean_mag, round(avg({_ERR}), 6) AS mean_err FROM merged_v GROUP BY 1, 2", "merged_v")


def transform_comparison(spark, sf):
    tables = {b: (NORTH, SOUTH) for b in "griz"}
    df = calibration.compare_transforms(_merged(spark, sf).where(F.col("BAND") != "Y"), tables)
    return rounded(df.groupBy("BAND").agg(F.count_if("OK_LINEAR").alias("n_linear"), F.count_if("OK_INTERP").alias("n_interp"), F.avg("MAG_DELTA").alias("mean_delta")))


def _interp_parts(b):
    mag, ok = _interp_sql(b).rsplit(f" AS mag_{b}, ", 1)
    return mag.removeprefix("round(").removesuffix(", 6)"), ok.removesuffix(f" AS ok_{b}")


COMPARE_SQL = oracle(
    "SELECT BAND, count(*) FILTER (WHERE ok_l) AS n_linear, count(*) FILTER (WHERE ok_i) AS n_interp, round(avg(lin - itp), 6) AS mean_delta FROM (SELECT BAND, "
    + "CASE BAND " + " ".join(f"WHEN '{b}' THEN {_linear_sql('refcat', b)[0]}" for b in "griz") + " END AS lin, CASE BAND " + " ".join(f"WHEN '{b}' THEN {_linear_sql('refcat', b)[1]}" for b in "griz")
    + " END AS ok_l, CASE BAND " + " ".join(f"WHEN '{b}' THEN {_interp_parts(b)[0]}" for b in "griz") + " END AS itp, CASE BAND " + " ".join(f"WHEN '{b}' THEN {_interp_parts(b)[1]}" for b in "griz")
    + " END AS ok_i FROM merged_v WHERE BAND <> 'Y') GROUP BY BAND", "merged_v",
)


def clipped_groups(spark, sf):
    df = views.detections(spark, sf).withColumn("v", F.pow(F.col("FLUX_PSF") / 1e4, F.lit(3.0)))
    kept = calibration.clip_groups(df, ["TRUE_ID"], "v", sigmas=1.8)
    return rounded(kept.groupBy("TRUE_ID").agg(F.count(F.lit(1)).alias("n"), F.avg("v").alias("mean")))


def _clip_sql(source, keys, value, sigmas, removals):
    """Nested selects, one per removal."""
    for k in range(removals):
        source = f"SELECT * EXCLUDE (cm, cs) FROM (SELECT *, avg({value}) OVER w AS cm, stddev_samp({value}) OVER w AS cs FROM ({source}) WINDOW w AS (PARTITION BY {keys})) WHERE cs IS NULL OR NOT abs({value} - cm) > {sigmas}*cs"
    return source


CLIP_SQL = oracle(
    "SELECT TRUE_ID, count(*) AS n, round(avg(v), 6) AS mean FROM (" + _clip_sql("SELECT *, pow(FLUX_PSF/1e4, 3e0) AS v FROM detections_v", "TRUE_ID", "v", "18e-1", 2) + ") GROUP BY TRUE_ID", "detections_v",
)


def derive_zeropoints(spark, sf):
    merged = _merged(spark, sf).drop("FILENAME", "T_EFF").withColumns({"CCDNUM": F.col("CCDNUM") % 5})
    out = calibration.derive_zeropoints(merged)
    return as_long(rounded(out), "MAG_ZERO_NUM")


_DIFF = (
    f"SELECT * FROM (SELECT *, median(MAG_DIFF) OVER (PARTITION BY EXPNUM) AS centre FROM (SELECT * REPLACE (EXPNUM % 50 AS EXPNUM, CCDNUM % 5 AS CCDNUM), {_STD} + 25e-1*log10(FLUX_PSF) AS MAG_DIFF FROM merged_v "
    f"WHERE {_OK} AND {_STD} >= 0 AND {_STD} <= 25 AND FLUX_PSF > 10 AND FLAGS < 2 AND abs(SPREAD_MODEL) < 1e-2 AND FLUX_PSF/FLUXERR_PSF > 10)) WHERE MAG_DIFF - centre > -5 AND MAG_DIFF - centre < 5"
)
DERIVE_SQL = oracle(
    "SELECT EXPNUM, CCDNUM, BAND, EXPTIME, round(median(MAG_DIFF), 6) AS MAG_ZERO_MEDIAN, round(avg(MAG_DIFF), 6) AS MAG_ZERO_MEAN, round(stddev_samp(MAG_DIFF), 6) AS MAG_ZERO_STD, "
    "round(stddev_samp(MAG_DIFF)/nullif(sqrt(count(*) - 1), 0), 6) AS MAG_ZERO_MEAN_ERR, count(*) AS MAG_ZERO_NUM FROM (" + _clip_sql(_DIFF, "EXPNUM, CCDNUM", "MAG_DIFF", "3", 2) + ") GROUP BY EXPNUM, CCDNUM, BAND, EXPTIME",
    "merged_v",
)


TILE = f"cast(floor(({views.BASE_RA.format(k='TRUE_ID')})/36)*3 + floor(({views.BASE_DEC.format(k='TRUE_ID')} + 60)/30) as bigint)"


def calibrate_exposures(spark, sf):
    """Matching of whole exposures at once: one exposure per sky tile, reference rows from the cone around its centre."""
    det = views.detections(spark, sf).withColumns({"EXPNUM": F.expr(TILE)}).select("det_id", "EXPNUM", "RA", "DEC")
    exp = det.select("EXPNUM").distinct().selectExpr("EXPNUM", "floor(EXPNUM/3)*36 + 18e0 AS TELRA", "(EXPNUM % 3)*30 - 45e0 AS TELDEC")
    ref = views.reference(spark, sf).select("OBJID", "RA", "DEC", "G")
    merged = calibration.merge_reference_by_exposure(det, ref, exp, "det_id", "OBJID", 1.0, cone_deg=24.0, nside=8)
    return rounded(merged.groupBy("EXPNUM").agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("sep") * 3600.0).alias("mean_sep"), F.max("G").alias("G")))


CALIBRATE_SQL = oracle(
    f"SELECT EXPNUM, count(*) AS n, round(avg(s*3600), 6) AS mean_sep, round(max(G), 6) AS G FROM (SELECT r.OBJID, {TILE} AS EXPNUM, r.G, min({_sep_sql('r.RA', 'r.DEC', 'd.RA', 'd.DEC')}) AS s FROM reference_v r JOIN detections_v d "
    "ON d.TRUE_ID = r.OBJID GROUP BY 1, 2, 3) GROUP BY EXPNUM", "reference_v", "detections_v",
)


def calibrate_whole(spark, sf):
    """From detections to zeropoints: selection, match in the cones of 90 exposures, transforms, clipped statistics."""
    det = views.detections(spark, sf).withColumns({"EXPNUM": F.expr(TILE), "CCDNUM": F.expr("1 + CCDNUM % 2")}).drop("TRUE_ID", "FILENAME", "T_EFF")
    exp = det.select("EXPNUM").distinct().selectExpr("EXPNUM", "floor(EXPNUM/3)*36 + 18e0 AS TELRA", "(EXPNUM % 3)*30 - 45e0 AS TELDEC")
    good = F.col("FLAGS") < 4
    out = calibration.calibrate(det, views.reference(spark, sf), exp, "det_id", "OBJID", good, arcsec=0.5, cone_deg=12.0)
    return as_long(rounded(out), "MAG_ZERO_NUM")


# The nearest detection of each reference row in its tile, for rows whose pixel may touch the cone: the pixel's centre is
# no further than the cone's radius and the largest distance of a centre and a corner.
_CALIBRATE_MERGED = f"""
    SELECT * FROM (
        SELECT r.* EXCLUDE (RA, DEC), d.*, {TILE} AS tile, {_sep_sql('r.RA', 'r.DEC', 'd.RA', 'd.DEC')} AS sep
        FROM (SELECT *, {ring_sql(32, 'RA', 'DEC')} AS hpx FROM reference_v) r JOIN detections_v d ON d.TRUE_ID = r.OBJID
        WHERE d.FLAGS < 4
    ) m
    WHERE sep*3600 < 5e-1 AND EXISTS (
        SELECT 1 FROM centers c
        WHERE c.pix = m.hpx AND {_sep_sql('(floor(m.tile/3)*36 + 18e0)', '((m.tile % 3)*30 - 45e0)', 'c.lon', 'c.lat')} <= 12 + 1.9026018600115095)
    QUALIFY row_number() OVER (PARTITION BY tile, OBJID ORDER BY sep, l_partkey, l_orderkey, l_linenumber, l_suppkey, l_shipdate) = 1
"""
_CALIBRATE_DIFF = f"""
    SELECT *, median(MAG_DIFF) OVER (PARTITION BY EXPNUM) AS centre FROM (
        SELECT tile AS EXPNUM, 1 + CCDNUM % 2 AS CCDNUM, BAND, EXPTIME, {_STD} + 25e-1*log10(FLUX_PSF) AS MAG_DIFF
        FROM ({_CALIBRATE_MERGED})
        WHERE {_OK} AND {_STD} >= 0 AND {_STD} <= 25 AND FLUX_PSF > 10 AND FLAGS < 2 AND abs(SPREAD_MODEL) < 1e-2
          AND FLUX_PSF/FLUXERR_PSF > 10)
"""
CALIBRATE_WHOLE_SQL = oracle(
    f"""
    , centers AS ({_CENTERS})
    SELECT EXPNUM, CCDNUM, BAND, EXPTIME, round(median(MAG_DIFF), 6) AS MAG_ZERO_MEDIAN, round(avg(MAG_DIFF), 6) AS MAG_ZERO_MEAN,
           round(stddev_samp(MAG_DIFF), 6) AS MAG_ZERO_STD, round(stddev_samp(MAG_DIFF)/nullif(sqrt(count(*) - 1), 0), 6) AS MAG_ZERO_MEAN_ERR,
           count(*) AS MAG_ZERO_NUM
    FROM ({_clip_sql(f"SELECT * FROM ({_CALIBRATE_DIFF}) WHERE abs(MAG_DIFF - centre) < 5", "EXPNUM, CCDNUM", "MAG_DIFF", "3", 2)})
    GROUP BY EXPNUM, CCDNUM, BAND, EXPTIME
    """.strip(), "reference_v", "detections_v",
)


def teff_nearest(spark, sf):
    return survey.closest_exposure(views.exposures(spark, sf))


TEFF_SQL = oracle("SELECT tag, band, arg_min(expnum, (abs(t_eff - 2), expnum)) AS expnum FROM exposures_v GROUP BY tag, band", "exposures_v")


def exposure_mags(spark, sf):
    df = survey.exposure_magnitudes(views.detections(spark, sf), views.zeropoints(spark, sf).withColumn("MAG_ZERO", F.col("MAG_ZERO") + F.col("CCDNUM") / 1e3))
    return rounded(_rows(df, "EXP_ZERO", "EXP_MAG_PSF", "EXP_MAGERR_PSF"))


EXPOSURE_MAGS_SQL = oracle(
    f"SELECT {ROW_SQL.replace('EXPNUM', 'd.EXPNUM', 1)}, round(zero, 6) AS EXP_ZERO, round(-25e-1*log10(FLUX_PSF) + zero, 6) AS EXP_MAG_PSF, round(25e-1/ln(10e0)*FLUXERR_PSF/FLUX_PSF, 6) AS EXP_MAGERR_PSF "
    "FROM detections_v d JOIN (SELECT EXPNUM, median(MAG_ZERO + CCDNUM/1e3) AS zero FROM zeropoints_v GROUP BY EXPNUM) z ON d.EXPNUM = z.EXPNUM", "detections_v", "zeropoints_v",
)


def topk_exposures(spark, sf):
    return survey.largest_exposures(views.detections(spark, sf), 5)


def homogenize(spark, sf):
    out = survey.homogenize(views.exposures(spark, sf).withColumn("t_eff", F.col("t_eff") * 2), nside=32, radius_deg=3.0, num_threshold=3)
    return out.groupBy("mode", "band", "accepted").agg(F.count(F.lit(1)).alias("n"))


def max_depth(spark, sf):
    return rounded(survey.max_depth_map(views.exposures(spark, sf), nside=32, radius_deg=3.0).groupBy("band").agg(F.count(F.lit(1)).alias("n_pix"), F.max("max_depth").alias("deepest"), F.avg("max_depth").alias("mean")))


MAX_DEPTH_SQL = oracle(
    f"""
    SELECT band, count(*) AS n_pix, round(max(d), 6) AS deepest, round(avg(d), 6) AS mean FROM (
        SELECT band, pix, max(t_eff*exptime) AS d FROM exposures_v e JOIN ({_CENTERS}) c
            ON c.lat BETWEEN e.teldec - 3001e-3 AND e.teldec + 3001e-3 AND {_sep_sql('e.telra', 'e.teldec', 'c.lon', 'c.lat')} <= 3
        GROUP BY band, pix
    ) GROUP BY band
    """, "exposures_v",
)

QUERIES = {
    "calibrated_mags": (calibrated_mags, oracle(f"SELECT {ROW_SQL}, " + ", ".join(f"round({c}, 6) AS {c}" for c in CAL) + ", CAST(ZP_FLAG AS BIGINT) AS ZP_FLAG FROM calibrated_v", "calibrated_v")),
    "zp_load": (zp_load, oracle("SELECT EXPNUM, CCDNUM, round(MAG_ZERO, 6) AS MAG_ZERO FROM zeropoints_v WHERE ZP_FLAG = 0", "zeropoints_v")),
    "blacklist_apply": (blacklist_apply, BLACKLIST_SQL),
    "bad_ccd": (bad_ccd, BAD_SQL),
    "mjd_lookup": (mjd_lookup, MJD_SQL),
    "tag_update": (tag_update, TAG_SQL),
    "zp_pairs": (zp_pairs, PAIRS_SQL),
    "zp_unpaired": (zp_unpaired, UNPAIRED_SQL),
    "constant_zp": (constant_zp, CONSTANT_SQL),
    "reference_match": (reference_match, NEAREST_DET_SQL),
    "standard_mags": (standard_mags, STD_SQL),
    "transform_comparison": (transform_comparison, COMPARE_SQL),
    "clipped_groups": (clipped_groups, CLIP_SQL),
    "derive_zeropoints": (derive_zeropoints, DERIVE_SQL),
    "calibrate_exposures": (calibrate_exposures, CALIBRATE_SQL),
    "calibrate_whole": (calibrate_whole, CALIBRATE_WHOLE_SQL),
    "teff_nearest": (teff_nearest, TEFF_SQL),
    "exposure_mags": (exposure_mags, EXPOSURE_MAGS_SQL),
    "topk_exposures": (topk_exposures, oracle("SELECT EXPNUM, count(*) AS n FROM detections_v GROUP BY EXPNUM ORDER BY n DESC, EXPNUM LIMIT 5", "detections_v")),
    "homogenize": (homogenize, None),
    "max_depth": (max_depth, MAX_DEPTH_SQL),
}
