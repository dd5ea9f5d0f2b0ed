"""Archive queries on stand-in tables made from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyfold.plans import views
from skyfold.plans.map_queries import nested_sql
from skyfold.plans.shared import objects, rounded
from skyfold.plans.views import oracle
from skyfold.sources import archive

TAG = "TAG_F"
EXPOSURE_TABLES = ("firstcut_eval", "finalcut_eval", "qa_summary", "proctag", "ops_proctag", "pfw_attempt", "eval")


def tables(spark, sf):
    """Archive tables under their column names."""
    det = views.detections(spark, sf)
    exp = views.exposures(spark, sf)
    base = exp.select(
        F.col("attempt").alias("PFW_ATTEMPT_ID"), F.col("attempt").alias("ID"), F.col("unitname").alias("UNITNAME"), F.lit(1).alias("REQNUM"), F.lit(1).alias("ATTNUM"), F.col("expnum").alias("EXPNUM"),
        F.col("expnum").alias("EXPOSUREID"), F.col("t_eff").alias("T_EFF"), F.col("flag").alias("FLAG"), F.col("skytilt").alias("SKYTILT"), F.col("accepted").alias("ACCEPTED"), F.col("program").alias("PROGRAM"), F.col("tag").alias("TAG"),
    )
    exposure = exp.select(
        F.col("expnum").alias("EXPNUM"), F.col("expnum").alias("ID"), F.col("telra").alias("TRADEG"), F.col("teldec").alias("TDECDEG"), F.col("telra").alias("TELRA"), F.col("teldec").alias("TELDEC"), F.col("telra").alias("RADEG"),
        F.col("teldec").alias("DECDEG"), F.col("nite").alias("NITE"), F.col("band").alias("BAND"), F.col("exptime").alias("EXPTIME"), F.col("program").alias("PROGRAM"), F.col("propid").alias("PROPID"), F.col("obstype").alias("OBSTYPE"),
        (F.col("nite") % 10000 + 5e-1).alias("MJD_OBS"),
    )
    files = det.select("FILENAME", "EXPNUM", "CCDNUM").distinct().select("FILENAME", "CCDNUM", (F.col("EXPNUM") * 10 + 1).alias("PFW_ATTEMPT_ID"))
    images = det.select("EXPNUM", "CCDNUM", "BAND").distinct().select(
        "EXPNUM", "BAND", F.col("EXPNUM").alias("EXPOSUREID"), F.col("CCDNUM").alias("CCD"), F.col("CCDNUM"), (F.col("EXPNUM") * 100 + F.col("CCDNUM")).alias("ID"), (F.col("EXPNUM") * 2e-3).alias("RA_CENT"), (F.col("CCDNUM") * 1e0).alias("DEC_CENT"),
        F.when(F.col("CCDNUM") % 9 != 0, F.lit(30.0) + F.col("CCDNUM") / 1e3).alias("ZEROPOINT"), F.lit(0.01).alias("SIGMA_ZEROPOINT"), F.lit(1.0).alias("RA"), F.lit(2.0).alias("DEC"),
    )
    mags = det.withColumns(
        {
            "MAG_PSF": F.expr("30e0 - 25e-1*log10(FLUX_PSF)"), "MAGERR_PSF": F.expr("FLUXERR_PSF/FLUX_PSF*11e-1"), "MAG_AUTO": F.expr("30e0 - 25e-1*log10(FLUX_AUTO)"), "MAGERR_AUTO": F.expr("FLUXERR_AUTO/FLUX_AUTO*11e-1"),
            "IMAGEID": F.col("EXPNUM") * 100 + F.col("CCDNUM"), "OBJECT_ID": F.col("OBJECT_NUMBER"), "COADD_OBJECTS_ID": F.col("TRUE_ID"), "X_IMAGE": F.col("XWIN_IMAGE"), "Y_IMAGE": F.col("YWIN_IMAGE"),
        }
    )
    zp = views.zeropoints(spark, sf)
    solution = zp.select(
        "EXPNUM", "CCDNUM", F.col("CCDNUM").alias("CCD"), "BAND", F.col("RA").alias("RA_MEAN"), F.col("DEC").alias("DEC_MEAN"), F.col("RA").alias("RA_CENT"), F.col("DEC").alias("DEC_CENT"), "MAG_ZERO", "SIGMA_MAG_ZERO",
        F.col("SIGMA_MAG_ZERO").alias("STD_MAG_ZERO"), F.col("ZP_FLAG").alias("QSLR_FLAG"), F.col("MAG_ZERO").alias("FGCM_ZPT"), F.col("SIGMA_MAG_ZERO").alias("FGCM_ZPTERR"), (F.col("EXPNUM") % 32).alias("FGCM_FLAG"), (F.col("EXPNUM") % 5 - 1).alias("FLAG"),
    )
    out = {name: base for name in EXPOSURE_TABLES}
    out |= {
        "exposure": exposure, "catalog": files, "image": images, "se_object": det.drop("EXPNUM", "CCDNUM", "T_EFF", "MJD_OBS", "EXPTIME").withColumns({"X_IMAGE": F.col("XWIN_IMAGE"), "Y_IMAGE": F.col("YWIN_IMAGE")}), "objects": mags,
        "zeropoints": solution, "zeropoint": solution, "blacklist": views.blacklist(spark, sf).select(F.col("expnum").alias("EXPNUM"), F.col("ccdnum").alias("CCDNUM")),
    }
    out["finalcut_object"] = out["se_object"]
    return out


OBJ = ["FILENAME", "EXPNUM", "CCDNUM", "BAND", "T_EFF", "FLAGS", "OBJECT_NUMBER", "RA", "DEC", "FLUX_PSF", "FLUXERR_PSF"]
_MEASURED = "FLUX_PSF > 0 AND FLUX_AUTO > 0 AND FLAGS < 4 AND 10857362e-7*(FLUXERR_PSF/FLUX_PSF) < 5e-1"
_CLEAN = _MEASURED + " AND (IMAFLAGS_ISO IS NULL OR (IMAFLAGS_ISO & 2047) = 0)"


def _objects(df, *extra):
    ints = {"CCDNUM", "FLAGS", "OBJECT_NUMBER", "EXPNUM"}
    return rounded(df.select(*[F.col(c).cast("long").alias(c) if c in ints else F.col(c) for c in OBJ], *extra), digits=7)


_OBJ_SQL = (
    "FILENAME, d.EXPNUM, CCDNUM, BAND, round(e.t_eff, 7) AS T_EFF, CAST(FLAGS AS BIGINT) AS FLAGS, CAST(OBJECT_NUMBER AS BIGINT) AS OBJECT_NUMBER, round(RA, 7) AS RA, round(DEC, 7) AS DEC, round(FLUX_PSF, 7) AS FLUX_PSF, round(FLUXERR_PSF, 7) AS FLUXERR_PSF"
)
_OBJ_FROM = "FROM detections_v d JOIN exposures_v e ON d.EXPNUM = e.expnum"


def first_year_objects(spark, sf):
    df = archive.first_year_objects(tables(spark, sf), None, "Y")
    return rounded(df.groupBy("FILENAME", "UNITNAME", "EXPNUM", "CCDNUM", "BAND").agg(F.count(F.lit(1)).alias("n"), F.sum("FLUX_PSF").alias("flux"), F.sum("FLUXERR_PSF").alias("fluxerr"), F.max("T_EFF").alias("t_eff")), digits=4)


FIRST_YEAR_SQL = oracle(
    "SELECT concat('D00', d.EXPNUM, '_', d.BAND, '_c', CCDNUM, '_fake.fits') AS FILENAME, concat('D00', d.EXPNUM) AS UNITNAME, d.EXPNUM, CCDNUM, d.BAND AS BAND, count(*) AS n, round(sum(pow(10e0, (30 - 25e-1*log10(FLUX_PSF) - 25)/(-25e-1))), 4) AS flux, "
    "round(sum(pow(10e0, (30 - 25e-1*log10(FLUX_PSF) - 25)/(-25e-1))*(FLUXERR_PSF/FLUX_PSF*11e-1)/10857362e-7), 4) AS fluxerr, round(max(e.t_eff), 4) AS t_eff "
    f"{_OBJ_FROM} WHERE FLAGS < 4 AND FLUXERR_PSF/FLUX_PSF*11e-1 < 5e-1 GROUP BY d.EXPNUM, CCDNUM, d.BAND", "detections_v", "exposures_v",
)


def single_epoch_objects(spark, sf):
    return _objects(archive.single_epoch_objects(tables(spark, sf), None, 1, 1, "N"))


def tagged_unit_objects(spark, sf):
    return _objects(archive.tagged_unit_objects(tables(spark, sf), None, 1, 1, TAG))


def attempt_objects(spark, sf):
    return _objects(archive.attempt_objects(tables(spark, sf), None, TAG), "PFW_ATTEMPT_ID")


def unit_objects(spark, sf):
    return _objects(archive.unit_objects(tables(spark, sf), None, 1, 1, TAG), "UNITNAME")


def release_objects(spark, sf):
    return _objects(archive.release_objects(tables(spark, sf), None, TAG), "MJD_OBS", "EXPTIME")


def finalcut_objects(spark, sf):
    df = archive.finalcut_objects(tables(spark, sf), "g")
    return rounded(df.groupBy("COADD_OBJECTS_ID").agg(F.count(F.lit(1)).alias("n"), F.avg("MAG_PSF").alias("mag"), F.max("MAGERR_AUTO").alias("err")))


def coadd_stars(spark, sf):
    cat = objects(spark, sf)
    named = cat.select(
        F.col("TRUE_ID").alias("coadd_objects_id"), F.col("RA").alias("ra"), F.col("DEC").alias("dec"), F.col("WAVG_SPREAD_MODEL_R").alias("wavg_spread_model_r"), *[F.col(f"WAVG_MAG_PSF_{b.upper()}").alias(f"wavgcalib_mag_psf_{b}") for b in "grizy"],
        *[F.lit(0.05).alias(f"xcorr_sfd98_{b}") for b in "grizy"], *[F.col(f"WAVG_MAGERR_PSF_{b.upper()}").alias(f"wavg_magerr_psf_{b}") for b in "grizy"],
    )
    return rounded(archive.coadd_stars({"coadd_objects": named}), digits=7)


STARS_SQL = oracle(
    "SELECT TRUE_ID AS coadd_objects_id, round(RA, 7) AS ra, round(DEC, 7) AS dec, " + ", ".join(f"round(WAVG_MAG_PSF_{b.upper()} - 5e-2, 7) AS wavg_mag_psf_{b}, round(WAVG_MAGERR_PSF_{b.upper()}, 7) AS wavg_magerr_psf_{b}" for b in "grizy")
    + " FROM objects_v WHERE abs(WAVG_SPREAD_MODEL_R) < 2e-3 AND WAVG_MAG_PSF_R - 5e-2 < 23 AND WAVG_MAGERR_PSF_R < 1e-1", "objects_v",
)
EXP = ["EXPNUM", "UNITNAME", "REQNUM", "ATTNUM", "TELRA", "TELDEC", "NITE", "BAND", "T_EFF", "TAG"]


def _exposures(df, *extra):
    return rounded(df.select(*[F.col(c).cast("long").alias(c) if c in ("EXPNUM", "NITE") else F.col(c) for c in EXP], *extra), digits=7)


def _exp_sql(where, tag, unit="unitname", number="'1'", extra=""):
    return oracle(
        f"SELECT expnum AS EXPNUM, {unit} AS UNITNAME, {number} AS REQNUM, {number} AS ATTNUM, round(telra, 7) AS TELRA, round(teldec, 7) AS TELDEC, CAST(nite AS BIGINT) AS NITE, band AS BAND, round(t_eff, 7) AS T_EFF, {tag} AS TAG{extra} FROM exposures_v WHERE {where}",
        "exposures_v",
    )


_D00 = "concat('D00', expnum)"


def first_year_exposures(spark, sf):
    return _exposures(archive.first_year_exposures(tables(spark, sf), "FIRST"))


def firstcut_exposures(spark, sf):
    return _exposures(archive.firstcut_exposures(tables(spark, sf), TAG))


def finalcut_exposures(spark, sf):
    return _exposures(archive.finalcut_exposures(tables(spark, sf), TAG), F.col("FLAG").cast("long").alias("FLAG"))


def older_finalcut_exposures(spark, sf):
    return _exposures(archive.older_finalcut_exposures(tables(spark, sf), TAG))


RANGES = [(100, 900), (4000, 5200), (12000, 14000)]


def followup_exposures(spark, sf):
    return _exposures(archive.followup_exposures(tables(spark, sf), "FOLLOW", RANGES))


def southern_exposures(spark, sf):
    t = tables(spark, sf)
    parts = [_exposures(archive.southern_exposures(t, TAG, v)) for v in ("firstcut", "finalcut", "reprocessed")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def community_exposures(spark, sf):
    return _exposures(archive.community_exposures(tables(spark, sf), TAG, tagged=True), "PFW_ATTEMPT_ID")


_COMMUNITY = "propid <> '2012B-0001' AND band IN ('g', 'r', 'i', 'z') AND exptime >= 30 AND t_eff > 1e-1"
_FLAG = "((flag < 20000 AND flag % 1000 = 0) OR (flag <= 3 AND accepted = 'True'))"


def exposure_union(spark, sf):
    """Three families behind tags; columns that a family lacks are NULL."""
    t = tables(spark, sf)
    routes = {"FIRST": lambda: archive.first_year_exposures(t, "FIRST"), "FINAL": lambda: archive.finalcut_exposures(t, TAG), "FINAL_ALIAS": "FINAL", "COMMUNITY": lambda: archive.community_exposures(t, "COMMUNITY")}
    out = archive.exposure_query(["first", "final", "final_alias", "community"], routes)
    return out.select("EXPNUM", "TAG", F.col("FLAG").cast("long").alias("FLAG"), F.col("PFW_ATTEMPT_ID").cast("string").alias("PFW_ATTEMPT_ID"))


UNION_SQL = oracle(
    f"SELECT expnum AS EXPNUM, 'FIRST' AS TAG, CAST(NULL AS BIGINT) AS FLAG, CAST(NULL AS VARCHAR) AS PFW_ATTEMPT_ID FROM exposures_v WHERE accepted = 'True' AND program = 'survey' UNION ALL SELECT expnum, tag, flag, CAST(attempt AS VARCHAR) FROM exposures_v "
    f"WHERE tag = '{TAG}' AND skytilt < 1e-1 AND {_FLAG} AND exptime BETWEEN 445e-1 AND 905e-1 UNION ALL SELECT expnum, 'COMMUNITY', 0, concat(expnum, '01') FROM exposures_v WHERE {_COMMUNITY}", "exposures_v",
)
ZP_OUT = ["EXPNUM", "CCDNUM", "BAND", "MAG_ZERO", "SIGMA_MAG_ZERO", "ZP_FLAG"]


def zeropoint_solutions(spark, sf):
    """All zeropoint pulls under common names."""
    t = tables(spark, sf)
    pulls = {
        "color_locus": archive.color_locus_zeropoints(t).withColumnRenamed("STD_MAG_ZERO", "SIGMA_MAG_ZERO"), "global": archive.global_zeropoints(t), "global_raw": archive.global_zeropoints(t, raw=True),
        "image": archive.image_zeropoints(t).withColumnsRenamed({"ZEROPOINT": "MAG_ZERO", "SIGMA_ZEROPOINT": "SIGMA_MAG_ZERO"}), "southern": archive.southern_zeropoints(t).withColumnRenamed("STD_MAG_ZERO", "SIGMA_MAG_ZERO"),
        "southern_new": archive.southern_zeropoints(t, reprocessed=True), "community": archive.zeropoint_query(["any", "comm_1"], [("COMM*", lambda: archive.community_zeropoints(t))]), "community_tag": archive.community_zeropoints(t, TAG),
    }
    out = None
    for name, df in pulls.items():
        part = df.groupBy(F.lit(name).alias("pull"), "BAND", F.col("ZP_FLAG").cast("long").alias("ZP_FLAG")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("MAG_ZERO"), 6).alias("zero"), F.round(F.avg("SIGMA_MAG_ZERO"), 6).alias("sigma"))
        out = part if out is None else out.unionByName(part)
    return out


def _pull(name, flag, source="zeropoints_v z", where="TRUE", zero="MAG_ZERO", sigma="SIGMA_MAG_ZERO", band="z.BAND"):
    return f"SELECT '{name}' AS pull, {band} AS BAND, CAST({flag} AS BIGINT) AS ZP_FLAG, count(*) AS n, round(avg({zero}), 6) AS zero, round(avg({sigma}), 6) AS sigma FROM {source} WHERE {where} GROUP BY 1, 2, 3"


_NEG = "CASE WHEN z.EXPNUM % 5 - 1 < 0 THEN 1 ELSE 0 END"
SOLUTIONS_SQL = oracle(
    " UNION ALL ".join([
        _pull("color_locus", "ZP_FLAG"), _pull("global", "CASE WHEN z.EXPNUM % 32 < 16 THEN 0 ELSE 1 END"), _pull("global_raw", "z.EXPNUM % 32"),
        _pull("image", "0", where="CCDNUM % 9 <> 0", zero="30 + CCDNUM/1e3", sigma="1e-2"), _pull("southern", "0"),
        _pull("southern_new", _NEG, "zeropoints_v z JOIN exposures_v e ON z.EXPNUM = e.expnum", "z.BAND IN ('g', 'r') AND propid = '2016A-0366' AND exptime > 59 AND obstype = 'object'"),
        _pull("community", _NEG, where="z.BAND IN ('g', 'r', 'i', 'z')"), _pull("community_tag", _NEG, "zeropoints_v z JOIN exposures_v e ON z.EXPNUM = e.expnum", f"z.BAND IN ('g', 'r', 'i', 'z') AND e.tag = '{TAG}'"),
    ]), "zeropoints_v", "exposures_v",
)


def blacklisted(spark, sf):
    return archive.blacklisted_ccds(tables(spark, sf))


def cone_box(spark, sf):
    """Stars in a coordinate box, over the whole catalog."""
    df = objects(spark, sf).withColumnRenamed("TRUE_ID", "CATALOG_ID")
    return rounded(archive.stars_near(df, 40.0, -34.4, delta=15.0).drop("HPX2048"), digits=7)


BOX_SQL = oracle(
    "SELECT TRUE_ID AS CATALOG_ID, round(RA, 7) AS RA, round(DEC, 7) AS DEC, round(WAVG_MAG_PSF_G, 7) AS WAVG_MAG_PSF_G, round(WAVG_MAG_PSF_R, 7) AS WAVG_MAG_PSF_R, round(WAVG_SPREAD_MODEL_R, 7) AS WAVG_SPREAD_MODEL_R FROM objects_v "
    "WHERE RA BETWEEN 25 AND 55 AND DEC BETWEEN -494e-1 AND -194e-1 AND WAVG_MAG_PSF_G BETWEEN 10 AND 30 AND WAVG_MAG_PSF_R BETWEEN 10 AND 30 AND abs(WAVG_SPREAD_MODEL_R) < 2e-3", "objects_v",
)


def cone_pixel(spark, sf):
    """The same by one nested pixel as a range of the stored index."""
    df = objects(spark, sf).withColumnRenamed("TRUE_ID", "CATALOG_ID")
    return rounded(archive.stars_near(df, 40.0, -34.4, "hpx", nside=2), digits=5)


PIXEL_SQL = oracle(
    f"""
    SELECT TRUE_ID AS CATALOG_ID, round(RA, 5) AS RA, round(DEC, 5) AS DEC, nest AS HPX2048, round(WAVG_MAG_PSF_G, 5) AS WAVG_MAG_PSF_G, round(WAVG_MAG_PSF_R, 5) AS WAVG_MAG_PSF_R,
        round(WAVG_SPREAD_MODEL_R, 5) AS WAVG_SPREAD_MODEL_R
    FROM ({nested_sql(2048, "objects_v")})
    WHERE nest >> 20 = (SELECT nest FROM ({nested_sql(2, "(SELECT 40e0 AS RA, -344e-1 AS DEC)")}))
        AND WAVG_MAG_PSF_G BETWEEN 10 AND 30 AND WAVG_MAG_PSF_R BETWEEN 10 AND 30 AND abs(WAVG_SPREAD_MODEL_R) < 2e-3
    """, "objects_v",
)


def sampled_box(spark, sf):
    df = objects(spark, sf).withColumnRenamed("TRUE_ID", "CATALOG_ID")
    return rounded(archive.sampled_box(df.withColumn("SPREAD_MODEL_R", F.col("SPREAD_MODEL_R") / 2), delta=20.0, fraction=0.5), digits=5)


SAMPLED_SQL = oracle(
    """
    SELECT TRUE_ID AS CATALOG_ID, round(RA, 5) AS RA, round(DEC, 5) AS DEC, round(MAG_PSF_G, 5) AS MAG_PSF_G, round(MAG_PSF_R, 5) AS MAG_PSF_R,
        round(SPREAD_MODEL_R/2, 5) AS SPREAD_MODEL_R
    FROM objects_v
    WHERE ((TRUE_ID % 1000003 + 1)*48271) % 1000003 < 500001 AND RA BETWEEN 20 AND 60 AND DEC BETWEEN -544e-1 AND -144e-1
        AND MAG_PSF_G BETWEEN 15 AND 30 AND MAG_PSF_R BETWEEN 15 AND 30 AND abs(SPREAD_MODEL_R/2) < 1e-2
    """, "objects_v",
)


def edge_extract(spark, sf):
    t = tables(spark, sf)
    a = archive.edge_extract(t, "D%_g_c%_r1p01_%").select("RA", "DEC", "X_IMAGE", "Y_IMAGE")
    b = archive.first_year_edge_extract(t, None).select("RA", "DEC", "X_IMAGE", "Y_IMAGE")
    both = a.withColumn("kind", F.lit("files")).unionByName(b.withColumn("kind", F.lit("year1")))
    return both.groupBy("kind", F.floor(F.col("X_IMAGE") / 64).cast("long").alias("xcell")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("DEC"), 6).alias("dec"), F.sum(F.col("Y_IMAGE").cast("long")).alias("y"))


EDGE_SQL = oracle(
    " UNION ALL ".join(f"SELECT '{k}' AS kind, CAST(floor(XWIN_IMAGE/64) AS BIGINT) AS xcell, count(*) AS n, round(avg(DEC), 6) AS dec, CAST(sum(YWIN_IMAGE) AS BIGINT) AS y FROM detections_v WHERE {w} GROUP BY 1, 2" for k, w in (("files", "BAND = 'g'"), ("year1", "TRUE"))),
    "detections_v",
)

QUERIES = {
    "first_year_objects": (first_year_objects, FIRST_YEAR_SQL),
    "single_epoch_objects": (single_epoch_objects, oracle(f"SELECT {_OBJ_SQL} {_OBJ_FROM} WHERE {_MEASURED} AND XWIN_IMAGE BETWEEN 15 AND 2018 AND YWIN_IMAGE BETWEEN 15 AND 4066".replace(" BAND,", " d.BAND AS BAND,"), "detections_v", "exposures_v")),
    "tagged_unit_objects": (tagged_unit_objects, oracle(f"SELECT {_OBJ_SQL} {_OBJ_FROM} WHERE {_CLEAN} AND e.tag = '{TAG}'".replace(" BAND,", " d.BAND AS BAND,"), "detections_v", "exposures_v")),
    "attempt_objects": (attempt_objects, oracle(f"SELECT {_OBJ_SQL}, e.attempt AS PFW_ATTEMPT_ID {_OBJ_FROM} WHERE {_CLEAN} AND e.tag = '{TAG}'".replace(" BAND,", " d.BAND AS BAND,"), "detections_v", "exposures_v")),
    "unit_objects": (unit_objects, oracle(f"SELECT {_OBJ_SQL}, e.unitname AS UNITNAME {_OBJ_FROM} WHERE {_CLEAN} AND e.tag = '{TAG}'".replace(" BAND,", " d.BAND AS BAND,"), "detections_v", "exposures_v")),
    "release_objects": (release_objects, oracle(f"SELECT {_OBJ_SQL}, round(e.nite % 10000 + 5e-1, 7) AS MJD_OBS, round(e.exptime, 7) AS EXPTIME {_OBJ_FROM} WHERE {_CLEAN} AND e.tag = '{TAG}'".replace(" BAND,", " d.BAND AS BAND,"), "detections_v", "exposures_v")),
    "finalcut_objects": (finalcut_objects, oracle(
        "SELECT TRUE_ID AS COADD_OBJECTS_ID, count(*) AS n, round(avg(30 - 25e-1*log10(FLUX_PSF)), 6) AS mag, round(max(FLUXERR_AUTO/FLUX_AUTO*11e-1), 6) AS err FROM detections_v WHERE FLUXERR_PSF/FLUX_PSF*11e-1 < 1 AND FLUXERR_AUTO/FLUX_AUTO*11e-1 < 1 AND FLAGS < 4 AND BAND = 'g' GROUP BY TRUE_ID", "detections_v")),
    "coadd_stars": (coadd_stars, STARS_SQL),
    "first_year_exposures": (first_year_exposures, _exp_sql("accepted = 'True' AND program = 'survey'", "'FIRST'", _D00, "'-1'")),
    "firstcut_exposures": (firstcut_exposures, _exp_sql(f"accepted = 'True' AND program = 'survey' AND tag = '{TAG}'", f"'{TAG}'")),
    "finalcut_exposures": (finalcut_exposures, _exp_sql(f"tag = '{TAG}' AND skytilt < 1e-1 AND {_FLAG} AND exptime BETWEEN 445e-1 AND 905e-1", "tag", extra=", CAST(flag AS BIGINT) AS FLAG")),
    "older_finalcut_exposures": (older_finalcut_exposures, _exp_sql(f"tag = '{TAG}' AND program = 'survey' AND ((flag < 20000 AND flag % 100 = 0) OR accepted = 'True')", "tag")),
    "followup_exposures": (followup_exposures, _exp_sql(" OR ".join(f"expnum BETWEEN {a} AND {b}" for a, b in RANGES), "'FOLLOW'")),
    "southern_exposures": (southern_exposures, oracle(
        " UNION ALL ".join(f"(SELECT expnum AS EXPNUM, {u} AS UNITNAME, '1' AS REQNUM, '1' AS ATTNUM, round(telra, 7) AS TELRA, round(teldec, 7) AS TELDEC, CAST(nite AS BIGINT) AS NITE, band AS BAND, round(t_eff, 7) AS T_EFF, '{TAG}' AS TAG FROM exposures_v WHERE {w})"
                           for u, w in (("unitname", f"tag = '{TAG}'"), ("unitname", f"tag = '{TAG}'"), (_D00, "propid = '2016A-0366' AND band IN ('g', 'r') AND exptime > 59 AND obstype = 'object' AND t_eff > 1e-1"))), "exposures_v")),
    "community_exposures": (community_exposures, _exp_sql(f"{_COMMUNITY} AND tag = '{TAG}'", f"'{TAG}'", _D00, extra=", concat(expnum, '01') AS PFW_ATTEMPT_ID")),
    "exposure_union": (exposure_union, UNION_SQL),
    "zeropoint_solutions": (zeropoint_solutions, SOLUTIONS_SQL),
    "blacklisted_ccds": (blacklisted, oracle("SELECT expnum AS EXPNUM, ccdnum AS CCDNUM FROM blacklist_v", "blacklist_v")),
    "cone_box": (cone_box, BOX_SQL),
    "cone_pixel": (cone_pixel, PIXEL_SQL),
    "sampled_box": (sampled_box, SAMPLED_SQL),
    "edge_extract": (edge_extract, EDGE_SQL),
}
