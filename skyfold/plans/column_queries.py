"""Selections, scalar functions and classes."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyfold.functions import classes, coords, photometry
from skyfold.functions.selections import calibration_input, catalog_selection, detection_quality, galaxy_density_cut, good_object, star_selection
from skyfold.functions.staging import fixed
from skyfold.operators.coadd import dereddened
from skyfold.operators.locus import filter_stars
from skyfold.plans import views
from skyfold.plans.shared import as_long, calibrated, objects, rounded
from skyfold.plans.views import oracle
from skyfold.schema import band_column, footprint_columns
from skyfold.sources.catalogs import clean_reference, rename_reference, with_gaia_mag
from skyfold.sources.io import add_ccdnum, add_column, narrow_doubles, rename_column, scan, skim, with_radec

ROW = ["TRUE_ID", "EXPNUM", "CCDNUM", "OBJECT_NUMBER"]
ROW_SQL = "TRUE_ID, EXPNUM, CCDNUM, CAST(OBJECT_NUMBER AS BIGINT) AS OBJECT_NUMBER"


def _rows(df, *extra):
    return as_long(df.select(*ROW, *extra), "OBJECT_NUMBER")


def skim_select(spark, sf):
    return rounded(_rows(skim(views.detections(spark, sf), [*ROW, "FLUX_PSF"], detection_quality()), "FLUX_PSF"))


def calibration_input_select(spark, sf):
    return rounded(_rows(views.detections(spark, sf).where(calibration_input()), "FLUX_PSF"))


def good_objects(spark, sf):
    return rounded(_rows(calibrated(spark, sf).where(good_object()), "MAG_PSF", "MAG_AUTO"))


def coords_roundtrip(spark, sf):
    df = coords.with_vector(views.detections(spark, sf))
    lon, lat = coords.vector_lonlat(F.col("x"), F.col("y"), F.col("z"))
    glon, glat = coords.equatorial_to_galactic(F.col("RA"), F.col("DEC"))
    base_ra, base_dec = (F.expr(b.format(k="TRUE_ID")) for b in (views.BASE_RA, views.BASE_DEC))
    sep = coords.angular_separation(F.col("RA"), F.col("DEC"), base_ra, base_dec) * 3600.0
    out = df.select(*ROW, lon.alias("lon"), lat.alias("lat"), glon.alias("glon"), glat.alias("glat"), sep.alias("sep_arcsec"))
    return as_long(rounded(out, digits=7), "OBJECT_NUMBER")


_VEC = "cos(radians(RA))*cos(radians(DEC))", "sin(radians(RA))*cos(radians(DEC))", "sin(radians(DEC))"
GALACTIC_SQL = [
    f"(-548755604e-10*{_VEC[0]} - 8734370902e-10*{_VEC[1]} - 4838350155e-10*{_VEC[2]})",
    f"(4941094279e-10*{_VEC[0]} - 4448296300e-10*{_VEC[1]} + 7469822445e-10*{_VEC[2]})",
    f"(-8676661490e-10*{_VEC[0]} - 1980763734e-10*{_VEC[1]} + 4559837762e-10*{_VEC[2]})",
]


def _lon(y, x):
    return f"CASE WHEN degrees(atan2({y}, {x})) < 0 THEN degrees(atan2({y}, {x})) + 360 ELSE degrees(atan2({y}, {x})) END"


def _sep_sql(ra1, dec1, ra2, dec2):
    return (
        f"degrees(2*asin(least(1, sqrt(pow(sin(radians({dec2} - ({dec1}))/2), 2) + cos(radians({dec1}))*cos(radians({dec2}))*pow(sin(radians({ra2} - ({ra1}))/2), 2)))))"
    )


COORDS_SQL = oracle(
    f"SELECT {ROW_SQL}, round({_lon(_VEC[1], _VEC[0])}, 7) AS lon, round(degrees(atan2({_VEC[2]}, sqrt(pow({_VEC[0]}, 2) + pow({_VEC[1]}, 2)))), 7) AS lat, "
    f"round({_lon(GALACTIC_SQL[1], GALACTIC_SQL[0])}, 7) AS glon, round(degrees(atan2({GALACTIC_SQL[2]}, sqrt(pow({GALACTIC_SQL[0]}, 2) + pow({GALACTIC_SQL[1]}, 2)))), 7) AS glat, "
    f"round(3600*{_sep_sql('RA', 'DEC', views.BASE_RA.format(k='TRUE_ID'), views.BASE_DEC.format(k='TRUE_ID'))}, 7) AS sep_arcsec FROM detections_v",
    "detections_v",
)

TILE = "concat('SKY', lpad(cast(floor(RA/15) as int), 2, '0'), lpad(cast(floor((RA - 15*floor(RA/15))*4) as int), 2, '0'), case when DEC < 0 then '-' else '+' end, lpad(cast(floor(abs(DEC)) as int), 2, '0'), lpad(cast(floor((abs(DEC) - floor(abs(DEC)))*60) as int), 2, '0'))"


def tile_radec(spark, sf):
    tiles = views.reference(spark, sf).select("OBJID", F.expr(TILE).alias("tile"))
    ra, dec = coords.tile_position(F.col("tile"))
    return rounded(tiles.withColumns({"tile_ra": ra, "tile_dec": dec}))


_TILE_SQL = TILE.replace("as int), 2, '0')", "as int)::varchar, 2, '0')")
TILE_SQL = oracle(
    f"SELECT OBJID, tile, round(15*(h + m/60e0), 6) AS tile_ra, round(s*(d + dm/60e0), 6) AS tile_dec FROM (SELECT OBJID, {_TILE_SQL} AS tile, "
    "floor(RA/15) AS h, floor((RA - 15*floor(RA/15))*4) AS m, CASE WHEN DEC < 0 THEN -1 ELSE 1 END AS s, floor(abs(DEC)) AS d, floor((abs(DEC) - floor(abs(DEC)))*60) AS dm FROM reference_v)",
    "reference_v",
)


def ccd_uid(spark, sf):
    df = views.detections(spark, sf).withColumn("uid", coords.exposure_ccd_uid(F.col("EXPNUM"), F.col("CCDNUM")))
    e, c = coords.split_exposure_ccd_uid(F.col("uid"))
    return df.groupBy("uid").agg(F.first(e).alias("expnum"), F.first(c.cast("long")).alias("ccdnum"), F.count(F.lit(1)).alias("n"))


def snr_magerr(spark, sf):
    snr = F.col("FLUX_PSF") / F.col("FLUXERR_PSF")
    return rounded(_rows(views.detections(spark, sf).withColumns({"snr": snr, "magerr": photometry.snr_to_magerr(snr)}), "snr", "magerr"))


def _spread_sql(s, e, variant):
    tests = " + ".join(f"CASE WHEN {s} + ({k!r}::double)*{e} > {cut!r}::double THEN 1 ELSE 0 END" for k, cut in classes.SPREAD_CUTS[variant])
    failed = f"{s} = -99 OR {e} = -99" if variant == "wavg_dr3" else f"{s} = -1 OR ({s} = 0 AND {e} = 0) OR ({s} = 1 AND {e} = 1)"
    return f"CAST(CASE WHEN {failed} THEN -9 ELSE {tests} END AS BIGINT)"


def spread_class(spark, sf):
    df = views.detections(spark, sf)
    s = F.when(F.col("CCDNUM") % 13 == 0, -1.0).when(F.col("CCDNUM") % 17 == 0, 0.0).when(F.col("CCDNUM") % 19 == 0, 1.0).otherwise(F.col("SPREAD_MODEL"))
    e = F.when(F.col("CCDNUM") % 17 == 0, 0.0).when(F.col("CCDNUM") % 19 == 0, 1.0).otherwise(F.col("SPREADERR_MODEL"))
    df = df.withColumns({"s": s, "e": e})
    made = {f"class_{v}": classes.spread_class(F.col("s"), F.col("e"), v).cast("long") for v in classes.SPREAD_CUTS}
    return _rows(df.withColumns(made), *made)


SPREAD_SQL = oracle(
    f"SELECT {ROW_SQL}, " + ", ".join(f"{_spread_sql('s', 'e', v)} AS class_{v}" for v in classes.SPREAD_CUTS)
    + " FROM (SELECT *, CASE WHEN CCDNUM % 13 = 0 THEN -1e0 WHEN CCDNUM % 17 = 0 THEN 0e0 WHEN CCDNUM % 19 = 0 THEN 1e0 ELSE SPREAD_MODEL END AS s, "
    "CASE WHEN CCDNUM % 17 = 0 THEN 0e0 WHEN CCDNUM % 19 = 0 THEN 1e0 ELSE SPREADERR_MODEL END AS e FROM detections_v)", "detections_v",
)


def _curve_sql(x, knots, levels, outside="NULL"):
    out = f"CASE WHEN {x} IS NULL OR {x} < {knots[0]!r}::double OR {x} > {knots[-1]!r}::double THEN {outside}"
    for k0, k1, y0, y1 in zip(knots, knots[1:], levels, levels[1:]):
        out += f" WHEN {x} <= {k1!r}::double THEN {y0!r}::double + ({(y1 - y0) / (k1 - k0)!r}::double)*({x} - ({k0!r}::double))"
    return out + " END"


S2N, SIZE = "case when OBJECT_NUMBER = 7 then -9.999e9 when OBJECT_NUMBER = 6 then 0e0 else pow(1e1, T_EFF*5e0 - 4e0) end", "(l_suppkey % 60 - 20)/1e2"


def _sized(spark, sf):
    df = views.detections(spark, sf)
    return df.withColumns({"BDF_S2N": F.expr(S2N), "BDF_T": F.expr("(det_id.l_suppkey % 60 - 20)/1e2")})


def size_class(spark, sf):
    df = fixed(_sized(spark, sf), {"logs": classes.log_s2n(F.col("BDF_S2N"))})
    made = {f"size_{v}": classes.size_class(F.col("BDF_S2N"), F.col("BDF_T"), v, F.col("logs")).cast("long") for v in classes.SIZE_VARIANTS}
    return _rows(df.withColumns(made), *made)


def _size_sql(variant):
    knots, curves = classes.SIZE_VARIANTS[variant]
    lo, hi = knots[0], knots[-1]
    logs = "lg"
    x = {"year6": f"coalesce({logs}, {lo!r}::double)", "gold": f"coalesce({logs}, {lo!r}::double)",
         "dr3_gold": f"least(greatest(coalesce({logs}, {lo!r}::double), {lo!r}::double), {hi!r}::double)"}.get(variant, logs)
    total = " + ".join(f"CASE WHEN BDF_T > {_curve_sql('(' + x + ')', knots, c)} THEN 1 ELSE 0 END" for c in curves)
    sentinel = "abs(BDF_S2N + 9.999e9) <= 1e5 OR BDF_S2N <= 0"
    far = f"coalesce({logs} < {lo!r}::double OR {logs} > {hi!r}::double, FALSE)"
    failed = {"year6_first": "FALSE", "range": f"{far} OR BDF_S2N = 0", "year6": sentinel, "gold": f"{sentinel} OR coalesce({logs} > {hi!r}::double, FALSE)",
              "dr3_gold": f"{sentinel} OR {far} OR {logs} IS NULL"}[variant]
    return f"CAST(CASE WHEN {failed} THEN -9 ELSE {total} END AS BIGINT)"


SIZE_SQL = oracle(
    f"SELECT {ROW_SQL}, " + ", ".join(f"{_size_sql(v)} AS size_{v}" for v in classes.SIZE_VARIANTS)
    + f" FROM (SELECT *, CASE WHEN BDF_S2N > 0 THEN log10(BDF_S2N) END AS lg FROM (SELECT *, {S2N} AS BDF_S2N, {SIZE} AS BDF_T FROM detections_v))", "detections_v",
)


def concentration(spark, sf):
    df = views.reference(spark, sf).withColumn("m", F.col("R") - (F.col("OBJID") % 25) / 1e2)
    return df.select(
        "OBJID", classes.concentration_class(F.col("R"), F.col("m")).alias("galaxy"), classes.aperture_concentration_class(F.col("R"), F.col("m")).alias("galaxy_ap"),
        classes.extendedness_class(F.col("DUPVAR")).alias("extended"),
    )


CONCENTRATION_SQL = oracle(
    "SELECT OBJID, NOT (R - m < 3e-2 OR (R - m < 1e-1 AND R < 22)) AS galaxy, NOT (R - m < 4e-2 OR (R - m < 1e-1 AND R < 21)) AS galaxy_ap, NOT (DUPVAR = 0) AS extended "
    "FROM (SELECT *, R - (OBJID % 25)/1e2 AS m FROM reference_v)", "reference_v",
)


def class_mash(spark, sf):
    df = _sized(spark, sf)
    size = classes.size_class(F.col("BDF_S2N"), F.col("BDF_T"), "gold")
    wavg = F.when(F.col("CCDNUM") % 3 == 0, -9).otherwise(classes.spread_class(F.col("SPREAD_MODEL"), F.col("SPREADERR_MODEL"), "wavg"))
    coadd = classes.spread_class(F.col("SPREAD_MODEL"), F.col("SPREADERR_MODEL"), "coadd")
    return _rows(df.withColumn("mash", classes.merged_class(size, wavg, coadd).cast("long")), "mash")


MASH_SQL = oracle(
    f"SELECT {ROW_SQL}, CAST(CASE WHEN sz > -9 THEN sz WHEN CCDNUM % 3 <> 0 AND wv > -9 THEN wv WHEN co > -9 THEN co ELSE -9 END AS BIGINT) AS mash FROM (SELECT *, {_size_sql('gold')} AS sz, "
    f"{_spread_sql('SPREAD_MODEL', 'SPREADERR_MODEL', 'wavg')} AS wv, {_spread_sql('SPREAD_MODEL', 'SPREADERR_MODEL', 'coadd')} AS co "
    f"FROM (SELECT *, CASE WHEN BDF_S2N > 0 THEN log10(BDF_S2N) END AS lg FROM (SELECT *, {S2N} AS BDF_S2N, {SIZE} AS BDF_T FROM detections_v)))", "detections_v",
)


def prob_class(spark, sf):
    df = views.detections(spark, sf).withColumn("p", F.col("T_EFF") - 0.15)
    return _rows(df.withColumn("prob", classes.probability_class(F.col("p")).cast("long")), "prob")


PROB_SQL = oracle(
    f"SELECT {ROW_SQL}, CAST(CASE WHEN p < 0 THEN -9 ELSE " + " + ".join(f"CASE WHEN p < {c!r}::double THEN 1 ELSE 0 END" for c in classes.PROBABILITY_CUTS)
    + " END AS BIGINT) AS prob FROM (SELECT *, T_EFF - 15e-2 AS p FROM detections_v)", "detections_v",
)


def feature_matrix(spark, sf):
    df = objects(spark, sf).withColumns({"BDF_T": F.col("SPREAD_MODEL_I") * 5, "BDF_S2N": 1.0 / F.col("MAGERR_PSF_I")})
    return rounded(df.select("TRUE_ID", *classes.feature_columns()))


FEATURE_SQL = oracle(
    "SELECT TRUE_ID, " + ", ".join(f"round({c}, 6) AS {c}" for c in classes.FEATURES[:4]) + ", round(SPREAD_MODEL_I*5, 6) AS BDF_T, round(1e0/MAGERR_PSF_I, 6) AS BDF_S2N FROM objects_v", "objects_v",
)

EBV = "(TRUE_ID % 100)/1e3"


def ext_mags(spark, sf):
    df = objects(spark, sf).withColumn("EBV", F.expr(EBV))
    df = df.withColumns({band_column("EXTINCTION", b): photometry.extinction(F.col("EBV"), b) for b in "grizY"})
    df = dereddened(df, "grizY", ("MAG_PSF", "WAVG_MAG_PSF"))
    return rounded(df.select("TRUE_ID", *[band_column(f, b) for f in ("EXTINCTION", "MAG_PSF_SFD", "WAVG_MAG_PSF_SFD") for b in "grizY"]))


EXT_SQL = oracle(
    "SELECT TRUE_ID, " + ", ".join(
        f"round({r!r}::double*({EBV}), 6) AS EXTINCTION_{b.upper()}, round(MAG_PSF_{b.upper()} - {r!r}::double*({EBV}), 6) AS MAG_PSF_SFD_{b.upper()}, "
        f"round(WAVG_MAG_PSF_{b.upper()} - {r!r}::double*({EBV}), 6) AS WAVG_MAG_PSF_SFD_{b.upper()}"
        for b, r in photometry.EXTINCTION_SETS["release1"].items() if b in "grizY"
    ) + " FROM objects_v", "objects_v",
)


def extinction_sets(spark, sf):
    """All coefficient sets on the band of each detection."""
    df = views.detections(spark, sf).withColumn("EBV", F.expr(EBV))
    made = {f"a_{n}": photometry.extinction(F.col("EBV"), F.col("BAND"), n) for n in ("schlafly11", "scan2012", "scan2013", "year3", "release1")}
    return rounded(_rows(df.withColumns(made), *made))


EXT_SETS_SQL = oracle(
    f"SELECT {ROW_SQL}, " + ", ".join(
        "round(CASE " + " ".join(f"WHEN BAND = '{b}' THEN {r!r}::double*({EBV})" for b, r in photometry.EXTINCTION_SETS[n].items()) + f" END, 6) AS a_{n}"
        for n in ("schlafly11", "scan2012", "scan2013", "year3", "release1")
    ) + " FROM detections_v", "detections_v",
)


def linear_transform(spark, sf):
    df = views.reference(spark, sf)
    out = ["OBJID"]
    for name in ("original", "refcat", "identity"):
        for b in "grizY":
            mag, err, ok = photometry.linear_transform(b, name)
            out += [mag.alias(f"{name}_{b}"), ok.alias(f"ok_{name}_{b}")]
    return rounded(df.select(*out))


def _linear_sql(name, b):
    slope, offset = photometry.LINEAR_COEFFICIENTS[name][b]
    color, upper, base = ("(G - R)", "12e-1", b.upper()) if b in "gr" else ("(I - Z)", "3e-1", "I" if b == "i" else "Z")
    return f"{base} + ({slope!r}::double)*{color} + ({offset!r}::double)", f"{color} > -2e-1 AND {color} <= {upper}"


LINEAR_SQL = oracle(
    "SELECT OBJID, " + ", ".join(
        f"round({_linear_sql(n, b)[0]}, 6) AS {n}_{b}, {_linear_sql(n, b)[1]} AS ok_{n}_{b}" for n in ("original", "refcat", "identity") for b in "grizY"
    ) + " FROM reference_v", "reference_v",
)

# Curves (knots, offsets) standing in for the tabulated colour terms.
NORTH = ((-0.2, 0.1, 0.35, 0.6, 1.05), (0.012, 0.003, -0.004, -0.011, 0.02))
SOUTH = ((-0.15, 0.2, 0.5, 0.9), (-0.008, 0.001, 0.006, -0.013))


def interp_transform(spark, sf):
    df = views.reference(spark, sf)
    out = ["OBJID"]
    for b in "griz":
        mag, _, ok = photometry.interpolated_transform(b, NORTH, SOUTH)
        out += [mag.alias(f"mag_{b}"), ok.alias(f"ok_{b}")]
    return rounded(df.select(*out))


def _interp_sql(b):
    color, upper = ("(G - R)", "1e0") if b in "gr" else ("(I - Z)", "3e-1")
    n, s = (x / 1000.0 for x in photometry.INTERPOLATION_SHIFTS[b])
    mag = f"{b.upper()} + CASE WHEN DEC > -30 THEN {_curve_sql(color, *NORTH, '0e0')} + ({n!r}::double) ELSE {_curve_sql(color, *SOUTH, '0e0')} + ({s!r}::double) END"
    return f"round({mag}, 6) AS mag_{b}, {color} > -2e-1 AND {color} <= {upper} AS ok_{b}"


INTERP_SQL = oracle("SELECT OBJID, " + ", ".join(_interp_sql(b) for b in "griz") + " FROM reference_v", "reference_v")


def class_boundaries(spark, sf):
    """Boundary curves at the spread error of each detection."""
    df = views.detections(spark, sf)
    made = {f"{v}_{k}": c for v in ("wavg", "coadd") for k, c in enumerate(classes.spread_boundaries(F.col("SPREADERR_MODEL"), v), 1)}
    return rounded(_rows(df.withColumns(made), *made))


BOUNDARY_SQL = oracle(
    f"SELECT {ROW_SQL}, round(5e-3 - 3*SPREADERR_MODEL, 6) AS wavg_1, round(3e-3 - SPREADERR_MODEL, 6) AS wavg_2, round(1e-3 + 5e-1*SPREADERR_MODEL, 6) AS wavg_3, "
    "round(5e-3 - 3*SPREADERR_MODEL, 6) AS coadd_1, round(3e-3 - SPREADERR_MODEL, 6) AS coadd_2, round(2e-3 + SPREADERR_MODEL, 6) AS coadd_3 FROM detections_v",
    "detections_v",
)


def gaia_predict(spark, sf):
    df = with_gaia_mag(views.reference(spark, sf), "edr3")
    args = [F.col(b) for b in "GRIZ"]
    return rounded(df.select("OBJID", *[photometry.predicted_gaia_g(*args, version=v).alias(f"pred_{v}") for v in ("dr2", "edr3")], F.col("PHOT_G_MEAN_MAG_AB").alias("observed")))


def gaia_expr(v):
    """Predicted Gaia G of columns G, R, I and Z."""
    m, w = photometry.GAIA_MODEL[v], photometry.GAIA_WAVELENGTH
    k = "ln(10e0)/25e-1"
    s = [f"(-({k})*({b} - {a})/({w[i + 1] - w[i]!r}::double))" for i, (a, b) in enumerate(zip("GRI", "RIZ"))]
    f = photometry.GAIA_FUDGE
    prime = [f"({s[0]} + {f[0]}e0*({s[1]} + {s[0]}))", f"({f[1]}e0*({s[0]} + {s[1]})/2)", f"({f[2]}e0*({s[1]} + {s[2]})/2)",
             f"({s[2]} + {f[3]}e0*({(w[3] - w[2]) / (w[3] - w[1])!r}::double)*({s[2]} - {s[1]}))"]
    flux = " + ".join(f"{kk!r}::double*pow(10e0, {b}/(-25e-1))*(1 + {p}*({c!r}::double))" for kk, b, p, c in zip(m["weight"], "GRIZ", prime, m["color"]))
    return f"(-25e-1*log10({flux}) + ({m['curve'][0]!r}::double)*(R - 17) + ({m['curve'][1]!r}::double)*(R - 17)*(R - 17) + ({m['shift']!r}::double))"


def _gaia_sql(v):
    return f"round({gaia_expr(v)}, 6) AS pred_{v}"


GAIA_SQL = oracle(
    f"SELECT OBJID, {_gaia_sql('dr2')}, {_gaia_sql('edr3')}, round(25.8010446445e0 - 25e-1*log10(PHOT_G_MEAN_FLUX), 6) AS observed FROM reference_v", "reference_v",
)


def mag_color_class_cuts(spark, sf):
    df = objects(spark, sf)
    df = df.withColumns({band_column("EXTENDED_CLASS", b): classes.spread_class(F.col(band_column("SPREAD_MODEL", b)), F.col(band_column("SPREADERR_MODEL", b))) for b in "griz"})
    return df.select(
        "TRUE_ID", catalog_selection("r").alias("sel_r"), catalog_selection("griz").alias("sel_griz"), catalog_selection("gr", mag=False, color=True).alias("sel_gr_color"),
        catalog_selection("gi", mag=False, color=True, extclass="star").alias("sel_gi_star"), catalog_selection("ri", extclass="gal").alias("sel_ri_gal"), catalog_selection("any").alias("sel_any"),
    )


_CUT = {b: f"WAVG_MAG_PSF_{b.upper()} < {lim}" for b, lim in {"g": 23, "r": 23, "i": "225e-1", "z": 22}.items()}


def _cls(b):
    return _spread_sql(f"SPREAD_MODEL_{b}", f"SPREADERR_MODEL_{b}", "default")


CUTS_SQL = oracle(
    f"SELECT TRUE_ID, {_CUT['r']} AS sel_r, {' AND '.join(_CUT.values())} AS sel_griz, "
    "WAVG_MAG_PSF_G - WAVG_MAG_PSF_R > 1e-1 AND WAVG_MAG_PSF_G - WAVG_MAG_PSF_R < 3e-1 AND WAVG_MAG_PSF_G > 17 AND WAVG_MAG_PSF_G < 20 AS sel_gr_color, "
    "WAVG_MAG_PSF_G - WAVG_MAG_PSF_I > 2e-1 AND WAVG_MAG_PSF_G - WAVG_MAG_PSF_I < 4e-1 AND WAVG_MAG_PSF_G > 17 AND WAVG_MAG_PSF_G < 20 "
    f"AND {_cls('G')} IN (0, 1) AND {_cls('I')} IN (0, 1) AS sel_gi_star, {_CUT['r']} AND {_CUT['i']} AND {_cls('R')} IN (2, 3) AND {_cls('I')} IN (2, 3) AS sel_ri_gal, TRUE AS sel_any FROM objects_v",
    "objects_v",
)


def star_selections(spark, sf):
    df = objects(spark, sf)
    stars = star_selection("WAVG_SPREAD_MODEL_R", "WAVG_MAG_PSF_R", 16, 20, "NEPOCHS_R", ("WAVG_MAG_PSF_G", "WAVG_MAG_PSF_I", -0.5, 1.5), ["WAVG_MAG_PSF_G", "WAVG_MAG_PSF_I"])
    return df.select(
        "TRUE_ID", stars.alias("star"), star_selection("WAVG_SPREAD_MODEL_R", "MAG_PSF_R", 17, 21, "NEPOCHS_R").alias("astrometry_star"), galaxy_density_cut().alias("galaxy"),
    )


STARS_SQL = oracle(
    "SELECT TRUE_ID, abs(WAVG_SPREAD_MODEL_R) < 2e-3 AND WAVG_MAG_PSF_R > 16 AND WAVG_MAG_PSF_R < 20 AND WAVG_MAG_PSF_G < 90 AND WAVG_MAG_PSF_I < 90 AND NEPOCHS_R > 1 "
    "AND WAVG_MAG_PSF_G - WAVG_MAG_PSF_I > -5e-1 AND WAVG_MAG_PSF_G - WAVG_MAG_PSF_I < 15e-1 AS star, "
    "abs(WAVG_SPREAD_MODEL_R) < 2e-3 AND MAG_PSF_R > 17 AND MAG_PSF_R < 21 AND NEPOCHS_R > 1 AS astrometry_star, "
    "WAVG_MAG_AUTO_I > 195e-1 AND WAVG_MAG_AUTO_I < 205e-1 AND WAVG_SPREAD_MODEL_I > 5e-3 AS galaxy FROM objects_v", "objects_v",
)


def locus_filter(spark, sf):
    df = views.reference(spark, sf).withColumns(
        {"BDF_S2N": F.expr("pow(1e1, (OBJID % 70)/1e1 - 2e0)"), "BDF_T": F.expr("(OBJID % 31 - 25)/1e2"), "EBV": F.expr("(OBJID % 100)/1e3"), "MAG_PSF_G": F.col("G"), "MAG_PSF_R": F.col("R"), "MAG_PSF_I": F.col("I")}
    )
    return rounded(filter_stars(df).select("OBJID", "g0", "r0", "i0", "gr", "ri"))


_R = photometry.EXTINCTION_SETS["release1"]
LOCUS_INPUT_SQL = (
    "SELECT *, G - " + f"{_R['g']!r}::double*EBV AS g0, R - {_R['r']!r}::double*EBV AS r0, I - {_R['i']!r}::double*EBV AS i0 FROM "
    "(SELECT *, CASE WHEN BDF_S2N > 0 THEN log10(BDF_S2N) END AS lg FROM (SELECT *, pow(1e1, (OBJID % 70)/1e1 - 2e0) AS BDF_S2N, (OBJID % 31 - 25)/1e2 AS BDF_T, (OBJID % 100)/1e3 AS EBV FROM reference_v)) "
    f"WHERE {_size_sql('year6')} = 0 AND G > 16 AND G < 22 AND R > 16 AND R < 21 AND I > 16 AND I < 21"
)
LOCUS_FILTER_SQL = oracle(
    f"SELECT OBJID, round(g0, 6) AS g0, round(r0, 6) AS r0, round(i0, 6) AS i0, round(g0 - r0, 6) AS gr, round(r0 - i0, 6) AS ri FROM ({LOCUS_INPUT_SQL})", "reference_v",
)


def refcat_cuts(spark, sf):
    return rounded(clean_reference(views.reference(spark, sf)).select("OBJID", "G", "R", "DEC"))


REFCAT_SQL = oracle(
    "SELECT OBJID, round(G, 6) AS G, round(R, 6) AS R, round(DEC, 6) AS DEC FROM reference_v WHERE DUPVAR IN (0, 2) AND "
    + " AND ".join(f"{b}CHI <= 10 AND ({b}CONTRIB & 6) > 0 AND D{b} <= CASE WHEN DEC > -30 THEN 25e-1/ln(10e0)/30 ELSE 25e-1/ln(10e0)/20 END" for b in "GRIZ"), "reference_v",
)


def ref_rename(spark, sf):
    cat = objects(spark, sf).withColumnRenamed("TRUE_ID", "COADD_OBJECT_ID")
    return rounded(rename_reference(cat).select("OBJID", "G", "DG", "R", "DR", "I", "Z"))


REF_RENAME_SQL = oracle(
    "SELECT TRUE_ID AS OBJID, round(WAVG_MAG_PSF_G, 6) AS G, round(WAVG_MAGERR_PSF_G, 6) AS DG, round(WAVG_MAG_PSF_R, 6) AS R, round(WAVG_MAGERR_PSF_R, 6) AS DR, "
    "round(WAVG_MAG_PSF_I, 6) AS I, round(WAVG_MAG_PSF_Z, 6) AS Z FROM objects_v WHERE WAVG_MAG_PSF_R < 21", "objects_v",
)


def scan_prune(spark, sf):
    df = scan(spark, f"{sf}/lineitem.parquet", ["l_partkey", "l_extendedprice"])
    return rounded(df.groupBy("l_partkey").agg(F.sum("l_extendedprice").alias("flux")), digits=2)


def formula_column(spark, sf):
    df = add_column(views.detections(spark, sf), "SNR", "FLUX_PSF / FLUXERR_PSF")
    return rounded(_rows(rename_column(df, "SNR", "SNR_PSF"), "SNR_PSF"))


def ccdnum_from_file(spark, sf):
    df = add_ccdnum(views.detections(spark, sf).drop("CCDNUM"))
    return df.groupBy("EXPNUM", F.col("CCDNUM").cast("long").alias("CCDNUM")).agg(F.count(F.lit(1)).alias("n"))


def narrowed_ingest(spark, sf):
    """Doubles as floats except positions, names in upper case, positions found under an alias."""
    raw = views.detections(spark, sf).select(F.col("RA").alias("alphawin_j2000"), F.col("DEC").alias("deltawin_j2000"), F.col("FLUX_PSF").alias("flux_psf"), F.col("EXPNUM").alias("expnum"))
    df = narrow_doubles(with_radec(raw))
    return df.groupBy("EXPNUM").agg(F.round(F.max("RA"), 7).alias("max_ra"), F.round(F.min("DEC"), 7).alias("min_dec"), F.round(F.max(F.col("FLUX_PSF").cast("double")), 2).alias("max_flux"))


def footprint_projection(spark, sf):
    return rounded(objects(spark, sf).select("TRUE_ID", *footprint_columns("griz")), digits=7)


FOOTPRINT_COLS_SQL = oracle("SELECT TRUE_ID, round(RA, 7) AS RA, round(DEC, 7) AS DEC, " + ", ".join(f"round(WAVG_MAG_PSF_{b}, 7) AS WAVG_MAG_PSF_{b}" for b in "GRIZ") + " FROM objects_v", "objects_v")

QUERIES = {
    "skim_select": (skim_select, oracle(
        f"SELECT {ROW_SQL}, round(FLUX_PSF, 6) AS FLUX_PSF FROM detections_v WHERE FLUX_PSF > 0 AND FLUX_AUTO > 0 AND FLAGS < 4 AND (IMAFLAGS_ISO & 2047) = 0 AND 1.0857362e0*(FLUXERR_PSF/FLUX_PSF) < 5e-1", "detections_v")),
    "calibration_input_select": (calibration_input_select, oracle(
        f"SELECT {ROW_SQL}, round(FLUX_PSF, 6) AS FLUX_PSF FROM detections_v WHERE FLUX_PSF > 0 AND FLAGS < 4 AND (IMAFLAGS_ISO & 2047) = 0 AND FLUX_PSF/FLUXERR_PSF > 5", "detections_v")),
    "good_objects": (good_objects, oracle(f"SELECT {ROW_SQL}, round(MAG_PSF, 6) AS MAG_PSF, round(MAG_AUTO, 6) AS MAG_AUTO FROM good_v", "good_v")),
    "coords_roundtrip": (coords_roundtrip, COORDS_SQL),
    "tile_radec": (tile_radec, TILE_SQL),
    "ccd_uid": (ccd_uid, oracle("SELECT EXPNUM + CCDNUM/100e0 AS uid, EXPNUM AS expnum, CCDNUM AS ccdnum, count(*) AS n FROM detections_v GROUP BY EXPNUM, CCDNUM", "detections_v")),
    "snr_magerr": (snr_magerr, oracle(
        f"SELECT {ROW_SQL}, round(FLUX_PSF/FLUXERR_PSF, 6) AS snr, round(25e-1/ln(10e0)/(FLUX_PSF/FLUXERR_PSF), 6) AS magerr FROM detections_v", "detections_v")),
    "spread_class": (spread_class, SPREAD_SQL),
    "size_class": (size_class, SIZE_SQL),
    "concentration": (concentration, CONCENTRATION_SQL),
    "class_mash": (class_mash, MASH_SQL),
    "prob_class": (prob_class, PROB_SQL),
    "feature_matrix": (feature_matrix, FEATURE_SQL),
    "ext_mags": (ext_mags, EXT_SQL),
    "extinction_sets": (extinction_sets, EXT_SETS_SQL),
    "linear_transform": (linear_transform, LINEAR_SQL),
    "interp_transform": (interp_transform, INTERP_SQL),
    "class_boundaries": (class_boundaries, BOUNDARY_SQL),
    "gaia_predict": (gaia_predict, GAIA_SQL),
    "mag_color_class_cuts": (mag_color_class_cuts, CUTS_SQL),
    "star_selections": (star_selections, STARS_SQL),
    "locus_filter": (locus_filter, LOCUS_FILTER_SQL),
    "refcat_cuts": (refcat_cuts, REFCAT_SQL),
    "ref_rename": (ref_rename, REF_RENAME_SQL),
    "scan_prune": (scan_prune, "SELECT l_partkey, round(sum(l_extendedprice), 2) AS flux FROM lineitem GROUP BY l_partkey"),
    "formula_column": (formula_column, oracle(f"SELECT {ROW_SQL}, round(FLUX_PSF/FLUXERR_PSF, 6) AS SNR_PSF FROM detections_v", "detections_v")),
    "ccdnum_from_file": (ccdnum_from_file, oracle("SELECT EXPNUM, CCDNUM, count(*) AS n FROM detections_v GROUP BY EXPNUM, CCDNUM", "detections_v")),
    "narrowed_ingest": (narrowed_ingest, oracle(
        "SELECT EXPNUM, round(max(RA), 7) AS max_ra, round(min(DEC), 7) AS min_dec, round(CAST(max(CAST(FLUX_PSF AS FLOAT)) AS DOUBLE), 2) AS max_flux FROM detections_v GROUP BY EXPNUM", "detections_v")),
    "footprint_projection": (footprint_projection, FOOTPRINT_COLS_SQL),
}
