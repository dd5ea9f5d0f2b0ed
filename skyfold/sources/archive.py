"""Queries against archive tables, as functions from a dictionary of DataFrames to a DataFrame.

Table names are the keys of ``tables``; tags and programs are arguments, so one function serves every release of a
kind. Filters stand next to the scans and reach parquet; joins are equi-joins left to the optimizer.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from skyfold.functions.guards import below
from skyfold.functions.healpix import nested_range, with_pixel
from skyfold.functions.selections import BAD_IMAGE_BITS, ROUNDED_MAG_PER_RATIO

Tables = Mapping[str, DataFrame]

# Chip edges, exposure times, quality limits, proposal ids and exposure ranges.
X_EDGE, Y_EDGE = (15, 2048 - 30), (15, 4096 - 30)
EXPTIME_WINDOW = (44.5, 90.5)
SKYTILT_LIMIT = 0.1
COMMUNITY_EXCLUDED = "2012B-0001"
COMMUNITY_BANDS = ["g", "r", "i", "z"]
SOUTH_PROPOSAL = "2016A-0366"
FOLLOWUP_RANGES = [(475905, 475986), (476335, 476353), (476942, 477025), (482835, 482849), (482856, 482924)]

PHOTOMETRY = ["RA", "DEC", "FLUX_PSF", "FLUXERR_PSF", "FLUX_AUTO", "FLUXERR_AUTO"]
SHAPE = ["A_IMAGE", "B_IMAGE", "THETA_IMAGE"]
CLASS = ["CLASS_STAR", "SPREAD_MODEL", "SPREADERR_MODEL"]


def _measured(flags_limit: int = 4, image_flags: bool = True) -> Column:
    """Positive fluxes, good flags, magnitude error below 0.5, clean or unknown image flags."""
    error = F.lit(ROUNDED_MAG_PER_RATIO) * F.try_divide(F.col("FLUXERR_PSF").cast("double"), F.col("FLUX_PSF").cast("double"))
    out = (F.col("FLUX_PSF") > 0) & (F.col("FLUX_AUTO") > 0) & (F.col("FLAGS") < flags_limit) & below(error, 0.5)
    if image_flags:
        flags = F.col("IMAFLAGS_ISO")
        out = out & (flags.isNull() | (flags.cast("int").bitwiseAND(F.lit(BAD_IMAGE_BITS)) == 0))
    return out


def _char1(name: str) -> Column:
    return F.substring(F.col(name), 1, 1).alias(name)


def unit_name(expnum: int) -> str:
    return f"D{expnum:08d}"


def file_pattern(expnum: int | None, reqnum: int, attnum: int) -> str:
    """Files of one processing; of every exposure when ``expnum`` is None."""
    return f"{'D%' if expnum is None else unit_name(expnum)}_%_r{reqnum}p{attnum:02d}_%"


def _is(column: str, value) -> Column:
    """Equality, or everything for None."""
    return F.lit(True) if value is None else F.col(column) == value


def _unit(expnum: int | None, reqnum: int, attnum: int) -> Column:
    return _is("UNITNAME", None if expnum is None else unit_name(expnum)) & (F.col("REQNUM") == reqnum) & (F.col("ATTNUM") == attnum)


def _unit_files(objects: DataFrame, expnum: int | None, reqnum: int, attnum: int) -> DataFrame:
    """Objects of the files of a processing, with the unit their file name starts with."""
    return objects.where(F.col("FILENAME").like(file_pattern(expnum, reqnum, attnum))).withColumn("UNITNAME", F.substring_index("FILENAME", "_", 1))


def first_year_objects(t: Tables, expnum: int | None, tag: str) -> DataFrame:
    """Calibrated first-year objects of one exposure with fluxes made from magnitudes. Tables: eval, objects, image."""
    ev = t["eval"].where(_is("EXPNUM", expnum)).select("EXPOSUREID", F.col("EXPNUM").alias("_exp"), "T_EFF")
    image = t["image"].select("EXPOSUREID", F.col("ID").alias("IMAGEID"), "EXPNUM", F.col("CCD").alias("CCDNUM"), "BAND")
    objects = t["objects"].where((F.col("MAG_PSF") < 90) & (F.col("MAG_AUTO") < 90) & (F.col("FLAGS") < 4) & (F.col("MAGERR_PSF") < 0.5))
    joined = ev.join(image, "EXPOSUREID").join(objects.drop("BAND", "EXPNUM", "CCDNUM", "T_EFF", "FILENAME"), "IMAGEID")
    unit = F.concat(F.lit("D00"), F.col("_exp").cast("string"))
    flux = F.pow(F.lit(10.0), (F.col("MAG_PSF") - 25.0) / -2.5)
    return joined.select(
        F.concat(unit, F.lit("_"), F.substring("BAND", 1, 1), F.lit("_c"), F.col("CCDNUM").cast("string"), F.lit("_fake.fits")).alias("FILENAME"),
        unit.alias("UNITNAME"), F.lit(-1).alias("REQNUM"), F.lit(-1).alias("ATTNUM"), F.lit(tag).alias("TAG"), "EXPNUM", "CCDNUM", _char1("BAND"),
        "T_EFF", "FWHM_WORLD", "FLAGS", F.col("OBJECT_ID").alias("OBJECT_NUMBER"), "RA", "DEC", flux.alias("FLUX_PSF"),
        (flux * F.col("MAGERR_PSF") / F.lit(ROUNDED_MAG_PER_RATIO)).alias("FLUXERR_PSF"), "FLUX_AUTO", "FLUXERR_AUTO", *CLASS,
    )


def single_epoch_objects(t: Tables, expnum: int | None, reqnum: int, attnum: int, tag: str) -> DataFrame:
    """Objects of one processed exposure, away from chip edges. Tables: se_object, firstcut_eval."""
    ev = t["firstcut_eval"].where(_unit(expnum, reqnum, attnum))
    inside = F.col("XWIN_IMAGE").between(*X_EDGE) & F.col("YWIN_IMAGE").between(*Y_EDGE)
    objects = _unit_files(t["se_object"].where(_measured(image_flags=False) & inside), expnum, reqnum, attnum)
    joined = objects.join(ev.select("UNITNAME", "REQNUM", "ATTNUM", "EXPNUM", "T_EFF"), "UNITNAME")
    return joined.select(
        "FILENAME", "UNITNAME", "REQNUM", "ATTNUM", F.lit(tag).alias("TAG"), "EXPNUM", F.substring("FILENAME", 14, 2).cast("int").alias("CCDNUM"),
        _char1("BAND"), "T_EFF", "FWHM_WORLD", "FLAGS", F.col("OBJECT_NUMBER").cast("long").alias("OBJECT_NUMBER"), *PHOTOMETRY, *CLASS,
    )


def tagged_unit_objects(t: Tables, expnum: int | None, reqnum: int, attnum: int, tag: str) -> DataFrame:
    """Objects of one tagged processing, older form without attempt ids. Tables: se_object, qa_summary, proctag."""
    tags = t["proctag"].where(_unit(expnum, reqnum, attnum) & (F.col("TAG") == tag)).select("UNITNAME", "REQNUM", "ATTNUM", "TAG", "PFW_ATTEMPT_ID")
    qa = t["qa_summary"].select("PFW_ATTEMPT_ID", "EXPNUM", "T_EFF")
    objects = _unit_files(t["se_object"].where(_measured()), expnum, reqnum, attnum)
    joined = objects.join(tags.join(qa, "PFW_ATTEMPT_ID"), "UNITNAME")
    return joined.select(
        "FILENAME", "UNITNAME", "REQNUM", "ATTNUM", "TAG", "EXPNUM", F.substring("FILENAME", 14, 2).cast("int").alias("CCDNUM"), _char1("BAND"), "T_EFF",
        "FWHM_WORLD", "FLAGS", "OBJECT_NUMBER", *PHOTOMETRY, *SHAPE, *CLASS,
    )


def _attempt_chain(t: Tables, tag: str) -> DataFrame:
    attempts = t["pfw_attempt"].select(F.col("ID").alias("PFW_ATTEMPT_ID"), "UNITNAME", "REQNUM", "ATTNUM")
    tags = t["proctag"].where(F.col("TAG") == tag).select("PFW_ATTEMPT_ID", "TAG")
    qa = t["qa_summary"].select("PFW_ATTEMPT_ID", "EXPNUM", "T_EFF")
    files = t["catalog"].select("PFW_ATTEMPT_ID", "FILENAME", "CCDNUM")
    return attempts.join(tags, "PFW_ATTEMPT_ID").join(qa, "PFW_ATTEMPT_ID").join(files, "PFW_ATTEMPT_ID")


ATTEMPT_OUTPUT = ["PFW_ATTEMPT_ID", "UNITNAME", "REQNUM", "ATTNUM", "TAG", "EXPNUM", "CCDNUM"]


def _attempt_columns(joined: DataFrame) -> DataFrame:
    return joined.select("FILENAME", *ATTEMPT_OUTPUT, _char1("BAND"), "T_EFF", "FWHM_WORLD", "FLAGS", "OBJECT_NUMBER", *PHOTOMETRY, *SHAPE, *CLASS)


def attempt_objects(t: Tables, pfw_attempt_id: int | None, tag: str) -> DataFrame:
    """Objects of one processing attempt. Tables: se_object, qa_summary, proctag, pfw_attempt, catalog."""
    chain = _attempt_chain(t, tag).where(_is("PFW_ATTEMPT_ID", pfw_attempt_id))
    return _attempt_columns(t["se_object"].where(_measured()).join(chain, "FILENAME"))


def unit_objects(t: Tables, expnum: int | None, reqnum: int, attnum: int, tag: str) -> DataFrame:
    """Objects by unit, request and attempt. Tables as in ``attempt_objects``."""
    chain = _attempt_chain(t, tag).where(_unit(expnum, reqnum, attnum))
    objects = t["se_object"].where(F.col("FILENAME").like(file_pattern(expnum, reqnum, attnum)) & _measured())
    return _attempt_columns(objects.join(chain, "FILENAME"))


def release_objects(t: Tables, pfw_attempt_id: int | None, tag: str) -> DataFrame:
    """Objects of a release with exposure time and date. Tables: finalcut_object, qa_summary, proctag, exposure, catalog.

    Serves both releases of the kind: pass the tables and tag of the one wanted.
    """
    files = t["catalog"].where(_is("PFW_ATTEMPT_ID", pfw_attempt_id)).select("PFW_ATTEMPT_ID", "FILENAME", "CCDNUM")
    tags = t["proctag"].where(F.col("TAG") == tag).select("PFW_ATTEMPT_ID", "TAG")
    qa = t["qa_summary"].select("PFW_ATTEMPT_ID", "EXPNUM", "T_EFF")
    exposure = t["exposure"].select("EXPNUM", "MJD_OBS", "EXPTIME")
    chain = files.join(tags, "PFW_ATTEMPT_ID").join(qa, "PFW_ATTEMPT_ID").join(exposure, "EXPNUM")
    joined = t["finalcut_object"].where(_measured()).join(chain, "FILENAME")
    return joined.select(
        "FILENAME", "PFW_ATTEMPT_ID", "TAG", "EXPNUM", "CCDNUM", _char1("BAND"), "T_EFF", "FWHM_WORLD", "FLAGS", "OBJECT_NUMBER", *PHOTOMETRY, *SHAPE,
        *CLASS, "IMAFLAGS_ISO", "MJD_OBS", "EXPTIME",
    )


def coadd_stars(t: Tables) -> DataFrame:
    """Bright stars of the coadd with dereddened magnitudes. Table: coadd_objects."""
    mags = {b: F.col(f"wavgcalib_mag_psf_{b}") - F.col(f"xcorr_sfd98_{b}") for b in "grizy"}
    stars = t["coadd_objects"].where((F.abs("wavg_spread_model_r") < 0.002) & (mags["r"] < 23) & (F.col("wavg_magerr_psf_r") < 0.1))
    return stars.select(
        "coadd_objects_id", "ra", "dec", *[m.alias(f"wavg_mag_psf_{b}") for b, m in mags.items()], *[f"wavg_magerr_psf_{b}" for b in "grizy"]
    )


def finalcut_objects(t: Tables, band: str) -> DataFrame:
    """Measured objects of a band. Table: objects."""
    good = (F.col("MAG_PSF") < 90) & (F.col("MAG_AUTO") < 90) & (F.col("MAGERR_PSF") < 1) & (F.col("MAGERR_AUTO") < 1) & (F.col("FLAGS") < 4)
    return t["objects"].where(good & F.col("BAND").like(f"{band}%")).select(
        "OBJECT_ID", "COADD_OBJECTS_ID", "RA", "DEC", "FLAGS", _char1("BAND"), "MAG_PSF", "MAGERR_PSF", "MAG_AUTO", "MAGERR_AUTO", "SPREAD_MODEL",
        "SPREADERR_MODEL", "CLASS_STAR",
    )


EXPOSURE_OUTPUT = ["UNITNAME", "EXPNUM", "REQNUM", "ATTNUM", "TELRA", "TELDEC", "NITE", "BAND", "T_EFF", "TAG"]


def _text(name: str) -> Column:
    return F.col(name).cast("string").alias(name)


def first_year_exposures(t: Tables, tag: str, program: str = "survey") -> DataFrame:
    """Accepted exposures of a program. Tables: eval, exposure (with ID)."""
    ev = t["eval"].where((F.col("ACCEPTED") == "True") & (F.col("PROGRAM") == program)).select("EXPOSUREID", "EXPNUM", "T_EFF")
    exposure = t["exposure"].select(F.col("ID").alias("EXPOSUREID"), "TELRA", "TELDEC", "NITE", "BAND")
    return ev.join(exposure, "EXPOSUREID").select(
        F.concat(F.lit("D00"), F.col("EXPNUM").cast("string")).alias("UNITNAME"), "EXPNUM", F.lit("-1").alias("REQNUM"), F.lit("-1").alias("ATTNUM"), "TELRA",
        "TELDEC", "NITE", _char1("BAND"), "T_EFF", F.lit(tag).alias("TAG"),
    ).orderBy("EXPNUM")


def _evaluated(t: Tables, evaluation: str, tags: str | None, tag: str, program: str | None, accepted: bool) -> DataFrame:
    ev = t[evaluation]
    if accepted:
        ev = ev.where(F.col("ACCEPTED") == "True")
    if program is not None:
        ev = ev.where(F.col("PROGRAM") == program)
    ev = ev.select("UNITNAME", "EXPNUM", "REQNUM", "ATTNUM", "T_EFF")
    if tags is not None:
        ev = ev.join(t[tags].where(F.col("TAG") == tag).select("UNITNAME", "REQNUM", "ATTNUM"), ["UNITNAME", "REQNUM", "ATTNUM"])
    exposure = t["exposure"].select("EXPNUM", F.col("TRADEG").alias("TELRA"), F.col("TDECDEG").alias("TELDEC"), "NITE", "BAND")
    return ev.join(exposure, "EXPNUM").select(
        "UNITNAME", "EXPNUM", _text("REQNUM"), _text("ATTNUM"), "TELRA", "TELDEC", "NITE", _char1("BAND"), "T_EFF", F.lit(tag).alias("TAG")
    )


def firstcut_exposures(t: Tables, tag: str, program: str = "survey") -> DataFrame:
    """Nightly exposures that pass evaluation. Tables: firstcut_eval, exposure, ops_proctag."""
    return _evaluated(t, "firstcut_eval", "ops_proctag", tag, program, True).orderBy("EXPNUM")


def finalcut_exposures(t: Tables, tag: str) -> DataFrame:
    """Exposures that pass quality, or evaluation with minor flags. Tables: exposure, proctag, finalcut_eval, qa_summary, pfw_attempt.

    The decimal digits of the quality flag carry meaning: thousands are sky subtraction, ten-thousands exclusion lists.
    """
    qa = t["qa_summary"].where(F.col("SKYTILT") < SKYTILT_LIMIT).select("PFW_ATTEMPT_ID", "EXPNUM", "T_EFF", "FLAG")
    tags = t["proctag"].where(F.col("TAG") == tag).select("PFW_ATTEMPT_ID", "TAG")
    ev = t["finalcut_eval"].select("PFW_ATTEMPT_ID", "ACCEPTED")
    attempts = t["pfw_attempt"].select(F.col("ID").alias("PFW_ATTEMPT_ID"), "UNITNAME", "REQNUM", "ATTNUM")
    exposure = t["exposure"].where(F.col("EXPTIME").between(*EXPTIME_WINDOW))
    exposure = exposure.select("EXPNUM", F.col("TRADEG").alias("TELRA"), F.col("TDECDEG").alias("TELDEC"), "NITE", "BAND")
    joined = tags.join(qa, "PFW_ATTEMPT_ID").join(ev, "PFW_ATTEMPT_ID").join(attempts, "PFW_ATTEMPT_ID").join(exposure, "EXPNUM")
    flag = F.col("FLAG")
    passed = ((flag < 20000) & (flag % 1000 == 0)) | ((flag <= 3) & (F.col("ACCEPTED") == "True"))
    return joined.where(passed).select(
        "PFW_ATTEMPT_ID", "EXPNUM", "UNITNAME", _text("REQNUM"), _text("ATTNUM"), "TELRA", "TELDEC", "NITE", _char1("BAND"), "T_EFF", "FLAG", "TAG"
    ).orderBy("EXPNUM")


def older_finalcut_exposures(t: Tables, tag: str, program: str = "survey") -> DataFrame:
    """Older quality rule, by program. Tables: exposure, proctag, finalcut_eval, qa_summary."""
    qa = t["qa_summary"].select("PFW_ATTEMPT_ID", "EXPNUM", "T_EFF", "FLAG")
    tags = t["proctag"].where(F.col("TAG") == tag).select("PFW_ATTEMPT_ID", "UNITNAME", "REQNUM", "ATTNUM", "TAG")
    ev = t["finalcut_eval"].select("UNITNAME", "REQNUM", "ATTNUM", "ACCEPTED")
    exposure = t["exposure"].where(F.col("PROGRAM") == program)
    exposure = exposure.select("EXPNUM", F.col("TRADEG").alias("TELRA"), F.col("TDECDEG").alias("TELDEC"), "NITE", "BAND")
    joined = tags.join(qa, "PFW_ATTEMPT_ID").join(ev, ["UNITNAME", "REQNUM", "ATTNUM"]).join(exposure, "EXPNUM")
    flag = F.col("FLAG")
    passed = ((flag < 20000) & (flag % 100 == 0)) | (F.col("ACCEPTED") == "True")
    return joined.where(passed).select(
        "UNITNAME", "EXPNUM", _text("REQNUM"), _text("ATTNUM"), "TELRA", "TELDEC", "NITE", _char1("BAND"), "T_EFF", "TAG"
    ).orderBy("EXPNUM")


def in_ranges(column: str, ranges: Sequence[tuple[int, int]]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(column).between(*r) for r in ranges])


def followup_exposures(t: Tables, tag: str, ranges: Sequence[tuple[int, int]] = FOLLOWUP_RANGES) -> DataFrame:
    """Exposures by number ranges. Tables: firstcut_eval, exposure."""
    return _evaluated(t, "firstcut_eval", None, tag, None, False).where(in_ranges("EXPNUM", ranges)).orderBy("EXPNUM")


def southern_exposures(t: Tables, tag: str, variant: str = "firstcut") -> DataFrame:
    """Exposures of the southern program: ``firstcut``, ``finalcut`` or ``reprocessed`` tables.

    firstcut: firstcut_eval, exposure, proctag; finalcut: finalcut_eval, exposure, ops_proctag; reprocessed: exposure, qa_summary.
    """
    if variant == "firstcut":
        return _evaluated(t, "firstcut_eval", "proctag", tag, None, False).orderBy("EXPNUM")
    if variant == "finalcut":
        return _evaluated(t, "finalcut_eval", "ops_proctag", tag, None, False).orderBy("EXPNUM")
    if variant == "reprocessed":
        extra = (F.col("PROPID") == SOUTH_PROPOSAL) & F.col("BAND").isin("g", "r") & (F.col("EXPTIME") > 59) & (F.col("OBSTYPE") == "object")
        return _community(t, tag, extra).orderBy("EXPNUM")
    raise ValueError(f"unrecognized variant: {variant}")


def _community(t: Tables, tag: str, extra: Column) -> DataFrame:
    exposure = t["exposure"].where(extra & F.col("RADEG").isNotNull() & F.col("DECDEG").isNotNull())
    qa = t["qa_summary"].where(F.col("T_EFF") > 0.1).select("EXPNUM", "T_EFF")
    number = F.col("EXPNUM").cast("string")
    return exposure.join(qa, "EXPNUM").select(
        F.concat(number, F.lit("01")).alias("PFW_ATTEMPT_ID"), "EXPNUM", F.concat(F.lit("D00"), number).alias("UNITNAME"), F.lit("1").alias("REQNUM"),
        F.lit("1").alias("ATTNUM"), F.col("RADEG").alias("TELRA"), F.col("DECDEG").alias("TELDEC"), "NITE", "BAND", "T_EFF", F.lit(0).alias("FLAG"),
        F.lit(tag).alias("TAG"),
    )


def community_exposures(t: Tables, tag: str, tagged: bool = False) -> DataFrame:
    """Community exposures outside the main survey. Tables: exposure, qa_summary, and proctag when ``tagged``."""
    extra = (
        (F.col("PROPID") != COMMUNITY_EXCLUDED) & ~F.col("PROPID").like("*-9999") & F.col("BAND").isin(COMMUNITY_BANDS) & (F.col("EXPTIME") >= 30)
    )
    out = _community(t, tag, extra)
    if tagged:
        out = out.join(t["proctag"].where(F.col("TAG") == tag).select("EXPNUM"), "EXPNUM").select(*out.columns)
    return out.orderBy("EXPNUM")


def zeropoint_solution(table: DataFrame, names: Mapping[str, str], flag: Column | None = None, extra: Sequence[str] = ()) -> DataFrame:
    """A zeropoint table under common names: EXPNUM, CCDNUM, BAND, then ``names`` (output -> source), flag, in key order.

    The survey's solutions differ in source names and flag rule only: a qualified flag column, a CASE over one, or 0.
    """
    renamed = [F.col(source).alias(out) for out, source in names.items()]
    flag = F.lit(0) if flag is None else flag
    return table.select(*renamed, *extra, flag.alias("ZP_FLAG")).orderBy("EXPNUM", "CCDNUM")


_POSITION = {"RA": "RA_CENT", "DEC": "DEC_CENT"}
ZEROPOINT_NAMES = {
    "color_locus": {"EXPNUM": "EXPNUM", "CCDNUM": "CCD", "BAND": "BAND", "RA": "RA_MEAN", "DEC": "DEC_MEAN", "MAG_ZERO": "MAG_ZERO", "STD_MAG_ZERO": "SIGMA_MAG_ZERO"},
    "global_raw": {"EXPNUM": "EXPNUM", "CCDNUM": "CCD", "BAND": "BAND", **_POSITION, "MAG_ZERO": "FGCM_ZPT", "SIGMA_MAG_ZERO": "FGCM_ZPTERR"},
    "global": {"EXPNUM": "EXPNUM", "CCDNUM": "CCDNUM", "BAND": "BAND", **_POSITION, "MAG_ZERO": "FGCM_ZPT", "SIGMA_MAG_ZERO": "FGCM_ZPTERR"},
    "image": {"EXPNUM": "EXPNUM", "CCDNUM": "CCD", "BAND": "BAND", "RA": "RA", "DEC": "DEC", "ZEROPOINT": "ZEROPOINT", "SIGMA_ZEROPOINT": "SIGMA_ZEROPOINT"},
    "southern": {"EXPNUM": "EXPNUM", "CCDNUM": "CCDNUM", "BAND": "BAND", **_POSITION, "MAG_ZERO": "MAG_ZERO", "STD_MAG_ZERO": "STD_MAG_ZERO"},
}


def color_locus_zeropoints(t: Tables) -> DataFrame:
    return zeropoint_solution(t["zeropoints"], ZEROPOINT_NAMES["color_locus"], F.col("QSLR_FLAG"))


def global_zeropoints(t: Tables, raw: bool = False) -> DataFrame:
    if raw:
        return zeropoint_solution(t["zeropoints"], ZEROPOINT_NAMES["global_raw"], F.col("FGCM_FLAG"))
    return zeropoint_solution(t["zeropoints"], ZEROPOINT_NAMES["global"], F.when(F.col("FGCM_FLAG") < 16, 0).otherwise(1), ["FGCM_FLAG"])


def image_zeropoints(t: Tables) -> DataFrame:
    return zeropoint_solution(t["image"].where(F.col("ZEROPOINT").isNotNull()), ZEROPOINT_NAMES["image"])


def southern_zeropoints(t: Tables, reprocessed: bool = False) -> DataFrame:
    if not reprocessed:
        return zeropoint_solution(t["zeropoints"], ZEROPOINT_NAMES["southern"])
    exposure = t["exposure"].where((F.col("PROPID") == SOUTH_PROPOSAL) & (F.col("EXPTIME") > 59) & (F.col("OBSTYPE") == "object")).select("EXPNUM")
    image = t["image"].select("EXPNUM", "CCDNUM", F.col("RA_CENT").alias("RA"), F.col("DEC_CENT").alias("DEC"))
    zp = t["zeropoint"].where(F.col("BAND").isin("g", "r")).join(exposure, "EXPNUM").join(image, ["EXPNUM", "CCDNUM"])
    return _flagged(zp, ["RA", "DEC"])


def _flagged(zp: DataFrame, position: Sequence[str] = ()) -> DataFrame:
    return zp.select(
        "EXPNUM", "CCDNUM", "BAND", *position, "MAG_ZERO", "SIGMA_MAG_ZERO", F.col("FLAG").alias("EXPCALIB_FLAG"), F.when(F.col("FLAG") < 0, 1).otherwise(0).alias("ZP_FLAG")
    ).orderBy("EXPNUM", "CCDNUM")


def community_zeropoints(t: Tables, tag: str | None = None) -> DataFrame:
    zp = t["zeropoint"].where(F.col("BAND").isin(COMMUNITY_BANDS))
    if tag is not None:
        zp = zp.join(t["proctag"].where(F.col("TAG") == tag).select("EXPNUM"), "EXPNUM")
    return _flagged(zp)


def blacklisted_ccds(t: Tables) -> DataFrame:
    return t["blacklist"].select("EXPNUM", "CCDNUM").orderBy("EXPNUM", "CCDNUM")


def exposure_query(tags: Sequence[str], routes: Mapping[str, object]) -> DataFrame:
    """Union of the exposure queries of the tags, ordered by exposure.

    ``routes`` maps an upper-case tag to a function returning a DataFrame, or to another tag it shares a query with. Each query runs
    once; columns are matched by name and NULL where a query lacks one.
    """
    chosen: dict[str, object] = {}
    for tag in [t.upper() for t in tags]:
        while isinstance(routes.get(tag), str):
            tag = routes[tag]
        if tag in routes:
            chosen.setdefault(tag, routes[tag])
    if not chosen:
        raise ValueError(f"unrecognized tags: {list(tags)}")
    parts = [make() for make in chosen.values()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).orderBy("EXPNUM")


def zeropoint_query(tags: Sequence[str], routes: Sequence[tuple[str, object]]) -> DataFrame | None:
    """The first route whose tag (or ``PREFIX*``) is among the tags; None without one."""
    upper = [t.upper() for t in tags]
    for pattern, make in routes:
        hit = any(t.startswith(pattern[:-1]) for t in upper) if pattern.endswith("*") else pattern in upper
        if hit:
            return make()
    return None


#: Sampling places a row among SAMPLE_CELLS by a multiplicative hash.
SAMPLE_CELLS, SAMPLE_FACTOR = 1_000_003, 48_271


def sampled_box(df: DataFrame, ra: float = 40.0, dec: float = -34.4, delta: float = 1.0, fraction: float = 0.01, seed: int = 1) -> DataFrame:
    """A sample of star candidates in a box. The sampling is the feature.

    A row is chosen by a multiplicative hash of its ``CATALOG_ID``, so a sample is the same on every run.
    """
    box = F.col("RA").between(ra - delta, ra + delta) & F.col("DEC").between(dec - delta, dec + delta)
    mags = F.col("MAG_PSF_G").between(15, 30) & F.col("MAG_PSF_R").between(15, 30)
    draw = F.pmod((F.pmod(F.col("CATALOG_ID"), F.lit(SAMPLE_CELLS)) + seed) * SAMPLE_FACTOR, F.lit(SAMPLE_CELLS))
    chosen = df.where(draw < int(fraction * SAMPLE_CELLS)) if fraction < 1.0 else df
    return chosen.where(box & mags & (F.abs("SPREAD_MODEL_R") < 0.01)).select("CATALOG_ID", "RA", "DEC", "MAG_PSF_G", "MAG_PSF_R", "SPREAD_MODEL_R")


def stars_near(df: DataFrame, ra: float, dec: float, coord: str = "equ", nside: int = 128, delta: float = 0.2) -> DataFrame:
    """Stars near a point, by coordinate box (``equ``) or by one nested pixel (``hpx``) as a range of the stored index."""
    if coord == "equ":
        near = F.col("RA").between(round(ra, 2) - delta, round(ra, 2) + delta) & F.col("DEC").between(round(dec, 2) - delta, round(dec, 2) + delta)
    elif coord == "hpx":
        point = df.sparkSession.range(1).select(F.lit(float(ra)).alias("RA"), F.lit(float(dec)).alias("DEC"))
        low, high = nested_range(with_pixel(point, nside, nest=True).first()["pix"], nside)
        near = (F.col("HPX2048") >= low) & (F.col("HPX2048") < high)
    else:
        raise ValueError(f"unrecognized coord: {coord}")
    mags = F.col("WAVG_MAG_PSF_G").between(10, 30) & F.col("WAVG_MAG_PSF_R").between(10, 30)
    return df.where(near & mags & (F.abs("WAVG_SPREAD_MODEL_R") < 0.002)).select(
        "CATALOG_ID", "RA", "DEC", "HPX2048", "WAVG_MAG_PSF_G", "WAVG_MAG_PSF_R", "WAVG_SPREAD_MODEL_R"
    )


def globular_cluster_stars(df: DataFrame, coord: str = "equ") -> DataFrame:
    return stars_near(df, 323.36, -0.82, coord)


def dwarf_galaxy_stars(df: DataFrame, coord: str = "equ") -> DataFrame:
    return stars_near(df, 40.0, -34.4, coord)


def edge_extract(t: Tables, pattern: str) -> DataFrame:
    """Positions on the chip of the objects of matching files. Table: se_object."""
    return t["se_object"].where(F.col("FILENAME").like(pattern)).select("RA", "DEC", "FLUX_PSF", "FLUX_AUTO", "X_IMAGE", "Y_IMAGE")


def first_year_edge_extract(t: Tables, expnum: int | None) -> DataFrame:
    """The same for first-year tables: eval, objects, image."""
    ev = t["eval"].where(_is("EXPNUM", expnum)).select("EXPOSUREID")
    image = t["image"].select("EXPOSUREID", F.col("ID").alias("IMAGEID"))
    return ev.join(image, "EXPOSUREID").join(t["objects"], "IMAGEID").select("RA", "DEC", "MAG_PSF", "MAG_AUTO", "X_IMAGE", "Y_IMAGE")
