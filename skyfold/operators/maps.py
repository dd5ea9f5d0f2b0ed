"""Sky maps as sparse tables ``(pix, value)``; a pixel without data has no row."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from skyfold.functions.coords import angular_separation, equatorial_to_galactic
from skyfold.functions.guards import above, below, finite, inside
from skyfold.functions.healpix import parent_pixel, pixel_area_deg2, with_interpolation, with_pixel
from skyfold.functions.photometry import MAG_PER_RATIO, predicted_gaia_g
from skyfold.functions.selections import galaxy_density_cut, star_selection
from skyfold.operators.quantiles import exact_median, exact_percentiles
from skyfold.operators.spatial import ARCSEC, nearest_join, nearest_other
from skyfold.operators.stats import density_mode, histogram_mode
from skyfold.schema import BANDS, HPX_NSIDE, OBJECT_ID, band_column
from skyfold.session import materialize

MAS = 3600.0 * 1000.0


def interpolate_map(
    df: DataFrame, sky_map: DataFrame, nside: int, id_col: str, ra: str = "RA", dec: str = "DEC", value: str = "value", name: str = "value", galactic: bool = True
) -> DataFrame:
    """Bilinear interpolation of a map at each position; NULL where a pixel that counts has no value.

    Only (id, pixel, weight) rows travel; the map side has one row per pixel.
    """
    lon, lat = equatorial_to_galactic(F.col(ra), F.col(dec)) if galactic else (F.col(ra), F.col(dec))
    taps = with_interpolation(df.select(F.col(id_col).alias("_id"), lon.alias("_lon"), lat.alias("_lat")), nside, "_lon", "_lat", "_taps")
    taps = taps.withColumn("_taps", F.filter("_taps", lambda t: t.weight > 0))
    taps = taps.select("_id", F.size("_taps").alias("_need"), F.explode("_taps").alias("_t")).select("_id", "_need", F.col("_t.pix").alias("pix"), F.col("_t.weight").alias("_w"))
    met = taps.join(sky_map.select("pix", F.col(value).alias("_v")), "pix").where(F.col("_v").isNotNull())
    total = F.when(F.count("_v") == F.max("_need"), F.sum(F.col("_w") * F.col("_v")))
    summed = met.groupBy("_id").agg(total.alias(name))
    return df.drop(name).join(summed, F.col(id_col) == F.col("_id"), "left").drop("_id")


def footprint_counts(df: DataFrame, nside: int, selections: Mapping[str, Column], pix: str | None = None, deredden: Sequence[str] = (), mag_field: str = "WAVG_MAG_PSF") -> DataFrame:
    """Counts per pixel for many named selections in one pass. ``deredden`` lists bands to correct first."""
    if deredden:
        df = df.withColumns({band_column(mag_field, b): F.col(band_column(mag_field, b)) - F.col(band_column("EXTINCTION", b)) for b in deredden})
    staged = df if pix else with_pixel(df, nside, name="pix")
    counts = [F.count_if(sel).alias(name) for name, sel in selections.items()]
    return staged.groupBy(F.col(pix or "pix").alias("pix")).agg(*counts)


def galaxy_density(df: DataFrame, nside: int = 128, hpx: str = f"HPX{HPX_NSIDE}") -> DataFrame:
    """Galaxies per square degree in nested pixels, from the stored fine index."""
    kept = df.where(galaxy_density_cut())
    pix = parent_pixel(F.col(hpx), HPX_NSIDE, nside).alias("pix")
    return kept.groupBy(pix).agg((F.count(F.lit(1)) / F.lit(pixel_area_deg2(nside))).alias("density"))


def log_density(df: DataFrame, nside: int = 1024, mag: str = "MAG_PSF_G", limit: float = 23.0) -> DataFrame:
    staged = with_pixel(df.where(below(F.col(mag), limit)), nside)
    return staged.groupBy("pix").agg(F.count(F.lit(1)).alias("n")).withColumn("log_density", F.log10(F.col("n") / pixel_area_deg2(nside)))


def unpivot_bands(df: DataFrame, fields: Sequence[str], keep: Sequence[str], bands: Sequence[str] = BANDS) -> DataFrame:
    """Long form: ``keep``, ``band`` and one column per field."""
    rows = F.array(*[F.struct(F.lit(b).alias("band"), *[F.col(band_column(f, b)).cast("double").alias(f) for f in fields]) for b in bands])
    return df.select(*keep, F.explode(rows).alias("_r")).select(*keep, "_r.*")


def bright_ends(df: DataFrame, keys: Sequence[str], mag: str, start: float = 17.0, stop: float = 29.9, width: float = 0.1) -> DataFrame:
    """Left edge of the fullest magnitude bin (first on ties), less 3 mag."""
    modes = histogram_mode(df, keys, mag, start, stop, width)
    return modes.select(*keys, (F.col("mode") - 3.0).alias("bright_end"))


def depth_map(
    df: DataFrame, id_col: str, nside: int = 1024, snr: float = 10.0, kind: str = "PSF", bands: Sequence[str] = BANDS, group: str = "HPX",
    mag_start: float = 17.0, snr_mode: str = "pogson", cut_field: str | None = None,
) -> DataFrame:
    """Magnitude limit at a signal-to-noise ratio: ``band, pix, maglim``.

    Per (shard, band): stars (PSF) or all objects (AUTO) brighter rows cut at the modal magnitude less 3; the slope of
    log error against magnitude is the mode of the slopes between nearest neighbours; each object's
    limit follows and the map takes the median.
    ``snr_mode="inverse"`` uses error 1/snr. ``cut_field`` names the magnitude the cuts are made on.
    """
    mag, err = f"MAG_{kind}", f"MAGERR_{kind}"
    cut = cut_field or mag
    fields = list(dict.fromkeys([mag, err, cut] + (["WAVG_SPREAD_MODEL"] if kind == "PSF" else [])))
    rows = unpivot_bands(df, fields, [group, id_col, "RA", "DEC"], bands)
    rows = materialize(rows.where(F.col(cut).isNotNull()), "bands")
    ends = bright_ends(rows, [group, "band"], cut, mag_start)
    keep = above(F.col(cut) - F.col("bright_end"), 0.0) & below(F.col(cut), 30.0)
    if kind == "PSF":
        keep = keep & below(F.abs(F.col("WAVG_SPREAD_MODEL")), 0.002)
    chosen = rows.join(ends, [group, "band"]).where(keep).select(group, "band", id_col, "RA", "DEC", F.col(mag).alias("mag"), F.col(err).alias("err"))
    chosen = materialize(chosen, "chosen")
    pairs = nearest_other(chosen, id_col, group=[group, "band"])
    side = chosen.select(group, "band", F.col(id_col).alias("id"), F.col("mag").alias("m0"), F.log10(F.when(F.col("err") > 0, F.col("err"))).alias("l0"))
    other = side.withColumnsRenamed({"id": "other_id", "m0": "m1", "l0": "l1"})
    both = pairs.join(side, [group, "band", "id"]).join(other, [group, "band", "other_id"])
    dm = F.col("m1") - F.col("m0")
    ratio = F.try_divide(F.col("l1") - F.col("l0"), dm)
    slopes = both.withColumns({"slope": ratio, "dm": dm}).where(finite(F.col("slope")) & above(F.col("dm"), 0.5))
    modes = density_mode(slopes.select(group, "band", "slope"), [group, "band"], "slope")
    target = MAG_PER_RATIO / snr if snr_mode == "pogson" else 1.0 / snr
    log_err = F.log10(F.when(F.col("err") > 0, F.col("err")))
    limits = with_pixel(chosen.join(modes, [group, "band"]), nside)
    limits = limits.withColumn("limit", F.col("mag") - F.try_divide(log_err - math.log10(target), F.col("mode")))
    return exact_median(limits.select("band", "pix", "limit"), ["band", "pix"], "limit", "maglim")


def sparse_depth_map(df: DataFrame, id_col: str, nside: int = 1024, snr: float = 10.0, bands: Sequence[str] = BANDS, group: str = "HPX") -> DataFrame:
    """Older depth variant, one column ``MAGLIM_b`` per band."""
    long = depth_map(df, id_col, nside, snr, "PSF", bands, group, 15.0, "inverse", "WAVG_MAG_PSF")
    return long.groupBy("pix").agg(*[F.max(F.when(F.col("band") == b, F.col("maglim"))).alias(band_column("MAGLIM", b)) for b in bands])


def exposure_map(df: DataFrame, nside: int, mode: str = "median", bands: Sequence[str] = BANDS, field: str = "T_EFF") -> DataFrame:
    """Median or mean effective exposure per pixel and band."""
    if mode not in ("median", "mean"):
        raise ValueError(f"unrecognized mode: {mode}")
    rows = with_pixel(unpivot_bands(df, [field], ["RA", "DEC"], bands), nside)
    if mode == "median":
        return exact_median(rows, ["band", "pix"], field, "t_eff")
    return rows.groupBy("band", "pix").agg(F.avg(field).alias("t_eff"))


def median_map(df: DataFrame, value: str, nside: int | None = None, ra: str = "RA", dec: str = "DEC", name: str = "value", pix: str | None = None) -> DataFrame:
    staged = df.withColumn("pix", F.col(pix)) if pix else with_pixel(df, nside, ra, dec)
    return exact_median(staged, ["pix"], value, name, extra=[F.count(value).alias("n")])


def external_offsets(df: DataFrame, reference: DataFrame, id_col: str, ref_id: str, band: str = "r", arcsec: float = 2.0) -> DataFrame:
    """Separation (mas) of bright stars from the nearest external source within 2 arcseconds."""
    b = lambda f: band_column(f, band)
    stars = df.where(star_selection(b("WAVG_SPREAD_MODEL"), b("MAG_PSF"), 16, 19, b("NEPOCHS")))
    near = nearest_join(stars, reference, arcsec * ARCSEC, id_col, ref_id, left_cols=["RA", "DEC"], strict=True)
    return near.withColumn("sep_mas", F.col("sep") * MAS)


def external_astrometry(df: DataFrame, reference: DataFrame, id_col: str, ref_id: str, nside: int = 128, band: str = "r") -> DataFrame:
    return median_map(external_offsets(df, reference, id_col, ref_id, band), "sep_mas", nside)


def internal_offsets(catalog: DataFrame, detections: DataFrame, band: str = "r", objid: str = OBJECT_ID) -> DataFrame:
    """Separation (mas) of each epoch from its own coadd position; ``band="griz"`` takes all epochs."""
    chosen = "r" if band == "griz" else band
    b = lambda f: band_column(f, chosen)
    stars = catalog.where(star_selection(b("WAVG_SPREAD_MODEL"), b("MAG_PSF"), 17, 21, b("NEPOCHS"))).select(objid, "RA", "DEC")
    epochs = detections if band == "griz" else detections.where(F.rtrim("BAND") == band)
    epochs = epochs.select(objid, F.col("RA").alias("_ra"), F.col("DEC").alias("_dec"))
    sep = angular_separation(F.col("RA"), F.col("DEC"), F.col("_ra"), F.col("_dec"))
    joined = stars.join(epochs, objid).withColumn("sep", sep).where(F.col("sep") * 3600.0 > 1e-5)
    return joined.withColumn("sep_mas", F.col("sep") * MAS).drop("_ra", "_dec")


def internal_astrometry(catalog: DataFrame, detections: DataFrame, nside: int = 128, band: str = "r", objid: str = OBJECT_ID) -> DataFrame:
    return median_map(internal_offsets(catalog, detections, band, objid), "sep_mas", nside)


def gaia_matches(df: DataFrame, gaia: DataFrame, id_col: str, gaia_id: str, version: str = "edr3", field: str = "WAVG_", zero_shift: bool = False) -> DataFrame:
    """Stars with their predicted and observed Gaia G (``gaia`` has ``PHOT_G_MEAN_MAG_AB``).

    ``zero_shift`` first moves magnitudes from ``MAG_ZERO_b`` to ``ALT_ZPT_b`` and drops stars whose zeropoints differ
    by 0.1 or more in any band.
    """
    bands = ("g", "r", "i", "z")
    mags = {b: band_column(f"{field}MAG_PSF", b) for b in bands}
    if zero_shift:
        shift = {b: F.col(band_column("ALT_ZPT", b)) - F.col(band_column("MAG_ZERO", b)) for b in bands}
        near = [below(F.abs(s), 0.1) for s in shift.values()]
        for condition in near:
            df = df.where(condition)
        df = df.withColumns({mags[b]: F.col(mags[b]) + shift[b] for b in bands})
    stars = df.where(
        star_selection(
            band_column(f"{field}SPREAD_MODEL", "r"), mags["r"], 16, 20, band_column("NEPOCHS", "r"),
            (mags["g"], mags["i"], 0.5, 1.5), list(mags.values()),
        )
    )
    faint = gaia.where(below(F.col("PHOT_G_MEAN_MAG_AB"), 20.0))
    near = nearest_join(
        stars, faint, 0.5 * ARCSEC, id_col, gaia_id, left_cols=["RA", "DEC", *mags.values()], right_cols=["PHOT_G_MEAN_MAG_AB"], strict=True
    )
    return near.withColumn("G_PRED", predicted_gaia_g(*[F.col(mags[b]) for b in bands], version=version)).withColumnRenamed("PHOT_G_MEAN_MAG_AB", "G_OBS")


def gaia_photometry(df: DataFrame, gaia: DataFrame, id_col: str, gaia_id: str, nside: int = 64, version: str = "edr3") -> DataFrame:
    diff = gaia_matches(df, gaia, id_col, gaia_id, version).withColumn("diff", F.col("G_PRED") - F.col("G_OBS"))
    return median_map(diff, "diff", nside)


def catalog_photometry(df: DataFrame, other: DataFrame, id_col: str, other_id: str, band: str, nside: int = 64) -> DataFrame:
    """Median magnitude difference from another catalog with the same columns."""
    b = lambda f: band_column(f, band)
    stars = star_selection(b("WAVG_SPREAD_MODEL"), b("WAVG_MAG_PSF"), 16, 20, b("NEPOCHS"))
    mag = b("WAVG_MAG_PSF")
    right = other.where(stars).withColumn("_other_mag", F.col(mag))
    near = nearest_join(df.where(stars), right, 0.5 * ARCSEC, id_col, other_id, left_cols=["RA", "DEC", mag], right_cols=["_other_mag"], strict=True)
    return median_map(near.withColumn("diff", F.col(mag) - F.col("_other_mag")), "diff", nside)


def weighted_rms_photometry(df: DataFrame, band: str, nside: int = 64) -> DataFrame:
    b = lambda f: band_column(f, band)
    rms = b("WAVG_MAGRMS_PSF")
    stars = df.where(star_selection(b("WAVG_SPREAD_MODEL"), b("WAVG_MAG_PSF"), 16, 17, b("NEPOCHS")) & below(F.col(rms), 90.0))
    return median_map(stars, rms, nside)


def object_rms(detections: DataFrame, objid: str = OBJECT_ID) -> DataFrame:
    """Median position and sample deviation of the magnitudes of each object's stellar detections."""
    stars = detections.where(star_selection("SPREAD_MODEL", "MAG_PSF", 16, 18))
    extra = [F.count("MAG_PSF").alias("n"), F.stddev_samp("MAG_PSF").alias("rms")]
    return exact_percentiles(stars, [objid], {"RA": ("RA", 0.5), "DEC": ("DEC", 0.5)}, extra=extra)


def detection_rms_photometry(detections: DataFrame, nside: int = 64, objid: str = OBJECT_ID) -> DataFrame:
    return median_map(object_rms(detections, objid), "rms", nside)


def zeropoint_difference_maps(pairs: DataFrame, nside: int | None = None, pix: str | None = None, colors: Sequence[tuple[str, str]] = (("g", "r"), ("r", "i"), ("i", "z"))) -> DataFrame:
    """Median zeropoint of both sets and their difference per pixel and band, and colour differences.

    One row per pixel; columns ``first_b, second_b, diff_b`` and ``color_b1b2``.
    """
    staged = pairs.withColumn("pix", F.col(pix)) if pix else with_pixel(pairs, nside, "ra_2", "dec_2")
    stats = exact_percentiles(staged, ["pix", "BAND"], {"first": ("zero_1", 0.5), "second": ("zero_2", 0.5), "diff": ("dzero", 0.5)})
    names = list(dict.fromkeys(b for pair in colors for b in pair))
    wide = stats.groupBy("pix").agg(*[F.max(F.when(F.col("BAND") == b, F.col(f))).alias(f"{f}_{b}") for b in names for f in ("first", "second", "diff")])
    shift = lambda f, c: F.col(f"{f}_{c[0]}") - F.col(f"{f}_{c[1]}")
    return wide.withColumns({f"color_{c[0]}{c[1]}": shift("first", c) - shift("second", c) for c in colors})


def release_residuals(first: DataFrame, second: DataFrame, first_id: str, second_id: str, bands: Sequence[str], arcsec: float = 1.0, group: str | None = None) -> DataFrame:
    """Magnitude residuals between two releases: one row per matched object and band."""
    out = None
    for b in bands:
        mag = band_column("WAVG_MAG_PSF", b)
        left = first.where(inside(F.col(mag), 17, 22)).withColumn("_m1", F.col(mag))
        right = second.where(inside(F.col(mag), 17, 22) & below(F.col("WAVG_SPREAD_MODEL_R"), 0.002)).withColumn("_m2", F.col(mag))
        near = nearest_join(
            left, right, arcsec * ARCSEC, first_id, second_id, left_cols=["_m1", *([group] if group else [])], right_cols=["_m2"], strict=True
        )
        part = near.select(*([group] if group else []), F.lit(b).alias("band"), "left_id", "right_id", (F.col("_m2") - F.col("_m1")).alias("residual"))
        out = part if out is None else out.unionByName(part)
    return out
