"""Statistics, quality rules and set operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyfold.functions.guards import above
from skyfold.operators import quality, relational, stats
from skyfold.operators.survey import largest_exposures
from skyfold.plans import views
from skyfold.plans.column_queries import ROW_SQL, _rows
from skyfold.plans.shared import as_long, calibrated, objects, rounded
from skyfold.plans.views import oracle
from skyfold.schema import OBJECT_ID
from skyfold.sources import io

MAG = "-25e-1*log10(FLUX_PSF) + 30"
ERR = "25e-1/ln(10e0)*FLUXERR_PSF/FLUX_PSF"


def _mags(spark, sf):
    return views.detections(spark, sf).withColumns({"mag": F.expr(MAG), "err": F.expr(ERR)})


def hist_summary(spark, sf):
    hist = stats.histogram(_mags(spark, sf), ["BAND"], "mag", 17.0, 24.0, 28)
    return as_long(rounded(stats.cumulative_from_top(hist, ["BAND"])), "bin", "n_above")


_BIN = "CASE WHEN mag = 24 THEN 27 WHEN mag >= 17 AND mag < 24 THEN least(CAST(floor((mag - 17)/25e-2 + 1e-9) AS BIGINT), 27) END"
HIST_SQL = oracle(
    f"SELECT BAND, bin, n, round(17 + bin*25e-2, 6) AS \"left\", CAST(sum(n) OVER (PARTITION BY BAND ORDER BY bin DESC) AS BIGINT) AS n_above FROM (SELECT BAND, {_BIN} AS bin, count(*) AS n FROM "
    f"(SELECT BAND, {MAG} AS mag FROM detections_v) GROUP BY 1, 2) WHERE bin IS NOT NULL", "detections_v",
)


def hist_overflow(spark, sf):
    hist = stats.histogram(_mags(spark, sf), ["BAND"], "mag", 18.0, 19.0, 10, overflow=True)
    return as_long(hist.select("BAND", "bin", "n"), "bin")


OVERFLOW_SQL = oracle(
    f"SELECT BAND, CASE WHEN m = 19 THEN 9 ELSE least(CAST(floor((m - 18)/(1e0/10) + 1e-9) AS BIGINT), 9) END AS bin, count(*) AS n FROM (SELECT BAND, greatest(least({MAG}, 19), 18) AS m FROM detections_v) GROUP BY 1, 2", "detections_v",
)


def hist_2d(spark, sf):
    return as_long(stats.histogram2d(_mags(spark, sf), "mag", "SPREAD_MODEL", (17.0, 24.0, 14), (-0.0105, 0.0105, 21)), "xbin", "ybin")


HIST2D_SQL = oracle(
    f"SELECT * FROM (SELECT CASE WHEN mag >= 17 AND mag < 24 THEN least(CAST(floor((mag - 17)/5e-1 + 1e-9) AS BIGINT), 13) END AS xbin, least(CAST(floor((SPREAD_MODEL + 105e-4)/1e-3 + 1e-9) AS BIGINT), 20) AS ybin, count(*) AS n FROM "
    f"(SELECT *, {MAG} AS mag FROM detections_v) GROUP BY 1, 2) WHERE xbin IS NOT NULL", "detections_v",
)


def mode_mag(spark, sf):
    df = _mags(spark, sf)
    peak = stats.histogram_peak(df, ["BAND"], "mag", 17.0, 24.0, 28)
    return rounded(stats.histogram_mode(df, ["BAND"], "mag", 17.0, 24.0, 0.25).join(peak, "BAND"))


MODE_SQL = oracle(
    f"SELECT BAND, round(17 + bin*25e-2, 6) AS mode, round(17 + bin*25e-2 + 125e-3, 6) AS peak FROM (SELECT BAND, {_BIN} AS bin, count(*) AS n FROM (SELECT BAND, {MAG} AS mag FROM detections_v) GROUP BY 1, 2) WHERE bin IS NOT NULL "
    "QUALIFY row_number() OVER (PARTITION BY BAND ORDER BY n DESC, bin) = 1", "detections_v",
)


def kde_mode(spark, sf):
    """Mode of the error distribution per band, by kernel density."""
    return rounded(stats.density_mode(_mags(spark, sf), ["BAND"], "err"))


KDE_SQL = oracle(
    f", v AS (SELECT BAND, {ERR} AS e FROM detections_v), h AS (SELECT BAND, pow(count(*), -2e-1)*stddev_samp(e) AS h FROM v GROUP BY BAND), c AS (SELECT BAND, e, count(*) AS k FROM v GROUP BY BAND, e) "
    "SELECT BAND, round(g/999e0, 6) AS mode FROM (SELECT c.BAND, g, sum(k*exp(-5e-1*pow((g/999e0 - e)/h, 2))) AS s FROM c JOIN h USING (BAND), range(1000) t(g) GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY BAND ORDER BY s DESC, g) = 1", "detections_v",
)


def summary(spark, sf):
    return rounded(stats.distribution_summary(_mags(spark, sf), ["BAND"], "mag"))


SUMMARY_SQL = oracle(
    "SELECT BAND, " + ", ".join(f"round(quantile_cont(mag, {q}e-2), 6) AS q{q:02d}" for q in (5, 16, 50, 84, 95))
    + ", count(*) AS n, round(avg(mag), 6) AS mean, round(stddev_pop(mag), 6) AS std, round(sqrt(avg(mag*mag)), 6) AS rms, round(quantile_cont(mag, 84e-2) - quantile_cont(mag, 16e-2), 6) AS width68 "
    f"FROM (SELECT BAND, {MAG} AS mag FROM detections_v) GROUP BY BAND", "detections_v",
)


def clipped_stats(spark, sf):
    return rounded(stats.quartile_clipped(_mags(spark, sf), ["BAND"], "mag", 2.0))


CLIPPED_SQL = oracle(
    f", v AS (SELECT BAND, {MAG} AS mag FROM detections_v), q AS (SELECT BAND, median(mag) AS med, 2*74e-2*(quantile_cont(mag, 75e-2) - quantile_cont(mag, 25e-2)) AS c FROM v GROUP BY BAND) "
    "SELECT BAND, round(any_value(med), 6) AS median, round(any_value(c), 6) AS clip, round(avg(mag), 6) AS mean, round(stddev_pop(mag), 6) AS std, round(sqrt(avg(mag*mag)), 6) AS rms, count(*) AS n_kept FROM v JOIN q USING (BAND) "
    "WHERE NOT abs(mag - med) > c GROUP BY BAND", "detections_v",
)


def binned_error(spark, sf):
    out = stats.binned_error(_mags(spark, sf), "mag", "err", 17.0, 24.0, 14, ["BAND"])
    return as_long(rounded(out), "bin")


_EBIN = "least(CAST(floor((mag - 17)/5e-1 + 1e-9) AS BIGINT), 13)"
BINNED_SQL = oracle(
    f"SELECT BAND, {_EBIN} AS bin, round(median(err), 6) AS median, round(avg(err), 6) AS mean, round(stddev_pop(err), 6) AS std, count(*) AS n, round(17 + {_EBIN}*5e-1, 6) AS \"left\", round(17 + ({_EBIN} + 5e-1)*5e-1, 6) AS center "
    f"FROM (SELECT BAND, {MAG} AS mag, {ERR} AS err FROM detections_v) WHERE mag >= 17 AND mag < 24 GROUP BY BAND, {_EBIN}", "detections_v",
)


def mag_limit(spark, sf):
    df = _mags(spark, sf).withColumn("err", F.col("err") * F.pow(F.lit(10.0), (F.col("mag") - 20.0) / 2.5))
    return rounded(stats.magnitude_limit(stats.binned_error(df, "mag", "err", 17.0, 24.0, 28, ["BAND"]), ["BAND"], 0.1))


LIMIT_SQL = oracle(
    "SELECT BAND, round(mid, 6) AS maglim FROM (SELECT *, (17 + bin*25e-2 + lag(17 + bin*25e-2) OVER (PARTITION BY BAND ORDER BY bin))/2 AS mid FROM (SELECT BAND, least(CAST(floor((mag - 17)/25e-2 + 1e-9) AS BIGINT), 27) AS bin, "
    f"median(err*pow(10e0, (mag - 20)/25e-1)) AS m FROM (SELECT BAND, {MAG} AS mag, {ERR} AS err FROM detections_v) WHERE mag >= 17 AND mag < 24 GROUP BY 1, 2)) WHERE m > 1e-1 QUALIFY row_number() OVER (PARTITION BY BAND ORDER BY bin) = 1", "detections_v",
)


def confusion(spark, sf):
    """Toxic as class, quality as truth, by document length."""
    df = views.table(spark, sf, "labels").join(views.table(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id")
    mag = F.least(F.log2(F.col("n_chars") + 1.0), F.lit(20.0))
    out = stats.confusion_matrix(df, F.col("toxic") == 1, F.col("toxic") == 0, F.col("quality") == 1, F.col("quality") == 0, mag, 0.0, 2.0, 10)
    return as_long(rounded(out), "bin")


_C = {"TP": "toxic = 1 AND quality = 1", "TN": "toxic = 0 AND quality = 0", "FP": "toxic = 1 AND quality = 0", "FN": "toxic = 0 AND quality = 1", "class_npos": "toxic = 1", "class_nneg": "toxic = 0", "P": "quality = 1", "N": "quality = 0"}
CONFUSION_SQL = (
    "WITH c AS (SELECT CASE WHEN m = 20 THEN 9 ELSE CAST(floor(m/2 + 1e-9) AS BIGINT) END AS bin, " + ", ".join(f"count(*) FILTER (WHERE {v}) AS {k}" for k, v in _C.items())
    + " FROM (SELECT *, least(log2(n_chars + 1e0), 20) AS m FROM labels JOIN documents USING (doc_id)) GROUP BY 1), r AS (SELECT *, "
    + ", ".join(f"{a}/nullif({b}, 0)::double AS \"{k}\"" for k, (a, b) in stats.CONFUSION_RATIOS.items())
    + " FROM c) SELECT bin, " + ", ".join(_C) + ", " + ", ".join(f"round(\"{k}\", 6) AS \"{k}\"" for k in stats.CONFUSION_RATIOS)
    + ", round((TP + TN)/nullif(P + N, 0)::double, 6) AS ACC, round(class_npos/nullif(P + N, 0)::double, 6) AS PRV, round(TPR/nullif(FPR, 0), 6) AS PLR, round(FNR/nullif(TNR, 0), 6) AS NLR FROM r"
)


def class_cuts(spark, sf):
    df = _mags(spark, sf).withColumn("cls", F.col("CLASS_STAR") + F.col("T_EFF") / 1e2)
    return rounded(stats.class_thresholds(df, "cls", "mag", 18.0, 21.0))


CLASS_SQL = oracle(
    f", w AS (SELECT CLASS_STAR + T_EFF/1e2 AS cls FROM (SELECT *, {MAG} AS mag FROM detections_v) WHERE mag > 18 AND mag < 21), q AS (SELECT quantile_cont(cls, 8e-1) AS s, quantile_cont(cls, 2e-1) AS g FROM w) "
    "SELECT round(any_value(s), 6) AS star_threshold, round(any_value(g), 6) AS galaxy_threshold, count(*) FILTER (WHERE cls > s) AS n_star, count(*) FILTER (WHERE cls < g) AS n_galaxy FROM w, q", "detections_v",
)


def value_range(spark, sf):
    df = _mags(spark, sf)
    both = stats.value_range(df, "mag").withColumn("kind", F.lit("position"))
    return rounded(both.unionByName(stats.value_range(df, "mag", positional=False).withColumn("kind", F.lit("percentile"))))


RANGE_SQL = oracle(
    f", v AS (SELECT {MAG} AS mag FROM detections_v), r AS (SELECT mag, row_number() OVER (ORDER BY mag) - 1 AS k, count(*) OVER () AS n FROM v WHERE mag > 0) "
    "SELECT 'position' AS kind, round(max(mag) FILTER (WHERE k = floor(n*5e-3)), 6) AS vmin, round(max(mag) FILTER (WHERE k = floor(n*995e-3)), 6) AS vmax FROM r "
    "UNION ALL SELECT 'percentile', round(quantile_cont(mag, 5e-3), 6), round(quantile_cont(mag, 995e-3), 6) FROM v", "detections_v",
)


def range_rules(spark, sf):
    df = calibrated(spark, sf).withColumn(OBJECT_ID, F.col("TRUE_ID") - 3)
    df = df.withColumns({"RA": F.col("RA") * 1.1 - 5.0, "CCDNUM": F.col("CCDNUM") + 1, "FLUX_AUTO": F.col("FLUX_AUTO") - 2e3})
    new = quality.check_rules(df, ["BAND"])
    old = quality.check_rules(df, ["BAND"], which="older").withColumnsRenamed({f"bad_{r}": f"old_{r}" for r in quality.rules("older")})
    return new.join(old.drop("n_rows"), "BAND")


RULES_SQL = oracle(
    "SELECT BAND, count(*) AS n_rows, count(*) FILTER (WHERE ra < 0 OR ra > 360) AS bad_ra, count(*) FILTER (WHERE fx < 0 OR fx > 1e9) AS bad_flux, count(*) FILTER (WHERE cc < 1 OR cc > 62) AS bad_ccdnum, "
    "count(*) FILTER (WHERE MAG_ZERO < 5 OR (MAG_ZERO > 35 AND MAG_ZERO NOT IN (99, 999))) AS bad_zeropoint, count(*) FILTER (WHERE MAG_AUTO < 5 OR (MAG_AUTO > 35 AND MAG_AUTO <> 99)) AS bad_magnitude, count(*) FILTER (WHERE oid < 0) AS bad_objid, "
    "count(*) FILTER (WHERE ra < 0 OR ra > 360) AS old_ra, count(*) FILTER (WHERE fx < 0 OR fx > 1e9) AS old_flux, count(*) FILTER (WHERE MAG_ZERO > 35 OR MAG_ZERO < 25) AS old_zeropoint, "
    "count(*) FILTER (WHERE MAG_AUTO < 5 OR (MAG_AUTO > 30 AND MAG_AUTO <> 99)) AS old_magnitude, count(*) FILTER (WHERE oid < 0) AS old_objid, CAST(0 AS BIGINT) AS old_position FROM "
    "(SELECT * EXCLUDE (RA), RA*11e-1 - 5 AS ra, CCDNUM + 1 AS cc, FLUX_AUTO - 2e3 AS fx, TRUE_ID - 3 AS oid FROM calibrated_v) GROUP BY BAND", "calibrated_v",
)


def nan_rules(spark, sf):
    """NaN counts by event type; values of every thirteenth user are made NaN."""
    df = views.table(spark, sf, "events").withColumn("value", F.when(F.col("user_id") % 13 == 0, F.lit(float("nan"))).otherwise(F.col("value")))
    bad = quality.check_column(df, "value", above(F.col("value"), 50.0), ["event_type"])
    return quality.nan_counts(df, ["event_type"]).join(bad, "event_type")


NAN_SQL = "SELECT event_type, count(*) FILTER (WHERE user_id % 13 = 0) AS nan_value, count(*) FILTER (WHERE user_id % 13 <> 0 AND value > 50) AS n_bad FROM events GROUP BY event_type"


def match_fraction(spark, sf):
    df = objects(spark, sf).withColumn("file", F.floor(F.col("RA") / 45).cast("long"))
    seen = quality.match_fraction(df, "r", size=100)
    return rounded(seen)


FRACTION_SQL = oracle(
    "SELECT CAST(floor(RA/45) AS BIGINT) AS file, count(*) AS n, round(avg(CASE WHEN NEPOCHS_R > 0 THEN 1 ELSE 0 END), 6) AS fraction, avg(CASE WHEN NEPOCHS_R > 0 THEN 1 ELSE 0 END) < 1e-1 AND count(*) > 100 AS poor FROM objects_v GROUP BY 1", "objects_v",
)


def band_pairs(spark, sf):
    return rounded(quality.band_pair_fraction(objects(spark, sf)))


BAND_PAIRS_SQL = oracle(
    " UNION ALL ".join(
        f"SELECT '{a}' AS band, '{b}' AS other, count(*) FILTER (WHERE NEPOCHS_{a.upper()} > 0) AS n, count(*) FILTER (WHERE NEPOCHS_{a.upper()} > 0 AND NEPOCHS_{b.upper()} > 0) AS both, "
        f"round(count(*) FILTER (WHERE NEPOCHS_{a.upper()} > 0 AND NEPOCHS_{b.upper()} > 0)/nullif(count(*) FILTER (WHERE NEPOCHS_{a.upper()} > 0), 0)::double, 6) AS fraction, "
        f"count(*) FILTER (WHERE NEPOCHS_{a.upper()} > 0 AND NEPOCHS_{b.upper()} > 0)/nullif(count(*) FILTER (WHERE NEPOCHS_{a.upper()} > 0), 0)::double < 5e-1 AND count(*) FILTER (WHERE NEPOCHS_{a.upper()} > 0) > 10000 AS poor FROM objects_v"
        for a in "grizY" for b in "grizY" if a != b
    ), "objects_v",
)


def count_balance(spark, sf):
    df = views.detections(spark, sf)
    return quality.count_balance(df, df.where(F.col("CCDNUM") % 10 != 0)).join(
        quality.low_counts(df.withColumn("file", F.col("CCDNUM") % 3), ["file", "BAND"]).groupBy("BAND").agg(F.count(F.lit(1)).alias("low_files")), "BAND", "left"
    )


BALANCE_SQL = oracle(
    "SELECT BAND, count(*) AS n_raw, count(*) FILTER (WHERE CCDNUM % 10 <> 0) AS n_sharded, count(*) = count(*) FILTER (WHERE CCDNUM % 10 <> 0) AS balanced, any_value(lf) AS low_files FROM detections_v LEFT JOIN "
    "(SELECT BAND, count(*) AS lf FROM (SELECT BAND, CCDNUM % 3 AS file, count(*) AS n FROM detections_v GROUP BY 1, 2) WHERE n < CASE WHEN BAND = 'Y' THEN 5000 ELSE 10000 END GROUP BY BAND) USING (BAND) GROUP BY BAND", "detections_v",
)


def file_totals(spark, sf):
    """Rows and columns by file, for two files of the table folder."""
    out = None
    for name in ("lineitem", "orders"):
        df = io.with_source_file(views.table(spark, sf, name)).withColumn("file", F.substring_index("file", "/", -1))
        part = quality.totals(df, ["file"])
        out = part if out is None else out.unionByName(part)
    return as_long(out, "n_columns")


TOTALS_SQL = "SELECT 'lineitem.parquet' AS file, count(*) AS n_rows, CAST(12 AS BIGINT) AS n_columns FROM lineitem UNION ALL SELECT 'orders.parquet', count(*), CAST(7 AS BIGINT) FROM orders"


def member_semi(spark, sf):
    return relational.members(views.detections(spark, sf), views.blacklist(spark, sf).withColumnRenamed("expnum", "EXPNUM"), ["EXPNUM"]).groupBy("EXPNUM").agg(F.count(F.lit(1)).alias("n"))


def missing_extra(spark, sf):
    expected = views.exposures(spark, sf).select("unitname")
    found = views.detections(spark, sf).select(F.concat(F.lit("D"), F.lpad(((F.col("EXPNUM") + 5)).cast("string"), 8, "0")).alias("unitname"))
    return relational.missing_and_extra(expected, found, "unitname")


MISSING_SQL = oracle(
    "SELECT coalesce(e.u, f.u) AS unitname, CASE WHEN f.u IS NULL THEN 'missing' ELSE 'extra' END AS state FROM (SELECT DISTINCT unitname AS u FROM exposures_v) e FULL JOIN "
    "(SELECT DISTINCT concat('D', lpad(CAST(EXPNUM + 5 AS VARCHAR), 8, '0')) AS u FROM detections_v) f ON e.u = f.u WHERE e.u IS NULL OR f.u IS NULL", "exposures_v", "detections_v",
)


def distinct_pairs(spark, sf):
    return relational.unique_pairs(views.detections(spark, sf), "EXPNUM", "CCDNUM")


def stacked(spark, sf):
    a = views.exposures(spark, sf).select("expnum", "band", "t_eff")
    b = views.zeropoints(spark, sf).select(F.col("EXPNUM").cast("int").alias("expnum"), F.col("BAND").alias("band"), F.col("MAG_ZERO").alias("zero"))
    return relational.stack([a, b]).groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.count("t_eff").alias("n_teff"), F.round(F.sum("zero"), 4).alias("zeros"), F.sum("expnum").alias("total"))


STACK_SQL = oracle(
    "SELECT band, count(*) AS n, count(t_eff) AS n_teff, round(sum(zero), 4) AS zeros, CAST(sum(expnum) AS BIGINT) AS total FROM (SELECT expnum, band, t_eff, NULL::double AS zero FROM exposures_v UNION ALL "
    "SELECT EXPNUM, BAND, NULL, MAG_ZERO FROM zeropoints_v) GROUP BY band", "exposures_v", "zeropoints_v",
)


def sorted_zeropoints(spark, sf):
    return rounded(views.zeropoints(spark, sf).select("EXPNUM", "CCDNUM", "MAG_ZERO").orderBy("EXPNUM", "CCDNUM"))


def spread_by_exposure(spark, sf):
    """Spread histogram of the exposures with most detections (a top-k report)."""
    df = views.detections(spark, sf)
    top = largest_exposures(df, 5).select("EXPNUM")
    hist = stats.histogram(df.join(top, "EXPNUM", "left_semi"), ["EXPNUM"], "SPREAD_MODEL", -0.0105, 0.0105, 21)
    return as_long(hist.select("EXPNUM", "bin", "n"), "bin")


TOP_HIST_SQL = oracle(
    "SELECT EXPNUM, least(CAST(floor((SPREAD_MODEL + 105e-4)/1e-3 + 1e-9) AS BIGINT), 20) AS bin, count(*) AS n FROM detections_v WHERE EXPNUM IN (SELECT EXPNUM FROM detections_v GROUP BY EXPNUM ORDER BY count(*) DESC, EXPNUM LIMIT 5) GROUP BY 1, 2", "detections_v",
)


def pending_work(spark, sf):
    """Exposures whose output is missing or older than the input, in chunks."""
    exp = views.exposures(spark, sf).select("expnum", (F.col("nite") % 1000).alias("in_mtime"))
    done = exp.where("expnum % 4 <> 0").select("expnum", F.lit(500).alias("out_mtime"))
    work = io.pending(exp, done, ["expnum"])
    return io.chunked(work, "expnum", 100).groupBy("chunk").agg(F.count(F.lit(1)).alias("n"), F.min("expnum").alias("first"), F.max("expnum").alias("last"))


PENDING_SQL = oracle(
    "SELECT chunk, count(*) AS n, min(expnum) AS first, max(expnum) AS last FROM (SELECT expnum, CAST(floor((row_number() OVER (ORDER BY expnum) - 1)/100) AS BIGINT) AS chunk FROM exposures_v WHERE expnum % 4 = 0 OR nite % 1000 > 500) GROUP BY chunk", "exposures_v",
)


def inserted_columns(spark, sf):
    """Columns inserted by key into the detections."""
    df = views.detections(spark, sf)
    new = df.select("det_id", (F.col("FLUX_PSF") * 2).alias("DOUBLE_FLUX"), F.lit(0.0).alias("T_EFF"))
    out = io.insert_columns(df, new, ["det_id"])
    return rounded(_rows(out, "DOUBLE_FLUX", "T_EFF"))


QUERIES = {
    "hist_summary": (hist_summary, HIST_SQL),
    "hist_overflow": (hist_overflow, OVERFLOW_SQL),
    "hist_2d": (hist_2d, HIST2D_SQL),
    "mode_mag": (mode_mag, MODE_SQL),
    "kde_mode": (kde_mode, KDE_SQL),
    "distribution_summary": (summary, SUMMARY_SQL),
    "clipped_stats": (clipped_stats, CLIPPED_SQL),
    "binned_error": (binned_error, BINNED_SQL),
    "mag_limit": (mag_limit, LIMIT_SQL),
    "confusion": (confusion, CONFUSION_SQL),
    "class_cuts": (class_cuts, CLASS_SQL),
    "value_range": (value_range, RANGE_SQL),
    "range_rules": (range_rules, RULES_SQL),
    "nan_rules": (nan_rules, NAN_SQL),
    "match_fraction": (match_fraction, FRACTION_SQL),
    "band_pairs": (band_pairs, BAND_PAIRS_SQL),
    "count_balance": (count_balance, BALANCE_SQL),
    "file_totals": (file_totals, TOTALS_SQL),
    "member_semi": (member_semi, oracle("SELECT EXPNUM, count(*) AS n FROM detections_v WHERE EXPNUM IN (SELECT expnum FROM blacklist_v) GROUP BY EXPNUM", "detections_v", "blacklist_v")),
    "missing_extra": (missing_extra, MISSING_SQL),
    "distinct_pairs": (distinct_pairs, oracle("SELECT DISTINCT EXPNUM, CCDNUM FROM detections_v", "detections_v")),
    "stack": (stacked, STACK_SQL),
    "sorted": (sorted_zeropoints, oracle("SELECT EXPNUM, CCDNUM, round(MAG_ZERO, 6) AS MAG_ZERO FROM zeropoints_v ORDER BY EXPNUM, CCDNUM", "zeropoints_v")),
    "spread_by_exposure": (spread_by_exposure, TOP_HIST_SQL),
    "pending_work": (pending_work, PENDING_SQL),
    "inserted_columns": (inserted_columns, oracle(f"SELECT {ROW_SQL}, round(FLUX_PSF*2, 6) AS DOUBLE_FLUX, round(T_EFF, 6) AS T_EFF FROM detections_v", "detections_v")),
}
