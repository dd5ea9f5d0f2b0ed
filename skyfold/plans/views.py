"""Survey tables derived from the driver tables, as Spark DataFrames and as SQL text for the oracle.

Both engines evaluate the same expressions; the few that differ are given per dialect. Constants are written ``1e2``
because Spark reads ``100.0`` as a decimal.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

DET_KEY = ["l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate"]
BASE_RA, BASE_DEC = "({k}*7919 % 36000)/1e2 + 5e-3", "({k}*104729 % 9000)/1e2 - 60"

DETECTION_COLUMNS = {
    "EXPNUM": "l_orderkey",
    "CCDNUM": "1 + l_suppkey % 62",
    "BAND": "substr('grizY', 1 + cast(l_orderkey % 5 as int), 1)",
    "TRUE_ID": "l_partkey",
    "RA": BASE_RA.format(k="l_partkey") + " + ((l_orderkey*31 + l_suppkey*17) % 41 - 20)*0.3e0/20/3600",
    "DEC": BASE_DEC.format(k="l_partkey") + " + ((l_orderkey*13 + l_suppkey*29) % 41 - 20)*0.3e0/20/3600",
    "FLUX_PSF": "l_extendedprice",
    "FLUXERR_PSF": "l_extendedprice*(1e-2 + l_tax)",
    "FLUX_AUTO": "l_extendedprice*(1 + l_discount)",
    "FLUXERR_AUTO": "l_extendedprice*(1e-2 + l_tax)",
    "T_EFF": "1e-1 + l_quantity/5e1",
    "EXPTIME": "9e1",
    "FLAGS": "l_linenumber - 1",
    "IMAFLAGS_ISO": "cast(case when l_partkey % 3 = 0 then 2048 when l_partkey % 3 = 1 then 0 else l_partkey % 4096 end as int)",
    "SPREAD_MODEL": "(l_suppkey % 21 - 10)/1e3 + 37e-5",
    "SPREADERR_MODEL": "1e-3 + l_discount/1e2",
    "CLASS_STAR": "(l_suppkey % 11)/1e1",
    "A_IMAGE": "1e0 + l_tax",
    "B_IMAGE": "1e0 - l_tax",
    "THETA_IMAGE": "l_discount*9e2",
    "FWHM_WORLD": "3e-4 + l_tax/1e3",
    "XWIN_IMAGE": "(l_suppkey*97 + l_orderkey) % 2048",
    "YWIN_IMAGE": "(l_suppkey*53 + l_partkey) % 4096",
    "OBJECT_NUMBER": "l_linenumber",
    "FILENAME": "concat('D', lpad(cast(l_orderkey as string), 8, '0'), '_', substr('grizY', 1 + cast(l_orderkey % 5 as int), 1), '_c', "
                "lpad(cast(1 + l_suppkey % 62 as string), 2, '0'), '_r1p01_cat.fits')",
}
MJD = {"spark": "cast(datediff(l_shipdate, date'1858-11-17') as double)", "duck": "cast(datediff('day', date '1858-11-17', cast(l_shipdate as date)) as double)"}

EXPOSURE_COLUMNS = {
    "expnum": "o_orderkey",
    "telra": BASE_RA.format(k="o_custkey"),
    "teldec": BASE_DEC.format(k="o_custkey"),
    "band": "substr('grizY', 1 + cast(o_orderkey % 5 as int), 1)",
    "t_eff": "1e-1 + (o_orderkey*37 % 1000)/4e2",
    "exptime": "3e1 + 3e1*(o_orderkey % 3)",
    "skytilt": "(o_orderkey % 25)/2e2",
    "flag": "case when o_orderkey % 4 = 0 then 0 when o_orderkey % 4 = 1 then 1000*(o_orderkey % 30) else o_orderkey % 50 end",
    "accepted": "case when o_orderkey % 3 = 0 then 'False' else 'True' end",
    "program": "case when o_custkey % 5 = 0 then 'supernova' else 'survey' end",
    "tag": "concat('TAG_', o_orderstatus)",
    "propid": "case when o_custkey % 7 = 0 then '2012B-0001' when o_custkey % 7 = 1 then '2016A-0366' else '2014B-0404' end",
    "obstype": "case when o_custkey % 9 = 0 then 'dark' else 'object' end",
    "attempt": "o_orderkey*10 + 1",
    "unitname": "concat('D', lpad(cast(o_orderkey as string), 8, '0'))",
    "path": "case when o_custkey % 11 = 0 then '' else concat('/raw/', substr('grizY', 1 + cast(o_orderkey % 5 as int), 1)) end",
}
NITE = {"spark": "cast(date_format(o_orderdate, 'yyyyMMdd') as int)", "duck": "cast(strftime(o_orderdate, '%Y%m%d') as int)"}

REFERENCE_COLUMNS = {
    "OBJID": "p_partkey",
    "RA": BASE_RA.format(k="p_partkey"),
    "DEC": BASE_DEC.format(k="p_partkey"),
    "DUPVAR": "cast(p_partkey % 4 as int)",
    "G": "17e0 + (p_partkey % 400)/1e2 + 2e-1 + (p_partkey % 120)/1e2",
    "R": "17e0 + (p_partkey % 400)/1e2",
    "I": "17e0 + (p_partkey % 400)/1e2 - (p_partkey % 30)/1e2",
    "Z": "17e0 + (p_partkey % 400)/1e2 - (p_partkey % 30)/1e2 - (p_partkey % 50)/1e2 + 1e-1",
    **{f"D{b}": f"1e-2 + (p_partkey % {m})/1e3" for b, m in zip("GRIZ", (41, 47, 53, 59))},
    **{f"{b}CHI": f"cast(p_partkey % {m} as double)" for b, m in zip("GRIZ", (13, 17, 12, 14))},
    **{f"{b}CONTRIB": f"cast(p_partkey % {m} as int)" for b, m in zip("GRIZ", (8, 7, 9, 11))},
    "PHOT_G_MEAN_FLUX": "1e2 + p_retailprice*(p_partkey % 90)",
}

ZEROPOINT_SELECT = {
    "EXPNUM": "EXPNUM", "CCDNUM": "CCDNUM", "BAND": "BAND", "MAG_ZERO": "30 + (EXPNUM % 100)/1e2", "SIGMA_MAG_ZERO": "1e-2 + (CCDNUM % 10)/1e3",
    "ZP_FLAG": "case when EXPNUM % 7 = 0 then 1 else 0 end", "RA": "(EXPNUM*7919 % 36000)/1e2 + CCDNUM/1e2", "DEC": "(EXPNUM*104729 % 9000)/1e2 - 60 + CCDNUM/1e2",
}


def _select(columns: dict[str, str]) -> str:
    return ", ".join(f"{expr} AS {name}" for name, expr in columns.items())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per lineitem, with ``det_id``, the natural key."""
    columns = [f"{e} AS {n}" for n, e in DETECTION_COLUMNS.items()]
    return table(spark, sf_dir, "lineitem").selectExpr(f"struct({', '.join(DET_KEY)}) AS det_id", *columns, f"{MJD['spark']} AS MJD_OBS")


def exposures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*[f"{e} AS {n}" for n, e in EXPOSURE_COLUMNS.items()], f"{NITE['spark']} AS nite")


def reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(*[f"{e} AS {n}" for n, e in REFERENCE_COLUMNS.items()])


def zeropoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = detections(spark, sf_dir).select("EXPNUM", "CCDNUM", "BAND").distinct()
    return keys.selectExpr(*[f"{e} AS {n}" for n, e in ZEROPOINT_SELECT.items()])


def blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fiftieth exposure is excluded: a small list, joined with the whole tables."""
    return blacklisted(zeropoints(spark, sf_dir))


def blacklisted(zeropoints_table: DataFrame) -> DataFrame:
    return zeropoints_table.where("EXPNUM % 50 = 0").select(F.col("EXPNUM").alias("expnum"), F.col("CCDNUM").alias("ccdnum"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sky positions from the first three vector components."""
    x, y, z = (f"cast(embedding[{i}] as double)" for i in range(3))
    return table(spark, sf_dir, "embeddings").selectExpr(
        "vec_id", f"pmod(degrees(atan2({y}, {x})), 360e0) AS RA", f"degrees(atan2({z}, sqrt({x}*{x} + {y}*{y}))) AS DEC", "label"
    )


SQL_VIEWS: dict[str, str] = {
    "detections_v": f"SELECT {', '.join(DET_KEY)}, {_select(DETECTION_COLUMNS)}, {MJD['duck']} AS MJD_OBS FROM lineitem",
    "exposures_v": f"SELECT {_select(EXPOSURE_COLUMNS)}, {NITE['duck']} AS nite FROM orders",
    "reference_v": f"SELECT {_select(REFERENCE_COLUMNS)} FROM part",
    "zeropoints_v": f"SELECT {_select(ZEROPOINT_SELECT)} FROM (SELECT DISTINCT EXPNUM, CCDNUM, BAND FROM detections_v)",
    "blacklist_v": "SELECT EXPNUM AS expnum, CCDNUM AS ccdnum FROM zeropoints_v WHERE EXPNUM % 50 = 0",
    "points_v": "SELECT vec_id, label, CASE WHEN lon < 0 THEN lon + 360 ELSE lon END AS RA, lat AS DEC FROM (SELECT vec_id, label, "
    "degrees(atan2(CAST(embedding[2] AS DOUBLE), CAST(embedding[1] AS DOUBLE))) AS lon, degrees(atan2(CAST(embedding[3] AS DOUBLE), "
    "sqrt(CAST(embedding[1] AS DOUBLE)*CAST(embedding[1] AS DOUBLE) + CAST(embedding[2] AS DOUBLE)*CAST(embedding[2] AS DOUBLE)))) AS lat FROM embeddings)",
    # usable zeropoints: flag 0, positive, not blacklisted
    "usable_zp_v": "SELECT z.* FROM zeropoints_v z WHERE MAG_ZERO > 0 AND ZP_FLAG = 0 AND NOT EXISTS (SELECT 1 FROM blacklist_v b WHERE b.expnum = z.EXPNUM AND b.ccdnum = z.CCDNUM)",
    "calibrated_v": "SELECT d.*, "
    + ", ".join(
        f"CASE WHEN z.EXPNUM IS NULL THEN 99e0 ELSE -2.5e0*log10(d.FLUX_{k}) + z.MAG_ZERO END AS MAG_{k}, "
        f"CASE WHEN z.EXPNUM IS NULL THEN 99e0 ELSE 2.5e0/ln(10e0)*(d.FLUXERR_{k}/d.FLUX_{k}) END AS MAGERR_{k}"
        for k in ("PSF", "AUTO")
    )
    + ", coalesce(z.MAG_ZERO, 99e0) AS MAG_ZERO, coalesce(z.SIGMA_MAG_ZERO, 99e0) AS SIGMA_MAG_ZERO, coalesce(z.ZP_FLAG, 2) AS ZP_FLAG "
    "FROM detections_v d LEFT JOIN usable_zp_v z ON d.EXPNUM = z.EXPNUM AND d.CCDNUM = z.CCDNUM",
    "good_v": "SELECT * FROM calibrated_v WHERE MAG_PSF > 0 AND MAG_PSF < 99 AND MAGERR_PSF > 0 AND MAGERR_PSF < 99 AND MAG_AUTO > 0 AND MAG_AUTO < 99 "
    "AND MAGERR_AUTO > 0 AND MAGERR_AUTO < 99 AND SPREAD_MODEL > -99 AND SPREAD_MODEL < 99 AND SPREADERR_MODEL > 0 AND SPREADERR_MODEL < 99 AND FLAGS < 4",
}

_NEEDS = {
    "zeropoints_v": ["detections_v"], "blacklist_v": ["zeropoints_v"], "usable_zp_v": ["zeropoints_v", "blacklist_v"],
    "calibrated_v": ["detections_v", "usable_zp_v"], "good_v": ["calibrated_v"], "band_stats_v": ["good_v"], "objects_v": ["band_stats_v", "good_v"],
    "merged_v": ["detections_v", "reference_v"],
}


def _wavg(value: str, error: str, out: tuple[str, str, str]) -> str:
    """Textbook two-pass weighted statistics over a group with mean column ``m_<out>``."""
    mean, err, rms = out
    w = f"(1e0/({error}*{error}))"
    return (
        f"sum({w}*{value})/sum({w}) AS {mean}, sqrt(sum({error}*{error}))/count(*) AS {err}, "
        f"CASE WHEN count(*) > 1 THEN sqrt(sum({w}*({value} - m_{mean})*({value} - m_{mean}))*sum({w})/nullif(sum({w})*sum({w}) - sum({w}*{w}), 0)) "
        f"ELSE max({error}) END AS {rms}"
    )


def _means(specs) -> str:
    return ", ".join(f"sum({v}/({e}*{e})) OVER g/sum(1e0/({e}*{e})) OVER g AS m_{o[0]}" for v, e, o in specs)


WAVG_SPECS = [
    ("MAG_PSF", "MAGERR_PSF", ("WAVG_MAG_PSF", "WAVG_MAGERR_PSF", "WAVG_MAGRMS_PSF")),
    ("MAG_AUTO", "MAGERR_AUTO", ("WAVG_MAG_AUTO", "WAVG_MAGERR_AUTO", "WAVG_MAGRMS_AUTO")),
    ("SPREAD_MODEL", "SPREADERR_MODEL", ("WAVG_SPREAD_MODEL", "WAVG_SPREADERR_MODEL", "WAVG_SPREADRMS_MODEL")),
]
BEST = ["MAG_PSF", "MAGERR_PSF", "MAG_AUTO", "MAGERR_AUTO", "SPREAD_MODEL", "SPREADERR_MODEL", "CLASS_STAR", "FLAGS", "EXPNUM", "CCDNUM", "T_EFF", "EXPTIME",
        "A_IMAGE", "B_IMAGE", "THETA_IMAGE"]
SQL_VIEWS["band_stats_v"] = (
    "SELECT TRUE_ID, BAND, count(*) AS NEPOCHS, " + ", ".join(_wavg(*s) for s in WAVG_SPECS) + ", bit_or(FLAGS & 255) AS WAVG_FLAGS, "
    + ", ".join(f"max(CASE WHEN rn = 1 THEN {c} END) AS {c}" for c in BEST)
    + " FROM (SELECT *, " + _means(WAVG_SPECS)
    + f", row_number() OVER (PARTITION BY TRUE_ID, BAND ORDER BY T_EFF*EXPTIME DESC, {', '.join(DET_KEY)}) AS rn FROM good_v WINDOW g AS (PARTITION BY TRUE_ID, BAND))"
    " GROUP BY TRUE_ID, BAND"
)
OBJECT_FIELDS = {
    "NEPOCHS": 0, "MAG_PSF": 99, "MAGERR_PSF": 99, "MAG_AUTO": 99, "MAGERR_AUTO": 99, "SPREAD_MODEL": -1, "SPREADERR_MODEL": 1, "WAVG_MAG_PSF": 99, "WAVG_MAGERR_PSF": 99,
    "WAVG_MAGRMS_PSF": 99, "WAVG_MAG_AUTO": 99, "WAVG_SPREAD_MODEL": -1, "WAVG_SPREADERR_MODEL": 1, "WAVG_FLAGS": 99, "EXPNUM": -1, "CCDNUM": -1, "T_EFF": -1,
}
BANDS = "grizY"
MEDIAN_POSITION_SQL = (
    "SELECT TRUE_ID, CASE WHEN degrees(atan2(y, x)) < 0 THEN degrees(atan2(y, x)) + 360 ELSE degrees(atan2(y, x)) END AS RA, degrees(atan2(z, sqrt(x*x + y*y))) AS DEC, MJD_OBS "
    "FROM (SELECT TRUE_ID, median(cos(radians(RA))*cos(radians(DEC))) AS x, median(sin(radians(RA))*cos(radians(DEC))) AS y, median(sin(radians(DEC))) AS z, "
    "median(MJD_OBS) AS MJD_OBS FROM {source} GROUP BY TRUE_ID)"
)
SQL_VIEWS["objects_v"] = (
    "SELECT p.TRUE_ID, p.RA, p.DEC, p.MJD_OBS, b.* EXCLUDE (oid) FROM (" + MEDIAN_POSITION_SQL.format(source="good_v") + ") p JOIN (SELECT TRUE_ID AS oid, "
    + ", ".join(f"coalesce(max(CASE WHEN BAND = '{b}' THEN {f} END), {d}) AS {f}_{b.upper()}" for f, d in OBJECT_FIELDS.items() for b in BANDS)
    + " FROM band_stats_v GROUP BY TRUE_ID) b ON p.TRUE_ID = b.oid"
)
# Reference rows with their nearest detection, for calibration: every detection is near its own part only.
SQL_VIEWS["merged_v"] = "SELECT d.*, r.* EXCLUDE (RA, DEC) FROM reference_v r JOIN detections_v d ON d.TRUE_ID = r.OBJID"


def oracle(body: str, *views: str) -> str:
    """SQL text with the views it needs as common table expressions."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for v in views:
        add(v)
    if not ordered:
        return body
    prelude = ", ".join(f"{v} AS ({SQL_VIEWS[v]})" for v in ordered)
    return f"WITH {prelude}{body}" if body.startswith(",") else f"WITH {prelude} {body}"


Query = tuple[Callable[[SparkSession, str], DataFrame], str | None]
