"""Ingest, shards, keyed inserts, sinks and manifests: written below the scratch folder, read back and removed."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F, types as T

from skyfold.functions.healpix import with_pixel
from skyfold.operators import quality
from skyfold.plans import views
from skyfold.plans.column_queries import _sep_sql
from skyfold.plans.map_queries import ring_sql
from skyfold.plans.shared import as_long
from skyfold.plans.views import Query, oracle
from skyfold.session import materialize, new_path, remove
from skyfold.sources import catalogs, io

SKIMMED = T.StructType([
    T.StructField("FILENAME", T.StringType()), T.StructField("UNITNAME", T.StringType()), T.StructField("EXPNUM", T.LongType()), T.StructField("CCDNUM", T.LongType()),
    T.StructField("BAND", T.StringType()), T.StructField("T_EFF", T.DoubleType()), T.StructField("EXPTIME", T.DoubleType()), T.StructField("RA", T.DoubleType()),
    T.StructField("DEC", T.DoubleType()), T.StructField("OBJECT_NUMBER", T.LongType()), T.StructField("FLUX_PSF", T.DoubleType()),
])


def ingest_shards(spark, sf):
    """Raw CSV files to enriched, skimmed, sharded detections and back: rows, flux and depth by band and pixel."""
    det = views.detections(spark, sf)
    folder = new_path(spark, "ingest")
    raw = det.select(
        F.concat(F.lit("/archive/"), "FILENAME").alias("filename"), F.col("OBJECT_NUMBER").alias("number"), F.col("RA").alias("alphawin_j2000"), F.col("DEC").alias("deltawin_j2000"), F.col("FLUX_PSF").cast("double").alias("flux_psf"),
    )
    raw.write.option("header", True).csv(f"{folder}/raw")
    read = io.ingest(spark, f"{folder}/raw").withColumnsRenamed({"RA": "ALPHAWIN_J2000", "DEC": "DELTAWIN_J2000"})
    headers = det.select(F.concat(F.lit("/archive/"), "FILENAME").alias("FILENAME"), "EXPNUM", "CCDNUM", F.col("BAND").alias("FILTER"), "EXPTIME", F.lit(0.0).alias("MJD_OBS")).distinct()
    rows = io.skim_exposures(read, headers, views.exposures(spark, sf).select("expnum", "t_eff"), F.col("FLUX_PSF") > 20_000, "TAG", SKIMMED)
    io.write_shards(rows, f"{folder}/shards", 2, rows_per_file=20_000)
    back, missed = io.read_tolerant(spark, f"{folder}/shards", T.StructType([*SKIMMED.fields, T.StructField("NSIDE", T.IntegerType()), T.StructField("HPX", T.LongType())]))
    counted = back.groupBy("BAND", F.col("HPX").cast("long").alias("HPX")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("FLUX_PSF"), 2).alias("flux"), F.round(F.max("T_EFF"), 6).alias("t_eff"))
    out = materialize(counted.withColumn("n_missed", F.lit(missed.count()).cast("long")), "ingested")
    remove(spark, folder)
    return out


INGEST_SQL = oracle(
    f"""
    SELECT d.BAND, {ring_sql(2, "d.RA", "d.DEC")} AS HPX, count(*) AS n, round(sum(d.FLUX_PSF), 2) AS flux, round(max(e.t_eff), 6) AS t_eff, CAST(0 AS BIGINT) AS n_missed
    FROM detections_v d JOIN exposures_v e ON d.EXPNUM = e.expnum WHERE d.FLUX_PSF > 20000 GROUP BY 1, 2
    """, "detections_v", "exposures_v",
)


def local_cone(spark, sf):
    """A reference catalog sharded by pixel, read by cone and by pixel."""
    folder = new_path(spark, "catalog")
    reference = views.reference(spark, sf).select("OBJID", "RA", "DEC")
    with_pixel(reference, catalogs.NSIDE, name="hpx32").withColumn("hpx32", F.col("hpx32").cast("int")).repartition("hpx32").write.partitionBy("hpx32").parquet(folder)
    stored = spark.read.parquet(folder)
    cone = catalogs.read_cone(stored, 40.0, -34.4, 25.0, ["OBJID"], exact=True).withColumn("kind", F.lit("cone"))
    shards = catalogs.local_catalog(stored, 40.0, -34.4, 25.0, "decals").select("OBJID").join(cone.select("OBJID"), "OBJID", "left_semi").withColumn("kind", F.lit("in shards"))
    pixels = catalogs.catalog_pixel(stored, list(range(9000, 9600)), ["OBJID"]).withColumn("kind", F.lit("pixels"))
    out = materialize(cone.unionByName(shards).unionByName(pixels), "cone")
    remove(spark, folder)
    return out


_IN_CONE = f"SELECT OBJID FROM reference_v WHERE {_sep_sql('RA', 'DEC', '40', '-344e-1')} <= 25"
CONE_SQL = oracle(
    f"SELECT OBJID, 'cone' AS kind FROM ({_IN_CONE}) UNION ALL SELECT OBJID, 'in shards' AS kind FROM ({_IN_CONE}) "
    f"UNION ALL SELECT OBJID, 'pixels' AS kind FROM reference_v WHERE {ring_sql(32)} BETWEEN 9000 AND 9599", "reference_v",
)


def insert_checked(spark, sf):
    """Columns added by key, with the check that nothing else changed."""
    df = views.detections(spark, sf).groupBy("FILENAME", "OBJECT_NUMBER", "BAND").agg(F.min("TRUE_ID").alias("TRUE_ID"), F.max("FLUX_PSF").cast("double").alias("FLUX_PSF"))
    df = materialize(df, "detections")
    new = df.select("FILENAME", "OBJECT_NUMBER", (F.col("TRUE_ID") * 3).alias("TRIPLE"), F.lit("none").alias("BAND"))
    kept, forced = materialize(io.insert_index(df, new), "kept"), io.insert_index(df, new, force=True)
    checks = {"intact": quality.insert_intact(df, kept, ["FILENAME", "OBJECT_NUMBER"]), "replaced": not quality.insert_intact(df, forced, ["FILENAME", "OBJECT_NUMBER"])}
    out = kept.groupBy("BAND").agg(F.count(F.lit(1)).alias("n"), F.sum("TRIPLE").alias("triple"))
    return out.withColumns({k: F.lit(v) for k, v in checks.items()})


INSERT_SQL = oracle(
    "SELECT BAND, count(*) AS n, CAST(sum(3*TRUE_ID) AS BIGINT) AS triple, TRUE AS intact, TRUE AS replaced "
    "FROM (SELECT FILENAME, OBJECT_NUMBER, BAND, min(TRUE_ID) AS TRUE_ID FROM detections_v GROUP BY 1, 2, 3) GROUP BY BAND", "detections_v",
)


def sinks_roundtrip(spark, sf):
    """A warehouse table loaded band by band, a sparse map and a table with added columns, all read back."""
    df = views.detections(spark, sf).select("BAND", "TRUE_ID", "RA", "DEC", F.col("FLUX_PSF").cast("double").alias("FLUX_PSF"))
    folder, name = new_path(spark, "sinks"), f"skyfold_sink_{uuid.uuid4().hex}"
    io.load_warehouse([df.where(F.col("BAND") == b) for b in "grizY"], name)
    per_band = spark.table(name).groupBy(F.col("BAND").alias("key")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("FLUX_PSF"), 2).alias("total")).withColumn("kind", F.lit("warehouse"))
    io.write_map(with_pixel(df, 4).groupBy("pix").agg(F.count(F.lit(1)).alias("value")), f"{folder}/map", 4)
    pixels = spark.read.parquet(f"{folder}/map").groupBy(F.concat("ordering", F.lit(" "), F.col("nside").cast("string")).alias("key")).agg(F.count(F.lit(1)).alias("n"), F.sum("value").cast("double").alias("total"))
    io.write_skim(df, f"{folder}/skim", ["BAND", "TRUE_ID", "FLUX_PSF"], "FLUX_PSF > 30000")
    io.rewrite_with_columns(spark, f"{folder}/skim", f"{folder}/more", {"HALF": F.col("FLUX_PSF") / 2})
    halves = spark.read.parquet(f"{folder}/more").groupBy(F.col("BAND").alias("key")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("HALF"), 2).alias("total")).withColumn("kind", F.lit("columns"))
    out = materialize(per_band.unionByName(pixels.withColumn("kind", F.lit("map"))).unionByName(halves), "sinks-read")
    spark.sql(f"DROP TABLE {name}")
    remove(spark, folder)
    return out


SINKS_SQL = oracle(
    f"""
    SELECT 'warehouse' AS kind, BAND AS key, count(*) AS n, round(sum(FLUX_PSF), 2) AS total FROM detections_v GROUP BY BAND
    UNION ALL SELECT 'map', 'RING 4', count(*), CAST(sum(v) AS DOUBLE) FROM (SELECT {ring_sql(4)} AS pix, count(*) AS v FROM detections_v GROUP BY 1)
    UNION ALL SELECT 'columns', BAND, count(*), round(sum(FLUX_PSF/2), 2) FROM detections_v WHERE FLUX_PSF > 30000 GROUP BY BAND
    """, "detections_v",
)


def manifest_files(spark, sf):
    """The file each exposure with a path should have, every one of them listed."""
    exposures = views.exposures(spark, sf)
    listed = exposures.select(F.concat("path", F.lit("/"), F.format_string("D%08d_%s_cat.fits", "expnum", "band")).alias("path"))
    return io.manifest(exposures, listed, "D%08d_%s_cat.fits")


MANIFEST_SQL = oracle(
    "SELECT band, expnum, path || '/D' || lpad(CAST(expnum AS VARCHAR), 8, '0') || '_' || band || '_cat.fits' AS file FROM exposures_v WHERE path <> ''", "exposures_v",
)


def required_columns(spark, sf):
    """Columns that a release needs and a table lacks, with the rows that wait for them."""
    parts = []
    for name, df, needed in (("detections", views.detections(spark, sf), ["RA", "DEC", "EXPNUM", "HPX", "QUALITY_MAP"]), ("reference", views.reference(spark, sf), ["RA", "DEC", "EBV"])):
        gaps = F.array(*[F.lit(c) for c in quality.missing_columns(df, needed)])
        parts.append(df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), F.explode(gaps).alias("missing"), "n"))
    return as_long(parts[0].unionByName(parts[1]), "n")


REQUIRED_SQL = oracle(
    "SELECT 'detections' AS name, unnest(['HPX', 'QUALITY_MAP']) AS missing, count(*) AS n FROM detections_v UNION ALL SELECT 'reference', 'EBV', count(*) FROM reference_v",
    "detections_v", "reference_v",
)

def shard_batches(spark, sf):
    """Two batches appended to the shards, the first of them again with fewer rows and once more as it was."""
    folder = new_path(spark, "batches")
    det = materialize(views.detections(spark, sf).select("EXPNUM", "BAND", "RA", "DEC", "FLUX_PSF"), "detections")
    even, odd = det.where("EXPNUM % 2 = 0"), det.where("EXPNUM % 2 = 1")
    for batch, rows in ((0, even), (1, odd), (0, even.where("BAND = 'g'")), (0, even)):
        io.append_batch(rows, folder, batch, nside=1, rows_per_file=5000)
    stored = io.read_batches(spark, folder)
    out = materialize(stored.groupBy("BATCH", "BAND", "HPX").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("FLUX_PSF"), 2).alias("flux")), "counts")
    remove(spark, folder)
    return as_long(out, "BATCH", "HPX")


SHARD_BATCHES_SQL = oracle(
    f"SELECT EXPNUM % 2 AS BATCH, BAND, CAST({ring_sql(1)} AS BIGINT) AS HPX, count(*) AS n, round(sum(FLUX_PSF), 2) AS flux FROM detections_v GROUP BY ALL", "detections_v"
)


def pixel_files(spark, sf):
    """Detections in files named after declination strips: pixels of the files, rows of all, rows of the wanted ones."""
    folder = new_path(spark, "pixel-files")
    strip = F.expr(f"CAST(floor(({views.BASE_DEC.format(k='TRUE_ID')} + 90)/10) AS INT)")
    io.write_pixel_files(views.detections(spark, sf).select("TRUE_ID", "FLUX_PSF", strip.alias("HPX")), folder, "HPX")
    names = io.source_pixels(spark.read.parquet(folder)).groupBy("pixel").agg(F.count(F.lit(1)).alias("files"))
    rows = io.scan_pixels(spark, folder).groupBy("pixel").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("TRUE_ID").alias("n_objects"))
    wanted = names.where("pixel % 3 = 0")
    held = io.scan_pixels(spark, folder, wanted).groupBy("pixel").agg(F.count(F.lit(1)).alias("n_wanted"))
    out = materialize(names.join(rows, "pixel").join(held, "pixel", "left"), "pixels")
    remove(spark, folder)
    return as_long(out.withColumn("n_wanted", F.coalesce("n_wanted", F.lit(0))).withColumn("files", F.col("files") > 0), "pixel")


PIXEL_FILES_SQL = oracle(
    f"""
    SELECT pixel, true AS files, count(*) AS n, count(DISTINCT TRUE_ID) AS n_objects, CASE WHEN pixel % 3 = 0 THEN count(*) ELSE 0 END AS n_wanted
    FROM (SELECT TRUE_ID, CAST(floor(({views.BASE_DEC.format(k='TRUE_ID')} + 90)/10) AS BIGINT) AS pixel FROM detections_v) GROUP BY pixel
    """, "detections_v",
)

QUERIES: dict[str, Query] = {
    "ingest_shards": (ingest_shards, INGEST_SQL),
    "shard_batches": (shard_batches, SHARD_BATCHES_SQL),
    "pixel_files": (pixel_files, PIXEL_FILES_SQL),
    "local_cone": (local_cone, CONE_SQL),
    "insert_checked": (insert_checked, INSERT_SQL),
    "sinks_roundtrip": (sinks_roundtrip, SINKS_SQL),
    "manifest_files": (manifest_files, MANIFEST_SQL),
    "required_columns": (required_columns, REQUIRED_SQL),
}
