import pytest
from pyspark.sql import functions as F, types as T

from skyfold import session
from skyfold.plans import source_queries
from skyfold.sources import catalogs, io


@pytest.fixture()
def folder(tmp_path):
    return str(tmp_path)


def positions(spark, n=200):
    return spark.range(n).select(F.col("id"), (F.col("id") * 1.7 % 360).alias("RA"), (F.col("id") * 0.8 % 120 - 60).alias("DEC"), F.when(F.col("id") % 2 == 0, "g").otherwise("r").alias("BAND"), (F.col("id") * 1.5).alias("FLUX"))


def test_shards(spark, folder):
    df = positions(spark)
    path = f"{folder}/hpx"
    io.write_shards(df, path, 4)
    back = spark.read.parquet(path)
    assert back.count() == 200 and {"BAND", "HPX", "NSIDE", "ORDERING"} <= set(back.columns)
    with pytest.raises(Exception, match="already exists"):
        io.write_shards(df, path, 4)
    io.write_shards(df, path, 4, append=True)
    assert spark.read.parquet(path).count() == 400
    pruned = spark.read.parquet(path).where("HPX = 88 AND BAND = 'g'")
    assert "PartitionFilters: [isnotnull" in pruned._jdf.queryExecution().toString()


def test_csv_ingest(spark, folder):
    positions(spark).select(F.col("RA").alias("alphawin_j2000"), F.col("DEC").alias("deltawin_j2000"), F.col("FLUX").alias("flux")).write.option("header", True).csv(f"{folder}/c")
    df = io.ingest(spark, f"{folder}/c", float32=True)
    assert dict(df.dtypes) == {"RA": "double", "DEC": "double", "FLUX": "float"} and df.count() == 200
    with pytest.raises(ValueError, match="no RA, DEC"):
        io.with_radec(df.select("FLUX"))


def test_skim_and_force(spark, folder):
    df = positions(spark)
    assert not io.write_skim(df, f"{folder}/none", ["id"], "FLUX < 0")
    assert io.write_skim(df, f"{folder}/s", ["id", "FLUX"], "FLUX > 100")
    assert not io.write_skim(df, f"{folder}/s", ["id"], "FLUX > 200")
    assert io.write_skim(df, f"{folder}/s", ["id"], "FLUX > 200", force=True)
    assert spark.read.parquet(f"{folder}/s").columns == ["id"]
    assert io.rewrite_with_columns(spark, f"{folder}/s", f"{folder}/t", {"twice": F.col("id") * 2})
    assert io.write_map(df.select(F.col("id").alias("pix"), F.col("FLUX").alias("value")), f"{folder}/m", 4)


def test_mixed_types_follow_the_first(spark, folder):
    spark.range(3).select(F.col("id").cast("int"), F.lit(1.5).cast("float").alias("v")).write.parquet(f"{folder}/a")
    spark.range(3).select("id", F.lit(2.5).alias("v")).write.parquet(f"{folder}/b")
    out = io.scan_mixed(spark, [f"{folder}/a", f"{folder}/b"], ["id", "v"])
    assert dict(out.dtypes) == {"id": "int", "v": "float"} and out.count() == 6


def test_insert_columns(spark):
    df = positions(spark)
    new = df.select("id", (F.col("FLUX") + 1).alias("MORE"), F.lit("x").alias("BAND"))
    out = io.insert_columns(df, new, ["id"])
    assert out.where("MORE = FLUX + 1 AND BAND <> 'x'").count() == 200
    assert io.insert_columns(df, new, ["id"], force=True).where("BAND = 'x'").count() == 200
    with pytest.raises(Exception, match="exactly once"):
        io.insert_columns(df, new.where("id > 3"), ["id"]).collect()
    idx = df.select(F.lit("f").alias("FILENAME"), F.col("id").alias("OBJECT_NUMBER"))
    assert io.insert_index(idx, idx.withColumn("Q", F.lit(1))).count() == 200
    with pytest.raises(ValueError, match="mismatch"):
        io.insert_index(idx, idx.where("OBJECT_NUMBER > 1").withColumn("Q", F.lit(1)))


def test_formulas_and_names(spark):
    df = positions(spark)
    assert io.add_column(df, "x", "FLUX*2 + RA").where("x = FLUX*2 + RA").count() == 200
    with pytest.raises(ValueError, match="invalid formula"):
        io.add_column(df, "x", "1 + 1")
    with pytest.raises(ValueError):
        io.rename_column(df, "absent", "y")
    named = spark.createDataFrame([("D00000001_g_c07_r1p1.fits", 1)], "FILENAME string, EXPNUM long")
    out = io.add_ccdnum(named)
    assert out.columns == ["FILENAME", "EXPNUM", "CCDNUM"] and out.first().CCDNUM == 7
    paths = spark.createDataFrame([("/a_b/cat_hpx_00123.fits.gz",)], "p string")
    assert paths.select(io.file_pixel(F.col("p"))).first()[0] == 123


def test_skim_exposures(spark):
    schema = T.StructType([T.StructField(n, t) for n, t in [("FILENAME", T.StringType()), ("UNITNAME", T.StringType()), ("EXPNUM", T.LongType()), ("CCDNUM", T.ShortType()), ("BAND", T.StringType()), ("T_EFF", T.FloatType()), ("RA", T.DoubleType()), ("OBJECT_NUMBER", T.IntegerType()), ("FLUX_APER_2", T.FloatType()), ("PFW_ATTEMPT_ID", T.LongType())]])
    raw = spark.createDataFrame([("d/f1", 1, 10.0, 1.0, [1.0, 2.0, 3.0]), ("d/f1", 2, 11.0, 2.0, [4.0, 5.0, 6.0])], "FILENAME string, NUMBER int, ALPHAWIN_J2000 double, DELTAWIN_J2000 double, FLUX_APER array<float>")
    hdr = spark.createDataFrame([("d/f1", 42, 3, "g", 90.0, 5e4)], "FILENAME string, EXPNUM long, CCDNUM int, FILTER string, EXPTIME double, MJD_OBS double")
    exp = spark.createDataFrame([(42, 0.7)], "expnum long, t_eff double")
    rows = io.skim_exposures(raw, hdr, exp, lambda d: F.col("FLUX_APER_2") > 3, "TAG", schema).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.FILENAME, r.UNITNAME, r.OBJECT_NUMBER, r.FLUX_APER_2, r.PFW_ATTEMPT_ID) == ("f1", "D00000042", 2, 6.0, 4201) and abs(r.T_EFF - 0.7) < 1e-6


def test_manifest_and_pending(spark):
    exp = spark.createDataFrame([(1, "g", "/raw"), (2, "g", ""), (3, "r", "/raw")], "expnum long, band string, path string")
    files = spark.createDataFrame([("/raw/D00000001_g",), ("/raw/D00000003_r",)], "path string")
    assert io.manifest(exp, files, "D%08d_%s").count() == 2
    with pytest.raises(FileNotFoundError):
        io.manifest(exp, files.limit(1), "D%08d_%s")
    ins = spark.createDataFrame([(1, 5), (2, 5), (3, 5)], "expnum long, in_mtime int")
    outs = spark.createDataFrame([(1, 9), (2, 3)], "expnum long, out_mtime int")
    assert {r.expnum for r in io.pending(ins, outs, ["expnum"]).collect()} == {2, 3}
    assert {r.expnum for r in io.pending(ins, outs, ["expnum"], low=3).collect()} == {3}


def test_cone_reads_prune(spark, folder):
    from skyfold.functions.healpix import with_pixel

    with_pixel(positions(spark, 2000), 32, name="hpx32").write.partitionBy("hpx32").parquet(f"{folder}/cat")
    table = spark.read.parquet(f"{folder}/cat")
    near = catalogs.read_cone(table, 100.0, 10.0, 5.0, exact=True)
    want = positions(spark, 2000).where("degrees(acos(sin(radians(DEC))*sin(radians(10)) + cos(radians(DEC))*cos(radians(10))*cos(radians(RA - 100)))) <= 5").count()
    assert near.count() == want > 0
    assert "PartitionFilters: [hpx32" in near._jdf.queryExecution().toString()
    with pytest.raises(ValueError):
        catalogs.catalog_columns("nothing")


def test_warehouse(spark):
    name = "skyfold_test_load"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    io.load_warehouse([positions(spark, 5), positions(spark, 7)], name, force=True)
    assert spark.table(name).count() == 12
    spark.sql(f"DROP TABLE {name}")


def test_tolerant_read_lists_what_it_missed(spark, tmp_path):
    good, bad = tmp_path / "good", tmp_path / "bad.parquet"
    spark.range(5).coalesce(1).write.parquet(str(good))
    bad.write_bytes(b"no parquet at all")
    rows, missed = io.read_tolerant(spark, [str(good), str(bad)], T.StructType([T.StructField("id", T.LongType())]))
    assert rows.count() == 5 and [r.path.endswith("bad.parquet") for r in missed.collect()] == [True]
    with pytest.raises(Exception):
        io.read_tolerant(spark, [str(bad)], T.StructType([T.StructField("id", T.LongType())]), tolerate=False)[0].count()


def test_pixel_files_are_pruned_by_name(spark, tmp_path):
    """Files of pixels that are not wanted are never opened: here they are broken."""
    folder = str(tmp_path / "pixels")
    df = spark.range(1000).selectExpr("id", "cast(id % 7 as int) AS HPX")
    io.write_pixel_files(df, folder, "HPX", "obs")
    files = sorted(p.name for p in (tmp_path / "pixels").iterdir() if p.name.endswith(".parquet"))
    assert [f[:9] for f in files] == [f"obs_0000{k}" for k in range(7)]
    assert {r.pixel for r in io.source_pixels(spark.read.parquet(folder)).collect()} == set(range(7))
    schema = spark.read.parquet(folder).schema
    for f in files:
        if f[:9] not in ("obs_00002", "obs_00005"):
            (tmp_path / "pixels" / f).write_bytes(b"broken")
    wanted = spark.createDataFrame([(2,), (5,), (2,), (99,)], "hpx int")
    assert schema.names == ["id"]
    got = io.scan_pixels(spark, folder, wanted, schema=schema).groupBy("pixel").count().collect()
    assert {r["pixel"]: r["count"] for r in got} == {2: 143, 5: 143}


def test_batches_replace_themselves(spark, tmp_path):
    folder = str(tmp_path / "shards")
    df = spark.range(400).selectExpr("id", "'g' AS BAND", "id * 0.9 AS RA", "id / 10.0 - 20 AS DEC")
    io.append_batch(df.where("id < 100"), folder, 1, nside=2, nest=True)
    io.append_batch(df.where("id >= 100"), folder, 2, nside=2, nest=True)
    io.append_batch(df.where("id < 50"), folder, 1, nside=2, nest=True)
    held = io.read_batches(spark, folder)
    assert {r["BATCH"]: r["count"] for r in held.groupBy("BATCH").count().collect()} == {1: 50, 2: 300}
    assert held.select("id").distinct().count() == 350
    # A failed attempt leaves its staging folder; readers do not see it and the next attempt is whole.
    broken = df.where("id < 100").withColumn("RA", F.when(F.col("id") == 70, F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("RA")))
    with pytest.raises(Exception, match="lost"):
        io.append_batch(broken, folder, 1, nside=2, nest=True)
    assert io.read_batches(spark, folder).where("BATCH = 1").count() == 50
    io.append_batch(df.where("id < 100"), folder, 1, nside=2, nest=True)
    assert io.read_batches(spark, folder).count() == 400


def _written(monkeypatch, module):
    labels, write = [], session.materialize
    monkeypatch.setattr(module, "materialize", lambda df, label: (labels.append(label), write(df, label))[1])
    return labels


def test_shards_work_their_rows_out_once(spark, tmp_path, monkeypatch):
    labels = _written(monkeypatch, io)
    df = spark.range(300).select((F.col("id") * 1.1).alias("RA"), (F.col("id") / 5 - 30).alias("DEC"), F.when(F.col("id") > 9, "g").alias("BAND"))
    io.write_shards(df.where("BAND IS NOT NULL"), str(tmp_path / "s"), 2, rows_per_file=50)
    assert labels == ["sharded"] and spark.read.parquet(str(tmp_path / "s")).count() == 290


def test_insert_works_its_table_out_once(spark, tmp_path, monkeypatch):
    labels = _written(monkeypatch, source_queries)
    spark.range(60).selectExpr(
        "id AS l_partkey", "id % 7 AS l_orderkey", "cast(1 + id % 3 as int) AS l_linenumber", "id % 5 AS l_suppkey", "date'2020-01-01' AS l_shipdate", "1e1 AS l_quantity", "1e2 + id AS l_extendedprice", "5e-2 AS l_discount", "2e-2 AS l_tax",
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    rows = source_queries.insert_checked(spark, str(tmp_path)).collect()
    assert labels == ["detections", "kept"] and rows and all(r.intact and r.replaced for r in rows)


def test_insert_index_with_null_and_missing_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2)], "FILENAME string, OBJECT_NUMBER int")
    extra = spark.createDataFrame([("a", 3)], df.schema)
    void = spark.createDataFrame([(None, 1)], df.schema)
    for left, right in ((df, df.union(extra)), (df.union(extra), df), (df.union(void), df.union(void))):
        with pytest.raises(ValueError, match="mismatch"):
            io.insert_index(left, right.withColumn("Q", F.lit(1)))
