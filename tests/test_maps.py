import pytest
from pyspark.sql import functions as F

from skyfold.functions.healpix import npix
from skyfold.operators import coadd, maps, masks, matching
from skyfold.plans import coadd_queries, map_queries


def test_interpolation_needs_all_pixels(spark):
    df = spark.createDataFrame([(i, float(i * 7 % 360), float(i * 11 % 120 - 60)) for i in range(60)], "id long, RA double, DEC double")
    whole = spark.range(npix(8)).select(F.col("id").alias("pix"), F.lit(1.0).alias("value"))
    assert {round(r.value, 9) for r in maps.interpolate_map(df, whole, 8, "id").collect()} == {1.0}
    sparse = maps.interpolate_map(df, whole.where("pix % 2 = 0"), 8, "id").collect()
    assert len(sparse) == 60 and {r.value if r.value is None else round(r.value, 9) for r in sparse} <= {None, 1.0}
    blank = whole.withColumn("value", F.when(F.col("pix") % 2 == 0, F.lit(1.0)))
    assert all(r.value is None or r.value == pytest.approx(1.0) for r in maps.interpolate_map(df, blank, 8, "id").collect())


def test_missing_scores_never_win(spark):
    rows = [(1, 1, None), (1, 2, 0.9), (1, 3, 0.5), (2, 4, None), (3, 5, float("nan")), (3, 6, -1.0)]
    df = spark.createDataFrame(rows, "k int, id int, s double")
    pick = lambda largest: {r.k: r.id for r in coadd.best_rows(df, ["k"], F.col("s"), ["id"], "id", largest).collect()}
    assert pick(True) == {1: 2, 2: 4, 3: 6} and pick(False) == {1: 3, 2: 4, 3: 6}


def test_pixel_ids_do_not_run_over(spark):
    one = spark.range(1)
    assert one.select(matching.object_id(F.lit(7), F.lit(5))).first()[0] > 0
    with pytest.raises(Exception, match="more objects in a pixel"):
        one.select(matching.object_id(F.lit(7), F.lit(matching.ID_PER_PIXEL))).collect()


def test_exploded_tile_centres_are_never_broadcast(spark):
    # Spark sizes the copies of a tile in its cells like the one row of the tile.
    df = spark.range(20).select("id", F.col("id").cast("double").alias("RA"), F.lit(1.0).alias("DEC"))
    tiles = spark.range(5).selectExpr("id AS tile", "id*1e0 AS ra0", "1e0 AS dec0", "5e-1 AS scale", "5e0 AS x0", "5e0 AS y0", "0e0 AS xmin", "10e0 AS xmax", "0e0 AS ymin", "10e0 AS ymax")
    plan = masks.tile_coordinates(df, tiles, "id")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_depth_and_split_queries_carry_what_they_read(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(matching, "match_objects", lambda bands, *a, **b: (_ for _ in ()).throw(StopIteration(seen.setdefault("split", bands[0].columns))))
    with pytest.raises(StopIteration):
        coadd_queries.match_per_pixel_split(spark, "/root/testdata/sf0.001")
    assert seen["split"] == ["det_id", "HPX", "EXPNUM", "BAND", "RA", "DEC"]
    shards = map_queries._shards(spark, "/root/testdata/sf0.001")
    assert len(shards.columns) == 4 + 6 * 5 and shards.count() > 0
