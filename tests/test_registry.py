import math
import os

import duckdb
import pytest

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"
FAST = ["skim_select", "spread_class", "linear_transform", "calibrated_mags", "derive_zeropoints", "coadd_mag", "best_epoch", "nearest_ref", "nearest_other", "radius_pairs", "footprint_counts",
        "confusion", "kde_mode", "range_rules", "finalcut_exposures", "disc_footprint", "mask_lookup", "match_1arcsec",
        "insert_checked", "manifest_files", "required_columns", "max_depth", "healpix_nested", "ebv_interp", "class_boundaries", "sinks_roundtrip"]


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 5)
    return value


def test_contract_is_consistent():
    names = set(contract.queries())
    assert set(contract.oracle_sql()) <= names and len(names) > 120


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", FAST)
def test_against_duckdb(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{SF}/{f}'")
    got = contract.queries()[name](spark, SF)
    want = con.sql(contract.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)
    a = sorted([tuple(canonical(r[c]) for c in cols) for r in got.collect()], key=str)
    order = [want.columns.index(c) for c in cols]
    b = sorted([tuple(canonical(r[i]) for i in order) for r in want.fetchall()], key=str)
    assert a == b
