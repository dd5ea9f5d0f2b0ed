"""Data-quality rules. A check returns the violations, or counts of them, as a DataFrame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from skyfold.functions.guards import above, below, finite
from skyfold.schema import BAD_MAG, BANDS, OBJECT_ID, band_column, band_columns

LOW_COUNT, LOW_COUNT_Y = 10_000, 5_000


def _range_rules() -> dict[str, tuple[str, Column]]:
    c = F.col
    bad_value = lambda name: ~finite(c(name))
    far = lambda name, *ok: above(c(name), 35.0) & ~c(name).isin(*ok)
    return {
        "ra": ("RA", below(c("RA"), 0.0) | above(c("RA"), 360.0)),
        "flux": ("FLUX_AUTO", below(c("FLUX_AUTO"), 0.0) | above(c("FLUX_AUTO"), 1e9)),
        "ccdnum": ("CCDNUM", below(c("CCDNUM"), 1) | above(c("CCDNUM"), 62)),
        "zeropoint": ("MAG_ZERO", bad_value("MAG_ZERO") | below(c("MAG_ZERO"), 5.0) | far("MAG_ZERO", BAD_MAG, 999.0)),
        "magnitude": ("MAG_AUTO", bad_value("MAG_AUTO") | below(c("MAG_AUTO"), 5.0) | far("MAG_AUTO", BAD_MAG)),
        "objid": (OBJECT_ID, bad_value(OBJECT_ID) | below(c(OBJECT_ID), 0)),
    }


def _older_rules() -> dict[str, tuple[str, Column]]:
    c = F.col
    nan = lambda name: F.isnan(c(name).cast("double")) | c(name).isNull()
    return {
        "ra": ("RA", nan("RA") | below(c("RA"), 0.0) | above(c("RA"), 360.0)),
        "flux": ("FLUX_AUTO", below(c("FLUX_AUTO"), 0.0) | above(c("FLUX_AUTO"), 1e9)),
        "zeropoint": ("MAG_ZERO", nan("MAG_ZERO") | above(c("MAG_ZERO"), 35.0) | below(c("MAG_ZERO"), 25.0)),
        "magnitude": ("MAG_AUTO", nan("MAG_AUTO") | below(c("MAG_AUTO"), 5.0) | (above(c("MAG_AUTO"), 30.0) & (c("MAG_AUTO") != BAD_MAG))),
        "objid": (OBJECT_ID, nan(OBJECT_ID) | below(c(OBJECT_ID), 0)),
        "position": ("DEC", nan("RA") | nan("DEC")),
    }


def rules(which: str = "current") -> dict[str, tuple[str, Column]]:
    return _range_rules() if which == "current" else _older_rules()


def check_rules(df: DataFrame, keys: Sequence[str] = (), which: str = "current", names: Sequence[str] | None = None) -> DataFrame:
    """Violations of every rule in one pass: ``keys, n_rows, bad_<rule>``. A rule whose column is absent counts every row."""
    counts = []
    for name, (column, broken) in rules(which).items():
        if names is not None and name not in names:
            continue
        present = column in df.columns
        counts.append((F.count_if(F.coalesce(broken, F.lit(True))) if present else F.count(F.lit(1))).alias(f"bad_{name}"))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), *counts)


def check_column(df: DataFrame, column: str, broken: Column, keys: Sequence[str] = ("file",)) -> DataFrame:
    """Violations of one predicate by key; a missing column fails every key."""
    bad = F.count_if(F.coalesce(broken, F.lit(False))) if column in df.columns else F.count(F.lit(1))
    return df.groupBy(*keys).agg(bad.alias("n_bad")).where(F.col("n_bad") > 0)


def nan_counts(df: DataFrame, keys: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """NaN count of each floating-point column."""
    names = columns or [n for n, t in df.dtypes if t in ("double", "float")]
    return df.groupBy(*keys).agg(*[F.count_if(F.isnan(F.col(n))).alias(f"nan_{n}") for n in names])


def rms_nan_rows(df: DataFrame, bands: Sequence[str] = BANDS, keys: Sequence[str] = ("file",)) -> DataFrame:
    names = band_columns(["WAVG_MAGRMS_AUTO", "WAVG_MAGRMS_PSF"], bands)
    spread = band_columns("WAVG_SPREADRMS_MODEL", bands)
    any_nan = lambda cols: F.count_if(F.greatest(*[F.isnan(F.col(c)).cast("int") for c in cols]) == 1)
    return df.groupBy(*keys).agg(any_nan(names).alias("bad_magrms"), any_nan(spread).alias("bad_spreadrms"))


def match_fraction(df: DataFrame, band: str, keys: Sequence[str] = ("file",), least: float = 0.1, size: int = 10_000) -> DataFrame:
    """Share of objects seen in a band; flagged when low among many."""
    seen = F.col(band_column("NEPOCHS", band)) > 0
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg(seen.cast("int")).alias("fraction"))
    return out.withColumn("poor", (F.col("fraction") < least) & (F.col("n") > size))


def band_pair_fraction(df: DataFrame, bands: Sequence[str] = BANDS, keys: Sequence[str] = (), least: float = 0.5, size: int = 10_000) -> DataFrame:
    """Of the objects seen in one band, the share seen in another: one row per ordered band pair."""
    seen = {b: F.col(band_column("NEPOCHS", b)) > 0 for b in bands}
    pairs = [(a, b) for a in bands for b in bands if a != b]
    totals = {f"_n_{a}": F.count_if(seen[a]) for a in bands}
    both = {f"_b_{a}_{b}": F.count_if(seen[a] & seen[b]) for a, b in pairs}
    counts = df.groupBy(*keys).agg(*[v.alias(k) for k, v in (totals | both).items()])
    rows = [F.struct(F.lit(a).alias("band"), F.lit(b).alias("other"), F.col(f"_n_{a}").alias("n"), F.col(f"_b_{a}_{b}").alias("both")) for a, b in pairs]
    out = counts.select(*keys, F.explode(F.array(*rows)).alias("_r")).select(*keys, "_r.*")
    out = out.withColumn("fraction", F.try_divide(F.col("both").cast("double"), F.col("n")))
    return out.withColumn("poor", (F.col("fraction") < least) & (F.col("n") > size))


def missing_columns(df: DataFrame, required: Sequence[str] = ("RA", "DEC")) -> list[str]:
    return [c for c in required if c not in df.columns]


def count_balance(raw: DataFrame, sharded: DataFrame, key: str = "BAND") -> DataFrame:
    """Row counts before and after sharding."""
    a = raw.groupBy(key).agg(F.count(F.lit(1)).alias("n_raw"))
    b = sharded.groupBy(key).agg(F.count(F.lit(1)).alias("n_sharded"))
    both = a.join(b, key, "full_outer").na.fill(0, ["n_raw", "n_sharded"])
    return both.withColumn("balanced", F.col("n_raw") == F.col("n_sharded"))


def low_counts(df: DataFrame, keys: Sequence[str] = ("file", "BAND")) -> DataFrame:
    """Files with suspiciously few detections."""
    n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return n.where(F.col("n") < F.when(F.col("BAND") == "Y", LOW_COUNT_Y).otherwise(LOW_COUNT))


def totals(df: DataFrame, keys: Sequence[str] = ("file",)) -> DataFrame:
    """Rows and columns by file."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"))


def content_hash(df: DataFrame, columns: Sequence[str], key: Sequence[str]) -> DataFrame:
    """Order-free fingerprint of some columns: row count and two sums of row hashes."""
    row = F.xxhash64(*key, *columns)
    low, high = row.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(row, 32)
    return df.agg(F.count(F.lit(1)).alias("n"), F.sum(low).alias("low"), F.sum(high).alias("high"))


def insert_intact(before: DataFrame, after: DataFrame, key: Sequence[str], new: Mapping[str, DataFrame] | None = None) -> bool:
    """True when an insert kept the row count and the columns it did not touch."""
    kept = [c for c in before.columns if c in after.columns and c not in key and c not in (new or {})]
    return content_hash(before, kept, key).first() == content_hash(after, kept, key).first()
