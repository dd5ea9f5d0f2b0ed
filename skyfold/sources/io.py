"""Reading, enriching, sharding and writing tables. Parquet and CSV are the formats."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from skyfold.functions.healpix import with_pixel
from skyfold.operators.ids import dense_ids
from skyfold.operators.relational import stack
from skyfold.schema import DETECTION_SCHEMA, RADEC_ALIASES, require_columns
from skyfold.session import discard, materialize

EXPOSURE_FIELDS = ["PFW_ATTEMPT_ID", "TAG", "UNITNAME", "REQNUM", "ATTNUM", "T_EFF"]


def scan(spark: SparkSession, paths: Sequence[str] | str, columns: Sequence[str] | None = None, fmt: str = "parquet") -> DataFrame:
    """Files with one schema: only ``columns`` are read."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.option("header", True).option("inferSchema", fmt == "csv").format(fmt)
    df = reader.load(paths)
    return df.select(*columns) if columns else df


def scan_mixed(spark: SparkSession, paths: Sequence[str], columns: Sequence[str] | None = None, fmt: str = "parquet") -> DataFrame:
    """Files whose types differ are cast to the types of the first."""
    return stack([scan(spark, p, columns, fmt) for p in paths])


def with_radec(df: DataFrame, pairs: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Upper-case names, with the first known position pair renamed to RA, DEC."""
    df = df.toDF(*[c.upper() for c in df.columns])
    if "RA" in df.columns or "DEC" in df.columns:
        return df
    for ra, dec in [*pairs, *RADEC_ALIASES]:
        if ra.upper() in df.columns and dec.upper() in df.columns:
            return df.withColumnsRenamed({ra.upper(): "RA", dec.upper(): "DEC"})
    raise ValueError("no RA, DEC columns found")


def narrow_doubles(df: DataFrame, pairs: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Doubles become floats, positions excepted."""
    keep = {n.upper() for pair in [*pairs, *RADEC_ALIASES] for n in pair}
    return df.withColumns({n: F.col(n).cast("float") for n, t in df.dtypes if t == "double" and n.upper() not in keep})


def ingest(spark: SparkSession, paths: Sequence[str] | str, fmt: str = "csv", float32: bool = False, radec: tuple[str, str] | None = None) -> DataFrame:
    """Raw catalog files: names in upper case, positions under RA, DEC. Empty files add nothing."""
    pairs = [radec] if radec else []
    df = with_radec(scan(spark, paths, fmt=fmt), pairs)
    return narrow_doubles(df, pairs) if float32 else df


def enrich_detections(raw: DataFrame, headers: DataFrame, tag: str = "", schema: T.StructType = DETECTION_SCHEMA) -> DataFrame:
    """Detections with the values of their image header.

    ``headers`` has FILENAME, EXPNUM, CCDNUM, FILTER, EXPTIME, MJD_OBS, one row per file. A field ``NAME_APER_k`` of the
    schema picks element k of array column ``NAME_APER``.
    """
    hdr = headers.select("FILENAME", *[F.col(c).alias(f"_h_{c}") for c in ("EXPNUM", "CCDNUM", "FILTER", "EXPTIME", "MJD_OBS")])
    joined = raw.join(hdr, "FILENAME")
    unit = F.format_string("D%08d", F.col("_h_EXPNUM").cast("long"))
    made = {
        "EXPNUM": F.col("_h_EXPNUM"), "CCDNUM": F.col("_h_CCDNUM"), "BAND": F.col("_h_FILTER"), "EXPTIME": F.col("_h_EXPTIME"), "MJD_OBS": F.col("_h_MJD_OBS"),
        "FILENAME": F.substring_index("FILENAME", "/", -1), "PFW_ATTEMPT_ID": F.concat(F.col("_h_EXPNUM").cast("long").cast("string"), F.lit("01")),
        "TAG": F.lit(tag), "UNITNAME": unit, "REQNUM": F.lit(1), "ATTNUM": F.lit(1), "T_EFF": F.lit(-1.0), "RA": F.col("ALPHAWIN_J2000"),
        "DEC": F.col("DELTAWIN_J2000"), "OBJECT_NUMBER": F.col("NUMBER"),
    }
    out = []
    for field in schema.fields:
        aperture = re.fullmatch(r"(.+_APER)_(\d+)", field.name)
        if aperture and aperture[1] in raw.columns:
            value = F.element_at(aperture[1], int(aperture[2]) + 1)
        elif field.name in made:
            value = made[field.name]
        elif field.name in raw.columns:
            value = F.col(field.name)
        else:
            raise ValueError(f"column not found: {field.name}")
        out.append(value.cast(field.dataType).alias(field.name))
    return joined.select(*out)


def project_output(df: DataFrame, exposures: DataFrame, schema: T.StructType = DETECTION_SCHEMA) -> DataFrame:
    """Output columns in order; six of them come from the exposure list where it has them."""
    exposures = exposures.toDF(*[c.upper() for c in exposures.columns])
    for field in schema.fields:
        if field.name not in df.columns and field.name not in exposures.columns:
            raise ValueError(f"column not found: {field.name}")
    override = [c for c in EXPOSURE_FIELDS if c in exposures.columns and c in schema.fieldNames()]
    extra = [f.name for f in schema.fields if f.name not in df.columns and f.name not in override]
    side = exposures.select("EXPNUM", *[F.col(c).alias(f"_e_{c}") for c in [*override, *extra]]).dropDuplicates(["EXPNUM"])
    joined = df.join(side, "EXPNUM")
    pick = lambda f: F.col(f"_e_{f.name}" if f.name in override or f.name in extra else f.name)
    return joined.select(*[pick(f).cast(f.dataType).alias(f.name) for f in schema.fields])


def skim_exposures(
    raw: DataFrame, headers: DataFrame, exposures: DataFrame, select: Callable[[DataFrame], Column] | Column | None = None, tag: str = "", schema: T.StructType = DETECTION_SCHEMA
) -> DataFrame:
    """All exposures in one job: enrich, select, project."""
    rows = enrich_detections(raw, headers, tag, schema)
    if select is not None:
        rows = rows.where(select(rows) if callable(select) else select)
    return project_output(rows, exposures, schema)


def read_tolerant(spark: SparkSession, paths: Sequence[str] | str, schema: T.StructType, fmt: str = "parquet", tolerate: bool = True) -> tuple[DataFrame, DataFrame]:
    """What can be read of the files, and ``(path)`` of the files that gave no rows: corrupt, vanished or empty ones.

    With ``tolerate=False`` a bad file fails the read instead.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.schema(schema).option("ignoreCorruptFiles", tolerate).option("ignoreMissingFiles", tolerate)
    rows = reader.format(fmt).load(paths)
    listed = spark.createDataFrame([(f,) for f in rows.inputFiles()], "path string")
    bare = lambda c: F.regexp_replace(c, "^file:/+", "/")
    given = rows.select(bare(F.col("_metadata.file_path")).alias("path")).distinct()
    return rows, listed.select(bare(F.col("path")).alias("path")).join(given, "path", "left_anti")


def write_shards(df: DataFrame, path: str, nside: int, nest: bool = False, force: bool = False, append: bool = False, rows_per_file: int = 5_000_000, by_band: bool = True) -> None:
    """One folder per band and pixel, sorted by position inside.

    A pixel with more than ``rows_per_file`` rows is dealt over as many tasks as it needs files, by a hash of the
    position, so a cluster of sources spreads as well. ``df`` is worked out once: the rows are written with their pixel,
    and both the sizes and the layout read that table.
    """
    staged = materialize(with_pixel(df, nside, nest=nest, name="HPX"), "sharded")
    sharded = staged.withColumns({"NSIDE": F.lit(nside), "ORDERING": F.lit("NEST" if nest else "RING")})
    keys = ["BAND", "HPX"] if by_band and "BAND" in df.columns else ["HPX"]
    sizes = sharded.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / rows_per_file).alias("_files"))
    bucket = F.pmod(F.xxhash64("RA", "DEC"), F.col("_files"))
    sized = sharded.join(sizes, keys).withColumn("_bucket", bucket)
    layout = sized.repartition(*keys, "_bucket").sortWithinPartitions(*keys, "_bucket", "DEC", "RA").drop("_files", "_bucket")
    mode = "append" if append else ("overwrite" if force else "errorifexists")
    layout.write.option("maxRecordsPerFile", rows_per_file).partitionBy(*keys).mode(mode).parquet(path)
    discard(staged)


def append_batch(df: DataFrame, path: str, batch: int, nside: int, nest: bool = False, rows_per_file: int = 5_000_000, by_band: bool = True) -> None:
    """Adds a batch of rows to the shards in ``path``; the same batch again replaces itself.

    The batch is written whole below a staging folder, whose name readers ignore, and only then moved to
    ``BATCH=<batch>``. A retry after a failure at any point ends with one copy of it; other batches are never touched.
    """
    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    staged, final = hadoop.Path(f"{path}/_staged/{batch}-{uuid.uuid4().hex}"), hadoop.Path(f"{path}/BATCH={batch}")
    write_shards(df, staged.toString(), nside, nest, rows_per_file=rows_per_file, by_band=by_band)
    store = final.getFileSystem(spark._jsc.hadoopConfiguration())
    old = hadoop.Path(f"{path}/_staged/{batch}-{uuid.uuid4().hex}-old")
    replaced = store.exists(final)
    if replaced and not store.rename(final, old):
        raise OSError(f"could not set aside {final}")
    if not store.rename(staged, final):
        raise OSError(f"could not move {staged}")
    if replaced:
        store.delete(old, True)


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """Rows of all finished batches, with ``BATCH``, ``BAND`` and ``HPX`` from the folders."""
    return spark.read.option("basePath", path).parquet(f"{path}/BATCH=*")


def skim(df: DataFrame, columns: Sequence[str], select: str | Column | None = None) -> DataFrame:
    """Columns of the rows that pass a predicate (a SQL expression or a column)."""
    out = df if select is None else df.where(select)
    return out.select(*columns)


def write_skim(df: DataFrame, path: str, columns: Sequence[str], select: str | Column | None = None, force: bool = False) -> bool:
    """Writes the skim; nothing when no row passes."""
    rows = skim(df, columns, select)
    if rows.isEmpty():
        return False
    return write_table(rows, path, force)


def insert_columns(df: DataFrame, new: DataFrame, key: Sequence[str], force: bool = False) -> DataFrame:
    """Adds the columns of ``new`` by key. Existing columns are replaced with ``force`` and kept otherwise.

    The key must be unique in ``new`` and cover every row; violations fail the query.
    """
    key = list(key)
    fresh = [c for c in new.columns if c not in key and (force or c not in df.columns)]
    if not fresh:
        return df
    side = new.groupBy(*key).agg(F.count(F.lit(1)).alias("_times"), *[F.first(c).alias(f"_n_{c}") for c in fresh])
    joined = df.drop(*fresh).join(side, key, "left")
    wrong = F.coalesce(F.col("_times"), F.lit(0)) != 1
    types = dict(new.dtypes)
    checked = {
        c: F.when(wrong, F.raise_error(F.lit("insert does not cover each row exactly once")).cast(types[c])).otherwise(F.col(f"_n_{c}")) for c in fresh
    }
    return joined.withColumns(checked).select(*[c for c in df.columns if c not in fresh], *fresh)


def insert_index(df: DataFrame, new: DataFrame, force: bool = False) -> DataFrame:
    """Insert keyed by (FILENAME, OBJECT_NUMBER); the key sets must be the same."""
    key = ["FILENAME", "OBJECT_NUMBER"]
    side = lambda table, mark: table.select(*key, F.lit(mark).alias("_side"))
    seen = side(df, 1).unionByName(side(new, 2)).groupBy(*key).agg(F.bit_or("_side").alias("_seen"))
    # A key with a null in it equals no other.
    if not seen.where((F.col("_seen") != 3) | F.col(key[0]).isNull() | F.col(key[1]).isNull()).isEmpty():
        raise ValueError("mismatch in FILENAME or OBJECT_NUMBER")
    return insert_columns(df, new, key, force)


def formula_columns(df: DataFrame, formula: str) -> list[str]:
    """Columns a formula uses, in table order."""
    words = {w.upper() for w in re.findall(r"[A-Za-z_]\w*", formula)}
    return [c for c in df.columns if c.upper() in words]


def add_column(df: DataFrame, name: str, formula: str, force: bool = False) -> DataFrame:
    """A column from a SQL expression over other columns."""
    if not formula_columns(df, formula):
        raise ValueError(f"invalid formula, no column of the table in it: {formula}")
    if name in df.columns and not force:
        return df
    return df.withColumn(name, F.expr(formula))


def rename_column(df: DataFrame, old: str, new: str) -> DataFrame:
    require_columns(df, [old])
    if new in df.columns:
        raise ValueError(f"column exists: {new}")
    return df.withColumnRenamed(old, new)


def add_ccdnum(df: DataFrame, filename: str = "FILENAME") -> DataFrame:
    """CCDNUM from the third part of ``D00000001_g_c01_...``, placed after EXPNUM; an existing column is kept."""
    if "CCDNUM" in df.columns:
        return df
    require_columns(df, [filename, "EXPNUM"])
    part = F.split(F.col(filename), "_")[2]
    number = F.regexp_replace(part, "^c+|c+$", "").cast("int")
    order = df.columns.index("EXPNUM") + 1
    return df.withColumn("CCDNUM", number).select(*df.columns[:order], "CCDNUM", *df.columns[order:])


def file_suffix(path: Column) -> Column:
    """Last ``_`` part of the base name, without extension."""
    base = F.substring_index(F.substring_index(path, "/", -1), ".", 1)
    return F.substring_index(base, "_", -1)


def file_pixel(path: Column) -> Column:
    return file_suffix(path).cast("int")


def with_source_file(df: DataFrame, name: str = "file") -> DataFrame:
    return df.withColumn(name, F.col("_metadata.file_path"))


def source_pixels(df: DataFrame) -> DataFrame:
    """Pixels and files of a scan."""
    return with_source_file(df).select("file").distinct().select(file_pixel(F.col("file")).alias("pixel"), "file")


def write_pixel_files(df: DataFrame, path: str, pixel: str, prefix: str = "cat") -> None:
    """One or more files ``<prefix>_<pixel>.<number>.parquet`` for each pixel, in one folder.

    Tasks write below a temporary folder; the driver only renames finished files, one for each pixel at least.
    """
    spark, staged = df.sparkSession, f"{path}/_staged"
    df.repartition(pixel).write.partitionBy(pixel).mode("errorifexists").parquet(staged)
    hadoop = spark._jvm.org.apache.hadoop.fs
    store = hadoop.Path(staged).getFileSystem(spark._jsc.hadoopConfiguration())
    for folder in store.listStatus(hadoop.Path(staged)):
        if folder.isDirectory():
            number = int(folder.getPath().getName().split("=")[1])
            parts = sorted(f.getPath().getName() for f in store.listStatus(folder.getPath()))
            for k, name in enumerate(n for n in parts if n.endswith(".parquet")):
                if not store.rename(hadoop.Path(folder.getPath(), name), hadoop.Path(f"{path}/{prefix}_{number:05d}.{k}.parquet")):
                    raise OSError(f"could not rename {name} of pixel {number}")
    store.delete(hadoop.Path(staged), True)


def scan_pixels(spark: SparkSession, path: str, wanted: DataFrame | Sequence[int] | None = None, name: str = "pixel", schema: T.StructType | None = None) -> DataFrame:
    """Files named after pixels, with the pixel as a column; only files of ``wanted`` pixels are opened.

    ``wanted`` is a list or a table whose first column is the pixel, of at most as many values as the sky has pixels.
    The predicate is on the file's name, which the scan knows before it reads, so other files leave the file list. With
    ``schema``, not even a footer of another file is read.
    """
    pixel = file_pixel(F.col("_metadata.file_name"))
    files = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    if wanted is not None:
        chosen = [r[0] for r in wanted.select(wanted.columns[0]).distinct().collect()] if isinstance(wanted, DataFrame) else list(wanted)
        files = files.where(pixel.isin(chosen))
    return files.withColumn(name, pixel)


def write_table(df: DataFrame, path: str, force: bool = False, fmt: str = "parquet") -> bool:
    """Writes, or leaves an existing table alone without ``force``. True when it wrote."""
    spark = df.sparkSession
    exists = True
    try:
        spark.read.format(fmt).load(path)
    except Exception as error:  # an absent path is the one expected failure
        if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
            raise
        exists = False
    if exists and not force:
        return False
    df.write.mode("overwrite" if force else "errorifexists").option("header", True).format(fmt).save(path)
    return True


def load_warehouse(tables: Sequence[DataFrame], name: str, force: bool = False) -> None:
    """Creates a warehouse table from the first frame and appends the others; ``force`` replaces an existing one."""
    first, *rest = tables
    first.write.mode("overwrite" if force else "errorifexists").saveAsTable(name)
    for other in rest:
        other.write.mode("append").saveAsTable(name)


def write_map(df: DataFrame, path: str, nside: int, nest: bool = False, force: bool = True) -> bool:
    """A sparse map with its resolution and ordering."""
    return write_table(df.withColumns({"nside": F.lit(nside), "ordering": F.lit("NEST" if nest else "RING")}), path, force)


def manifest(exposures: DataFrame, files: DataFrame, template: str) -> DataFrame:
    """Expected path of each exposure that has one; raises when a file is missing.

    ``template`` is a format string over (expnum, band), such as ``D%08d_%s_cat``. ``files`` has column ``path``.
    """
    wanted = exposures.where(F.coalesce(F.col("path"), F.lit("")) != "")
    wanted = wanted.select("band", "expnum", F.concat("path", F.lit("/"), F.format_string(template, F.col("expnum"), F.col("band"))).alias("file"))
    missing = wanted.join(files.select(F.col("path").alias("file")), "file", "left_anti")
    absent = [row.file for row in missing.limit(20).collect()]
    if absent:
        raise FileNotFoundError(f"missing files (first {len(absent)}): {absent}")
    return wanted


def pending(inputs: DataFrame, outputs: DataFrame, key: Sequence[str], force: bool = False, low: int | None = None, high: int | None = None, expnum: str = "expnum") -> DataFrame:
    """Inputs still to do: no output, or an output older than its input. ``low``/``high`` bound the exposure number.

    ``inputs`` has ``in_mtime``; ``outputs`` has ``out_mtime``.
    """
    work = inputs
    if low is not None:
        work = work.where(F.col(expnum) >= low)
    if high is not None:
        work = work.where(F.col(expnum) <= high)
    if force:
        return work
    latest = outputs.groupBy(*key).agg(F.max("out_mtime").alias("_out"))
    joined = work.join(latest, list(key), "left")
    return joined.where(F.col("_out").isNull() | (F.col("in_mtime") > F.col("_out"))).drop("_out")


def chunked(df: DataFrame, order: str, size: int) -> DataFrame:
    """Adds ``chunk``: runs of ``size`` keys in order."""
    return dense_ids(df, [order], "_k").withColumn("chunk", F.floor(F.col("_k") / size).cast("long")).drop("_k")


def rewrite_with_columns(spark: SparkSession, source: str, target: str, columns: dict[str, Column], fmt: str = "parquet", force: bool = False) -> bool:
    """Reads a table, adds computed columns and writes it to another path."""
    return write_table(scan(spark, source, fmt=fmt).withColumns(columns), target, force, fmt)
