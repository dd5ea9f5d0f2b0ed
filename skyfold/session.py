"""Session defaults and lineage cutting."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(cores: str = "*", app: str = "skyfold", shuffle_partitions: int | None = None) -> SparkSession:
    """Local session for tests and benches; a cluster brings its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


_own_folders: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may fall back to a
    machine-local folder of its own: elsewhere a lost executor would take its part of the table with it.
    """
    named = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY, None)
    if named:
        return named
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that every executor can reach")
    if context.applicationId not in _own_folders:
        _own_folders[context.applicationId] = tempfile.mkdtemp(prefix="skyfold-")
    return _own_folders[context.applicationId]


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the scratch folder that nothing has been written to."""
    return os.path.join(scratch_dir(spark), f"{label}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage of iterative operators and survives executor loss. A written table is computed
    once, while a reliable RDD checkpoint computes its input twice.
    """
    path = new_path(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, folder: str) -> None:
    """Deletes a folder below the scratch folder; nothing may read it afterwards."""
    home = spark._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark)).toUri().getPath().rstrip("/") + "/"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.toUri().getPath().startswith(home):
        raise ValueError(f"not below the scratch folder: {folder}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(table: DataFrame | None) -> None:
    """Deletes the files behind a table that :func:`materialize` returned; nothing may read it afterwards."""
    if table is not None:
        for folder in {os.path.dirname(f) for f in table.inputFiles()}:
            remove(table.sparkSession, folder)
