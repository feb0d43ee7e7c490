"""Session helpers: configuration, shipping of the package, shared scratch folders."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_ROOT = Path(__file__).resolve().parent


def build_session(app: str = "dossier", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this library relies on; *conf* overrides them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | conf
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    return builder.config(map=settings).getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once, so that Arrow functions can import it there."""
    sc = spark.sparkContext
    if getattr(sc, "_dossier_shipped", False):
        return
    folder = tempfile.mkdtemp(prefix="dossier-")
    archive = os.path.join(folder, "dossier_package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(_ROOT.rglob("*")):
            if p.suffix in (".py", ".json"):
                z.write(p, os.path.join("dossier", p.relative_to(_ROOT)))
    sc.addPyFile(archive)
    sc._dossier_shipped = True


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares (spark.checkpoint.dir); a local one only where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = getattr(spark.sparkContext, "_dossier_scratch", None)
        if not folder:
            folder = "file://" + tempfile.mkdtemp(prefix="dossier-checkpoint-")
            spark.sparkContext._dossier_scratch = folder
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/dossier-{name}-{uuid.uuid4().hex}"
    spark.sparkContext.__dict__.setdefault("_dossier_written", []).append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete what this session has written to the shared folder so far, and return how many paths that were. Results that are still to be
    computed read those paths: call this once they are written elsewhere."""
    written = spark.sparkContext.__dict__.pop("_dossier_written", [])
    discard(spark, *written)
    return len(written)


def materialise(df: DataFrame, name: str, *by: str) -> DataFrame:
    """Write *df* to the shared folder, in a folder for each value of the columns *by*, and read it again: cuts lineage and survives lost
    executors."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*by) if by else writer).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._dossier_path = path
    return out


def discard(spark: SparkSession, *kept: DataFrame | str) -> None:
    """Delete tables that materialise() wrote (or paths of scratch_path()), once nothing that is still to be computed reads them."""
    for x in kept:
        path = x if isinstance(x, str) else x._dossier_path
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def spread(df: DataFrame, *by: str) -> DataFrame:
    """Deal rows out by the columns *by*, to a stated number of partitions: where little data makes much work, partitions must not be merged by
    their sizes in bytes."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism), *by)


def set_apart(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that the optimiser can't write out once more for each use: of large expressions whose parts are used several times. A
    generator of one row, of an expression, keeps them in a node of their own."""
    made = F.explode(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))).alias("_apart")
    return df.select("*", made).select(*df.columns, *(F.col(f"_apart.{n}").alias(n) for n in columns))
