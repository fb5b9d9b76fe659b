"""Session settings and table access shared by every plan."""

from __future__ import annotations

import functools
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` under ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder of the cluster; only a local session without one gets a folder of its own."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="sampleloom-ckpt-")
    sc.setCheckpointDir(shared)


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once in the reliable checkpoint folder, so that several jobs can read it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` by ``keys`` in as many partitions as a shuffle has, for rows that cost more than their bytes tell.

    A number that is given is not lowered at run time; a distinct or a grouping on more keys needs no other shuffle.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that Python stages can import it anywhere."""
    sc = spark.sparkContext
    if getattr(sc, "_sampleloom_shipped", False):
        return
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="sampleloom-py-")) / "sampleloom_package.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    sc.addPyFile(str(target))
    sc._sampleloom_shipped = True


def shipped(query):
    """``query (spark, sf_dir)`` that first ships the package."""

    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run
