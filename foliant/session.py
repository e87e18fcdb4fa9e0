"""Tables, checkpoints and session defaults shared by all operators."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Makes the package importable on Python workers, once per application.

    The driver packs its own copy and Spark hands it to the executors; nothing has to be installed
    there, and no executor needs the driver's folders.
    """
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        _SHIPPED.add(sc.applicationId)
        root = Path(__file__).resolve().parent
        packed = shutil.make_archive(tempfile.mkdtemp() + "/foliant", "zip", root.parent, root.name)
        sc.addPyFile(packed)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A Parquet table of the data directory, a single file or a folder of parts."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def local_session(cpus: int | str = 8, partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("foliant")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; a temporary one is set only in local sessions that name none."""
    jsc = spark.sparkContext._jsc.sc()
    if not jsc.getCheckpointDir().isDefined():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("on a cluster spark.checkpoint.dir must name a shared folder")
        spark.sparkContext.setCheckpointDir(named or tempfile.mkdtemp(prefix="foliant-checkpoint-"))
    return jsc.getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, its lineage cut; survives lost executors.

    Size estimates are forgotten too: a plan keeps those of the plan it was cut from, and in a loop
    of joins they would grow without bound. Run-time re-planning sees the real sizes.
    """
    spark = df.sparkSession
    ship(spark)
    checkpoint_root(spark)
    kept = df.checkpoint(eager=True)._jdf
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(kept.queryExecution().toRdd(), kept.schema(), False), spark)
