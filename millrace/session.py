"""Session builder and the few helpers that look at session settings."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "millrace", cpus: int | None = None, **conf: str) -> SparkSession:
    """A local session for tests and the benchmark; on a cluster the submitter's session is used."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": "6g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    } | conf
    spark = SparkSession.builder.master(f"local[{cpus}]").appName(app).config(map=settings).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder that survives the loss of an executor (spark.checkpoint.dir).

    Where the session names none, as in local tests, a temporary folder is set; a cluster always names one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        known = spark.sparkContext.getCheckpointDir() if hasattr(spark.sparkContext, "getCheckpointDir") else None
        if known:
            return known
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set; name a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="millrace-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named


#: Whether the shuffle files of a query are removed as soon as it ends, instead of when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage by a reliable checkpoint in the shared folder; the shuffle files that led to it are removed at once."""
    spark = df.sparkSession
    shared_dir(spark)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        return df.select("*").checkpoint(eager=True)  # a query of its own, so no other one misses the files
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")
