"""Session helpers shared by all operators."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"


def session(app: str = "rolodar", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests, benchmarks and the command line; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("ROLODAR_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named by the session; without one, a local master (tests) gets a folder of its own, and any
    other is refused, as executors do not share a machine's folders."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    folder = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not folder:
        if not sc.master.startswith("local["):
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a shared folder")
        folder = tempfile.mkdtemp(prefix="rolodar-ckpt-")
    sc.setCheckpointDir(folder)


def cut(df: DataFrame) -> DataFrame:
    """Materialise into the shared checkpoint folder, so that later stages survive lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def blank_to_null(name: str):
    """Trimmed text, null when nothing is left."""
    return F.nullif(F.trim(F.col(name)), F.lit(""))


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name that the frame does not have yet (inputs may carry clashing extras)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name
