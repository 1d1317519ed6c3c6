"""Session helpers shared by every plan: table access, worker paths, checkpoints."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = str(Path(__file__).resolve().parent.parent)


def local_session(cores: int | str = "*", **conf: str) -> SparkSession:
    """A session for tests and benches; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("lumbung")
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    for key, value in (base | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Let Python workers that share this file system import the package."""
    env = spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
    if ROOT not in parts:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *parts])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str | None:
    """The folder that the cluster names in ``spark.checkpoint.dir``; None in a local session without one. A cluster's session
    without one is refused, since executors do not share a machine's temporary folder."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir", None)
    if folder is None and not context.master.startswith("local"):
        raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared checkpoint folder.

    The folder is the one the cluster names in ``spark.checkpoint.dir``; only a local session without one (tests, a laptop)
    gets a temporary folder of its own. With ``spark.cleaner.referenceTracking.cleanCheckpoints`` Spark removes checkpoints
    that nothing refers to any more; ``local_session`` sets it.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession) or tempfile.mkdtemp(prefix="lumbung-checkpoint-"))
    return df.checkpoint(eager=True)


def preview(df: DataFrame, limit: int = 100) -> DataFrame:
    """The first rows as texts; with a limit of 1 the row upright, as (column, value)."""
    texts = df.limit(limit).select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    if limit != 1:
        return texts
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("value")) for c in df.columns]
    return texts.select(F.inline(F.array(*cells)))


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder beside the shared checkpoints; a temporary one only in a local session without a checkpoint folder."""
    return f"{shared_folder(spark) or 'file://' + tempfile.mkdtemp(prefix='lumbung-')}/{name}-{uuid.uuid4().hex[:12]}"
