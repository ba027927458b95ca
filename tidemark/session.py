"""Session and materialisation helpers shared by every operator."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Settings every job is written against. Partition counts are left to the caller and to AQE.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(cpus: int | str = "*", memory: str = "12g", app: str = "tidemark", **extra: str) -> SparkSession:
    """A local session for tests and benches; on a cluster the submitter's settings win."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app).config("spark.driver.memory", memory)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Uses the shared folder of ``spark.checkpoint.dir``; only a local master may fall back to a temporary one."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tidemark-checkpoint-")
    context.setCheckpointDir(folder)


def checkpointed(frame: DataFrame, eager: bool = True) -> DataFrame:
    """Writes ``frame`` to the shared checkpoint folder and cuts its lineage; survives lost executors."""
    ensure_checkpoint_dir(frame.sparkSession)
    return frame.checkpoint(eager)


def shuffle_width(spark: SparkSession) -> int:
    """The partition count that explicit repartitions use, so that they line up with the session's shuffles."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors' Python workers, once per application, so that they need no install."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="tidemark-code-")) / "tidemark.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)
