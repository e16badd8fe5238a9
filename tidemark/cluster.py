"""The library's own code on the executors, and the folder that they share."""

from __future__ import annotations

import re
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the application's Python workers, once, so that they need no installation of it."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    home = Path(__file__).parent
    target = Path(tempfile.mkdtemp(prefix="tidemark")) / "tidemark_code.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(home.rglob("*.py")):
            z.write(f, f.relative_to(home.parent))
    context.addPyFile(str(target))
    _sent.add(context.applicationId)


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; a temporary one where that is unset and all runs in one process, as
    in tests. On a cluster it must be set: another folder would be one machine's."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not re.fullmatch(r"local(\[[^]]*\])?", context.master):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {context.master} share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints"))
    return context._jsc.sc().getCheckpointDir().get()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever it lies."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared folder."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)
