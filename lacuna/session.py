"""Session defaults and the shared work folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def build_session(app: str = "lacuna", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tuned for; ``conf`` wins."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.python.filterPushdown.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only where it is unset and the session is local, as in tests, a temporary folder is
    chosen.  Elsewhere executors could not see it, so an unset folder is an error.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or getattr(context, "_lacuna_folder", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = context._lacuna_folder = tempfile.mkdtemp(prefix="lacuna-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(base)
    return base


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


def ship(spark: SparkSession) -> None:
    """Make the package importable in Python workers, once per application.

    The same as ``--py-files`` on submit; a session that already ships it, or has
    it installed on the executors, loses nothing.
    """
    context = spark.sparkContext
    if getattr(context, "_lacuna_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="lacuna-ship-")) / "lacuna.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._lacuna_shipped = True
