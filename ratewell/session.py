"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import SparkSession


def build_session(app: str = "ratewell", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the plans rely on; ``conf`` overrides any of them."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Split a hot key even where the split costs one more shuffle above the join.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


OWN = "ratewell.shared.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: ``spark.checkpoint.dir``.

    Only in local mode may it be unset; the session then gets one folder of its own, which is
    removed when Python ends.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(OWN, None)
    if folder:
        return folder
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not context.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="ratewell-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set(OWN, folder)
    return folder
