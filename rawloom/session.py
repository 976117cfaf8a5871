"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


# Projections over many raw fields make long generated methods, and the JVM's compiler
# leaves methods of more than 8000 bytes interpreted. With this limit Spark splits them.
COMPILED_METHOD_LIMIT = "8000"
_LIMIT_KEY = "spark.sql.codegen.hugeMethodLimit"


def tune(spark: SparkSession) -> SparkSession:
    """Set what wide raw files need, unless the session has its own setting."""
    if spark.conf.get(_LIMIT_KEY) == "65535":
        spark.conf.set(_LIMIT_KEY, COMPILED_METHOD_LIMIT)
    return spark


def local_session(cpus: int | str = "*", app: str = "rawloom", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    cores = os.cpu_count() or 8 if cpus in ("*", "") else int(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder that every executor can reach.

    The cluster names its shared folder in ``spark.checkpoint.dir``. Only a local
    session, whose executors share the driver's disk, may fall back to the
    machine's temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return f"{root.rstrip('/')}/rawloom/{label}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return os.path.join(tempfile.mkdtemp(prefix="rawloom-"), label)
