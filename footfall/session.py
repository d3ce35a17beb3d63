"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

_LOCAL_SHARED: dict[str, str] = {}
_SHIPPED: set[str] = set()


def local_session(cpus: str = "*", app: str = "footfall", memory: str = "8g") -> SparkSession:
    """A session for tests and the local benchmark; a cluster brings its own settings."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own; on a cluster a missing
    setting is an error, because a machine-local folder would be lost with its machine.
    """
    conf = spark.sparkContext.getConf()
    named = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SHARED:
        _LOCAL_SHARED[app] = tempfile.mkdtemp(prefix="footfall-")
    return _LOCAL_SHARED[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, never reused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of every executor, once per application.

    The zip lies in a temporary folder of the driver, which alone reads it: executors fetch it
    from the driver through Spark itself.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    root, name = os.path.split(package)
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for folder, _, files in os.walk(package):
            for file in sorted(files):
                if file.endswith(".py"):
                    path = os.path.join(folder, file)
                    archive.write(path, os.path.relpath(path, root))
    path = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix=f"{name}-")), f"{name}.zip")
    with open(path, "wb") as out:
        out.write(packed.getvalue())
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)
