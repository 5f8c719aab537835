"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # One patient may hold a large share of all events: let AQE split that
    # partition even where the split costs one more exchange downstream.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The JVM never compiles methods above 8000 bytes: wide stages run faster as
    # separate operators than as one interpreted method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Fixed when a session starts: no Python call sites are recorded per column, which
# halves the time to build a wide plan.
STATIC_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per Spark context.

    UDFs are pickled by reference, so every worker must be able to import it, wherever the
    driver was started and whatever is installed on the executors.
    """
    context, root = spark.sparkContext, Path(__file__).resolve().parent
    if getattr(context, "_cohortloom_shipped", False) or not root.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="cohortloom-")) / "cohortloom.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for source in sorted(root.rglob("*.py")):
            packed.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._cohortloom_shipped = True


def build_session(app: str = "cohortloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **STATIC_SETTINGS}.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made by somebody else."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    ship_package(spark)
    return spark


def scratch_folder(spark: SparkSession) -> str:
    """Fresh folder for intermediate tables, below the cluster's checkpoint folder.

    A machine-local folder is used only by a local master that names none.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/cohortloom-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="cohortloom-")
