"""Session helpers: settings the models rely on, and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings the semantics depend on (ANSI) and the scale knobs (AQE). The models do not depend on the
# session time zone (local times are derived from epoch seconds explicitly).
REQUIRED_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "plyscope",
                  extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench; on a cluster use the cluster's own builder."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "8g")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in {**REQUIRED_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_required_conf(spark)
    return spark


def apply_required_conf(spark: SparkSession) -> None:
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster it must be set (a file system that all executors share); only under a local master,
    as in tests, is a scratch folder created and registered when it is unset.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="plyscope-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def landed(df, name: str):
    """``df`` written once as Parquet in the shared checkpoint folder and read back: cuts lineage in
    storage that all executors share."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Give the executors this package (a zip through ``addPyFile``), once per application, so that
    functions sent to them import it wherever the driver was started."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="plyscope-code-"), "plyscope_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)
