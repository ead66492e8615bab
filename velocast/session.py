"""Spark session and shared-storage paths."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "velocast",
                  shuffle_partitions: int | None = None,
                  conf: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with AQE on and the UI off.

    On a cluster ``master`` is left to spark-submit; tests pass ``local[*]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_root(spark)
    ship_package(spark)
    return spark


SHIPPED_KEY = "velocast.shipped"


def ship_package(spark: SparkSession) -> None:
    """Make ``velocast`` importable in every Python worker, once per context.

    Pandas UDFs, ``mapInPandas``/``applyInPandas`` and the UDTF are pickled
    by reference to their module, so workers must import the package.  On a
    cluster this is ``spark-submit --py-files velocast.zip``; when the package
    is not shipped that way (a session handed in by a caller, tests), it is
    zipped once on the driver and added with ``addPyFile`` (``addArtifacts``
    on a Spark Connect session), Spark's own runtime equivalents.
    """
    try:
        if spark.conf.get(SHIPPED_KEY, None) == "true":
            return
    except Exception:  # noqa: BLE001 - a conf read must never fail a query
        pass
    pkg = os.path.dirname(os.path.abspath(__file__))
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        sc = None
    if sc is not None and any(os.path.basename(p).startswith("velocast")
                              for p in getattr(sc, "_python_includes", None) or []):
        spark.conf.set(SHIPPED_KEY, "true")
        return
    out = os.path.join(tempfile.mkdtemp(prefix="velocast-py-"), "velocast.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, dirs, files in os.walk(pkg):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.join("velocast", os.path.relpath(full, pkg)))
    try:
        if sc is not None:
            sc.addPyFile(out)
        else:
            spark.addArtifacts(out, pyfile=True)
        spark.conf.set(SHIPPED_KEY, "true")
    except Exception:  # noqa: BLE001 - workers may already import the package
        pass


SHARED_KEY = "velocast.shared.dir"


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator and is read as is.  Only when it
    is unset (local tests) a folder under /tmp is chosen; it is recorded
    under a session key and used as the checkpoint directory (Spark does not
    allow ``spark.checkpoint.dir`` itself to change at runtime).
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(SHARED_KEY, None)
    if not root and sc.getCheckpointDir():
        root = os.path.dirname(sc.getCheckpointDir().rstrip("/"))
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"/tmp/velocast-{uuid.uuid4().hex[:8]}"
        spark.conf.set(SHARED_KEY, root)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root.rstrip("/") + "/checkpoints")
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh location under the shared folder for tables a job writes."""
    return "/".join([shared_root(spark), "velocast", *parts, uuid.uuid4().hex[:12]])


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never local)."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once under the shared folder and read again: a lineage cut that, unlike an
    eager checkpoint, computes the last stage once."""
    path = scratch_path(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
