"""Session construction and the shared scratch location.

Scratch data (stream inputs, sinks, checkpoints, lineage cuts) always lives
under the folder the cluster names in ``spark.checkpoint.dir``.  Only when a
session has none (unit tests, a laptop) do we create a local one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session should carry.  AQE re-plans joins and partition
# counts from runtime sizes; skew-join splitting is on; the UI server is off.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # commit a change log per batch instead of uploading snapshots each time
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "rivulet", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _checkpoint_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        # Unset only in tests / local runs: make our own and register it.
        root = tempfile.mkdtemp(prefix="rivulet-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    root = _checkpoint_root(spark)
    path = f"{root.rstrip('/')}/rivulet/{purpose}-{uuid.uuid4().hex[:12]}"
    if path.startswith("file:"):
        os.makedirs(path[len("file:"):], exist_ok=True)
    elif "://" not in path:
        os.makedirs(path, exist_ok=True)
    return path


def ensure_state_store(spark: SparkSession) -> None:
    """transformWithStateInPandas needs the RocksDB state store provider;
    changelog checkpointing keeps per-batch commits small."""
    for key in ("spark.sql.streaming.stateStore.providerClass",
                "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"):
        spark.conf.set(key, BASE_CONF[key])


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make the state processors runnable in Python workers.

    The processor module is pickled by value (its classes travel with the
    query, which also covers the driver-side runner that initialises
    transformWithState), and the package is zipped into the shared scratch
    folder and registered with ``addPyFile`` once per SparkContext, as
    ``--py-files`` would at submit time."""
    import zipfile

    from pyspark import cloudpickle

    import rivulet.streaming.state as state_module

    cloudpickle.register_pickle_by_value(state_module)
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out = scratch_dir(spark, "pyfiles")
    if "://" in out and not out.startswith("file:"):
        # cluster file system: the package is deployed with --py-files and the
        # processors travel by value; nothing to write from the driver here.
        _SHIPPED.add(sc.applicationId)
        return
    local = out[len("file:"):] if out.startswith("file:") else out
    zpath = os.path.join(local, "rivulet.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(zpath)
    _SHIPPED.add(sc.applicationId)
