"""Session settings and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the jobs are designed around. None of them changes a result.
RECOMMENDED = {
    # Re-plan joins from measured sizes, split skewed partitions, merge small ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Aggregation state of a long-running query lives on disk, not on the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Raw readings keep their common fields as real Parquet columns inside the
    # variant, so that the typed view reads only the fields it names.
    "spark.sql.variant.writeShredding.enabled": "true",
    "spark.sql.variant.inferShreddingSchema": "true",
    "spark.sql.variant.pushVariantIntoScan": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(
    app: str = "placewell", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """Session with the recommended settings; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for intermediate tables and checkpoints.

    It lies in the shared folder named by ``spark.checkpoint.dir``. Only a local
    session may go without that setting: executors on other machines could not
    read a folder of the driver's machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        base = tempfile.gettempdir()
    return os.path.join(base, f"placewell-{label}-{uuid.uuid4().hex}")
