"""Session helpers: recommended options and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# Options that suit these jobs. Sizes such as executor memory and the number of
# shuffle partitions belong to the cluster and are left alone.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Building a plan is faster without a call site for every expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def recommend(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    return builder


@cache
def own_folder() -> tempfile.TemporaryDirectory:
    """A folder of this machine for a local session; it goes when the process ends."""
    return tempfile.TemporaryDirectory(prefix="wattfolio-", ignore_cleanup_errors=True)


def shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints.

    A machine-local folder is used only by a local session (one process) without that setting.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    root = root or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        root = own_folder().name
    return root.rstrip("/")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
