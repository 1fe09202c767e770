"""Folders for data that is written once and read back (staged tables, checkpoints)."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; executors of a cluster
    cannot see a folder of the driver machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="lacuna-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name under the shared root (created by whoever writes it)."""
    return f"{shared_root(spark)}/lacuna-{purpose}-{uuid.uuid4().hex}"
