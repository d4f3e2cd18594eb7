"""Shared scratch space for intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import uuid
from urllib.parse import urlparse

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Where it names none, a folder of this application in the warehouse, which all
    executors share as well; on a single machine it goes when the process ends.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if not folder:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch-{context.applicationId}"
        place = urlparse(folder)
        if context.master.startswith("local") and place.scheme in ("", "file"):
            atexit.register(shutil.rmtree, place.path, ignore_errors=True)
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_dir(spark: SparkSession, purpose: str) -> str:
    """A path nothing else uses, below the shared folder."""
    return f"{shared_dir(spark)}/tillflow/{purpose}-{uuid.uuid4().hex}"
