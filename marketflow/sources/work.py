"""Where intermediate data and checkpoints go."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Readers pass over names that begin so.
_OWNER = "_owner"


def new_work_dir(spark: SparkSession) -> str:
    """A fresh folder that driver and executors share.

    It lies below the cluster's ``spark.checkpoint.dir``, else below the warehouse, which
    is shared wherever tables are. The rule is the same for every master.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/marketflow-{uuid.uuid4().hex}"


def owner_of(spark: SparkSession, path: str) -> str | None:
    """Who writes to a folder, from a marker file in it; null if nobody has yet."""
    try:
        return spark.read.text(f"{path}/{_OWNER}").first()[0]
    except AnalysisException:
        return None


def claim_folder(spark: SparkSession, path: str, owner: str) -> None:
    """Mark a folder as ``owner``'s, or fail if it is another's.

    Readers of a stream's folder see only what its log lists, so batches would not be seen
    there; over a batch's files, or another query's log, a stream would lose rows.
    """
    known = owner_of(spark, path)
    if known is None:
        spark.range(1).select(F.lit(owner).alias("value")).coalesce(1).write.text(f"{path}/{_OWNER}")
    elif known != owner:
        raise ValueError(f"{path} belongs to {known}; give {owner} a folder of its own")


def claim_batch_folder(spark: SparkSession, path: str) -> None:
    claim_folder(spark, path, "batches")


def claim_stream_folder(spark: SparkSession, path: str, checkpoint: str) -> None:
    claim_folder(spark, path, f"the stream with checkpoint {checkpoint}")
