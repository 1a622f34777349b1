"""Intermediate tables that several later steps read, written once.

They go to the folder that the whole cluster shares (``spark.checkpoint.dir``), so a
lost executor costs nothing that was done; a local folder is used only where the
session names none.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame


def settle(df: DataFrame) -> DataFrame:
    """``df`` as a written table: computed once, however often it is read."""
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.conf.get("spark.master", "").startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = f"/tmp/checkpoints/{uuid.uuid4().hex}"
        spark.conf.set("spark.checkpoint.dir", folder)
    path = f"{folder.rstrip('/')}/settled-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
