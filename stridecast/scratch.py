"""Intermediate tables in the folder the cluster shares.

Writing a table and reading it back cuts lineage, survives lost executors and
gives Catalyst the true size of what it may broadcast.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a new local one only for local masters."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    made = tempfile.mkdtemp(prefix="stridecast-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_root(spark)}/stridecast/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str, **options) -> DataFrame:
    """Write ``df`` to a fresh shared folder and return the table read back; ``options`` go to the writer."""
    folder = new_folder(df.sparkSession, label)
    df.write.options(**options).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, without starting a Python worker."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
