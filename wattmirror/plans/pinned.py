"""Written intermediate tables: they cut lineage and outlive a lost executor."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from wattmirror.session import work_dir


def pin(df: DataFrame, label: str = "pinned", path: str | None = None) -> DataFrame:
    """Write a table once to the shared work folder and read it back."""
    spark = df.sparkSession
    path = path or f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
