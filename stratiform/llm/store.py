"""Written tables in the folder the cluster shares: they cut lineage and outlive a lost executor."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stratiform.session import shared_folder


def stored(df: DataFrame) -> DataFrame:
    """Write df as Parquet below ``spark.checkpoint.dir`` and read it back."""
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
