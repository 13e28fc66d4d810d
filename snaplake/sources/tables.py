"""Reading of the Parquet tables of a folder, and tables that cut lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """df from the shared folder: its lineage ends there, so a lost executor costs no
    recomputation. The folder is the session's spark.checkpoint.dir, or where that is unset one of
    the warehouse."""
    sc = df.sparkSession.sparkContext
    if not sc.getConf().get("spark.checkpoint.dir") and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(f"{df.sparkSession.conf.get('spark.sql.warehouse.dir').rstrip('/')}/shared")
    return df.checkpoint()
