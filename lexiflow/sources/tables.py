"""Driver tables (parquet, one file per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


#: Session setting: deal each table's rows to so many partitions after the scan.
#: For files of one row group on a machine with many cores (the bench); unset, a
#: scan is left as the files split it.
DEAL = "lexiflow.scan.partitions"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    n = spark.conf.get(DEAL, None)
    return df.repartition(int(n)) if n else df
