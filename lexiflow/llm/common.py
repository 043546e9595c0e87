"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure, shared_dir

# Arrow batches are cut by bytes as well as by rows, so a batch of very long
# texts stays small in the Python worker.
BATCH_CONF = {
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 * 1024 * 1024),
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime settings, package shipping and Arrow batch bounds (idempotent)."""
    configure(spark)
    for k, v in BATCH_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str, partition_by: tuple[str, ...] = (), **options) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder (``spark.checkpoint.dir``)
    and read it back: lineage is cut by a table that every executor can read,
    and consumers prune its columns."""
    path = shared_dir(df.sparkSession, name)
    schema = df.schema
    df.write.options(**options).partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def crc_mod(col: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (null id: of the empty text)."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % n


def text_of(df: DataFrame, name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def keep_rows(docs: DataFrame, text: str, keep) -> DataFrame:
    """The rows of ``docs``, all columns, whose text passes. ``keep()`` is called
    once in each task and gives the test of a text (null: the empty one)."""
    place = docs.columns.index(text)

    def run(batches):
        import pyarrow as pa

        test = keep()
        for batch in batches:
            yield batch.filter(pa.array([test(t or "") for t in batch.column(place).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
