"""What the operators share: shared storage, text batches and fixed hashes."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows in an Arrow batch where the session has Spark's default; texts can be long.
BATCH_ROWS = 1024


def small_batches(spark: SparkSession) -> None:
    """Lower the Arrow batch size from its default, so that long texts fit."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


#: The folder of a process whose local session names none.
_OWN: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The shared folder that spark.checkpoint.dir names; a local session may do without."""
    if found := spark.conf.get("spark.checkpoint.dir", None):
        return found.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not _OWN:
        _OWN.append("file://" + tempfile.mkdtemp(prefix="sheaf-"))
    return _OWN[0]


def materialize(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """df as a table in the shared folder: lineage ends there and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    out = spark.read.schema(df.schema).parquet(path)
    out.sheaf_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete the files of materialized tables that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.sheaf_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def numbered(rows: DataFrame, order: list[Column], name: str, label: str) -> DataFrame:
    """rows with their number (long, from 1) in an order, as a table.

    Ranges of the order are sorted each on its own; a range's first number
    comes from the sizes of the ranges before it, one for each partition.
    """
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialize(rows.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()), f"{label}-ranges")
    before, starts = 0, []
    for part, count in sorted(tuple(r) for r in dealt.groupBy("_part").count().collect()):
        starts.append((part, before))
        before += count
    first = spark.createDataFrame(starts, "_part int, _before long")
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) + F.col("_before")
    out = materialize(dealt.join(F.broadcast(first), "_part").withColumn(name, place).drop("_part", "_before"), label)
    discard(dealt)
    return out


def fold_of(doc_id: str | Column, modulus: int) -> Column:
    """crc32(doc_id as text) mod modulus; null for a null id."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(col.cast("string").cast("binary")), F.lit(modulus))


def held_out(doc_id: str | Column, modulus: int, remainder: int) -> Column:
    """Whether a row is of the held-out fold; a null id is not."""
    return F.coalesce(fold_of(doc_id, modulus) == remainder, F.lit(False))


def learnable(doc_id: str | Column, modulus: int, remainder: int) -> Column:
    """Whether a row may be learned from; one with a null id may not."""
    return F.coalesce(fold_of(doc_id, modulus) != remainder, F.lit(False))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in short slices, so that few texts are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """Texts of a slice; null counts as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, remainder: int, rows: int) -> DataFrame:
    """At most ``rows`` labelled documents of the learnable folds: doc_id, text, label.

    Those with the smallest hash of the id are taken, so the choice depends on
    neither order nor partitions. Documents whose label rows disagree or are
    null are left out; of rows with one id, one is taken. The ids are few by
    the documented bound, so they are broadcast.
    """
    own = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_y")).filter(F.col("_y").isin(0, 1) & learnable("_id", modulus, remainder))
    ids = own.groupBy("_id").agg(F.min("_y").alias("_y"), F.max("_y").alias("_top")).filter("_y = _top")
    ids = ids.orderBy(F.xxhash64(F.col("_id").cast("long")), "_id").limit(rows).drop("_top")
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(ids), F.col("doc_id") == F.col("_id"))
    return found.groupBy("doc_id").agg(F.max("text").alias("text"), F.max("_y").alias("label"))
