"""What the operators of this subpackage share: text conventions, shared storage, worker set-up."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space between words and around lines: blank and the five controls 0x09 to 0x0D.
WS = " \t\n\x0b\x0c\r"
WS_CLASS = r"[\x20\x09-\x0D]"
ARROW_BYTES, MOST_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the synthetic tables, read by Spark so that any store works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, UPPER, LOWER)


def let(value: Column, body) -> Column:
    """Bind ``value`` once as a lambda variable; a plain reference inside a lambda would be evaluated per element."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Runs of non-white-space in the whole text; none for null or blank texts."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(WS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, WS_CLASS + "+"))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where that is unset (a local session, as in tests) a temporary folder takes its place.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not (own := getattr(spark.sparkContext, "_terraloom_dir", None)):
        own = spark.sparkContext._terraloom_dir = "file://" + tempfile.mkdtemp(prefix="terraloom-")
    return own


class Scratch:
    """Tables written to the shared folder to cut lineage; they survive lost executors.

    ``save`` writes and rereads a table, ``drop`` deletes the tables no longer read. While a table is written, Arrow batches are
    held to MOST_BYTES, so that a worker's memory is bounded whatever the length of the rows.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def save(self, df: DataFrame) -> DataFrame:
        path = f"{shared_dir(self.spark)}/terraloom-{uuid.uuid4().hex}"
        asked = self.spark.conf.get(ARROW_BYTES, None)
        self.spark.conf.set(ARROW_BYTES, str(min(int(asked or MOST_BYTES), MOST_BYTES)))
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.unset(ARROW_BYTES) if asked is None else self.spark.conf.set(ARROW_BYTES, asked)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths.append(path)
        out._terraloom_path = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for df in frames:
            path = getattr(df, "_terraloom_path", None)
            if path in self.paths:
                self.paths.remove(path)
                at = jvm.org.apache.hadoop.fs.Path(path)
                at.getFileSystem(conf).delete(at, True)


def ship(spark: SparkSession) -> None:
    """Let Python workers of a local session import this package from where the driver has it.

    On a cluster the package is installed or sent with ``--py-files``; an existing setting stays.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def small(df: DataFrame, rows: int, most: int) -> DataFrame:
    """Mark ``df`` for broadcast only if its counted rows are at most ``most``; beyond, Spark shuffles."""
    return F.broadcast(df) if rows <= most else df


def widened(schema: T.StructType, ddl: str) -> T.StructType:
    """The schema with the fields of ``ddl`` behind its own."""
    return T.StructType([*schema.fields, *T.StructType.fromDDL(ddl).fields])


def sliced(batch: pa.RecordBatch, text_col: str, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about ``most`` bytes of text, one row at least."""
    sizes = [n or 0 for n in pa.compute.binary_length(batch.column(text_col)).to_pylist()]
    start, size = 0, 0
    for k, n in enumerate(sizes):
        if size and size + n > most:
            yield batch.slice(start, k - start)
            start, size = k, 0
        size += n
    if start < len(sizes):
        yield batch.slice(start)
