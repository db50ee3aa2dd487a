"""Small helpers shared by the operators: stored tables, clash-free columns, bounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rootlens.session import scratch_dir


class Scratch:
    """A folder of one run under the shared one; tables written there cut lineage."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = scratch_dir(spark)

    def store(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.path}/{name}")
        return self.again(df, name)

    def drop(self, *names: str) -> None:
        """Delete stored tables that nothing reads any more."""
        jvm = self.spark.sparkContext._jvm
        for name in names:
            folder = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
            folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)

    def again(self, df: DataFrame, name: str) -> DataFrame:
        """A stored table once more, with columns of its own for a join with itself."""
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")


#: Bytes of rows that go to a Python worker at once. A worker, and Spark's side of the pipe,
#: hold a few times as much.
BATCH_BYTES = 4 << 20


def small_batches(frame: DataFrame) -> None:
    """Send the session's texts to Python in batches of BATCH_BYTES, unless it asks for less."""
    conf, key = frame.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(conf.get(key).rstrip("bB")) > BATCH_BYTES:
        conf.set(key, str(BATCH_BYTES))


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_hash(column: Column | str) -> Column:
    """crc32 of an id written as text; a null id counts as the empty text."""
    column = F.col(column) if isinstance(column, str) else column
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary"))


def only(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns under the names the operator works with; others are left out,
    so extra columns of the caller's table cannot clash with the operator's own."""
    return df.select(*[df[theirs].alias(ours) for ours, theirs in columns.items()])


def lower_ascii(column: Column) -> Column:
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


#: A key with more than this share of all rows is hot; there are fewer than 1 / HOT_SHARE of them.
HOT_SHARE = 0.001


def join_counted(rows: DataFrame, lookup: DataFrame, on: list[str], held: str, total: int) -> DataFrame:
    """``rows`` inner-joined to ``lookup``, one row a key whose column ``held`` counts the rows
    with that key, of ``total`` rows in all; ``rows`` is read twice and should be stored.

    Hot keys are fewer than 1,000 whatever the tables hold, so their lookup rows are broadcast
    and their rows stay where they are; no other key has more than a thousandth of the rows."""
    bar = total * HOT_SHARE
    hot = F.broadcast(lookup.filter(F.col(held) > bar))
    cold = rows.join(hot.select(on), on, "left_anti").join(lookup.filter(F.col(held) <= bar), on)
    return rows.join(hot, on).unionByName(cold)
