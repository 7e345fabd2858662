"""What the operators of this subpackage share: table access, scratch tables and the word pattern."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words, and a word, as character classes of Java's regular expressions.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: SPACE within a string literal of SQL.
SPACE_SQL = SPACE.replace("\\", "\\\\")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; the path may be in any store that Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; a temporary one only in a local session that names none, as in tests."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    set_ = spark.sparkContext._jsc.sc().getCheckpointDir()
    if set_.isEmpty():
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        set_ = spark.sparkContext._jsc.sc().getCheckpointDir()
    return set_.get().rstrip("/")


#: Tables that written() has made and no one has removed.
TABLES: list[str] = []


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes a table in the shared folder and reads it again.

    This cuts the lineage (a lost executor costs only the tasks that ran on it), and the reader knows the table's
    size, so Spark broadcasts it only if that size is under its threshold and sorts or hashes it otherwise.
    """
    path = f"{scratch_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    TABLES.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_tables(spark: SparkSession, since: int = 0, keep_last: bool = True) -> None:
    """Removes the tables written from a place of the list on, but for the last one; for callers whose result is written by then."""
    gone = TABLES[since : len(TABLES) - keep_last]
    for path in gone:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        TABLES.remove(path)


#: Rows that Python gets at a time; ten thousand texts, which is Spark's default, can be more than a worker should hold.
BATCH_ROWS = 512


def small_batches(spark: SparkSession) -> None:
    """Bounds the batches of texts that go to Python; a session that has set a number of its own keeps it."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(BATCH_ROWS))


def columns(df: DataFrame) -> list:
    """All columns, whatever is in their names."""
    return [F.col(f"`{c}`") for c in df.columns]


def packed(docs: DataFrame) -> DataFrame:
    """doc_id, text (null as empty) and row, a struct of the whole row, which keeps every column of any name."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.struct(*columns(docs)).alias("row"))


def texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and text alone, a null text as an empty one; any other column of the input is left out."""
    small_batches(docs.sparkSession)
    return docs.select(docs[doc_id].cast("long").alias("doc_id"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"))


def apart(df: DataFrame) -> DataFrame:
    """An aggregate with a shuffle of its own after it.

    A join with it is then one between two shuffles, and Spark splits the partitions of a hot key on the other side; right on
    top of an aggregate by the same key it could not.
    """
    return df.hint("rebalance")
