"""Shared frame helpers: staging in the cluster's checkpoint folder, document keys."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that part words, as a Java and RE2 class body and as bytes.
SPACE_CLASS = r"\x20\x09-\x0D"
SPACE_BYTES = b" \t\n\x0b\x0c\r"

#: Internal names start so; a clashing column of the input is never touched, as
#: operators pick the columns they need first.
ID, SIG = "_doc", "_sig"


def cut(df: DataFrame) -> DataFrame:
    """The frame, written below `spark.checkpoint.dir`, so that neither a lost executor
    nor a second reader computes it again. It goes when the application ends. Only a local
    session without that setting gets a folder of its own."""
    _folder(df.sparkSession)
    return df.checkpoint(eager=True)


def _folder(spark: SparkSession) -> str:
    """The folder for what is cut, set for the context where Spark has not done so."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        where = spark.conf.get("spark.checkpoint.dir", None)
        if where is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            where = tempfile.mkdtemp(prefix="checkpoint-")
        context.setCheckpointDir(where)
    # a folder of this application's own: Spark names it anew in the one that was set
    path, files = _located(spark, context.getCheckpointDir())
    files.deleteOnExit(path)
    return context.getCheckpointDir()


def stage(df: DataFrame) -> DataFrame:
    """Like cut() for larger frames: a Parquet table in the same folder, which is smaller
    than a checkpoint and read by column. It goes with discard() or when the application
    ends."""
    spark = df.sparkSession
    where = f"{_folder(spark)}/table-{uuid.uuid4()}"
    df.write.parquet(where)
    path, files = _located(spark, where)
    files.deleteOnExit(path)
    out = spark.read.schema(df.schema).parquet(where)
    out.staged_at = where
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes staged tables that no frame will read again."""
    for df in tables:
        path, files = _located(df.sparkSession, df.staged_at)
        files.delete(path, True)


def _located(spark: SparkSession, where: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def text_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`_doc`, `_sig`, `text` for each row. A null id counts as the smallest id and a null
    text as the empty one. `_sig` tells different texts under one id apart; equal rows are
    one document but come as often as they are, so readers combine them by both."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(id_key(F.col(id_col)).alias(ID), F.xxhash64(text).alias(SIG), text.alias("text"))


def id_key(column: Column) -> Column:
    """The id with null as the smallest long, so that joins on it match nulls."""
    return F.coalesce(column.cast("long"), F.lit(-(2**63)))


def ascii_lower(column: Column) -> Column:
    """A-Z lower-cased, all else unchanged."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    """The words of a text: runs of characters that are not white space."""
    return F.filter(F.split(text, f"[{SPACE_CLASS}]+"), lambda w: w != F.lit(""))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
