"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space; a word is a maximal run of other characters.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text in order; none of a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Only a local master, whose one machine is driver and executor, gets a folder of its own where the setting is missing.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="checkpoints-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def written(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read back: it is computed once, its lineage ends here, and its columns can be pruned."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def discard(df: DataFrame) -> None:
    """Deletes what written(df) wrote; neither df nor what is derived from it may be read again."""
    jvm = df.sparkSession._jvm
    path = jvm.org.apache.hadoop.fs.Path(df._written_to)
    path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


#: A key with one in so many rows or more is heavy; as counts sum to the rows, there are no more heavy keys than this.
HEAVY = 4096


def join_counted(rows: DataFrame, table: DataFrame, keys: list[str], n: str, total: int) -> DataFrame:
    """rows joined with table (a row a key) by keys, without n; n is how many of the total rows have the key.

    Heavy keys are broadcast (at most HEAVY rows of table), so their rows stay where they are; others are shuffled by key.
    """
    heavy = F.col(n) * HEAVY >= total
    top = F.broadcast(table.filter(heavy))
    rest = rows.join(F.broadcast(table.filter(heavy).select(*keys)), keys, "left_anti")
    return rows.join(top.drop(n), keys).unionByName(rest.join(table.filter(~heavy).drop(n), keys))


def free_name(df: DataFrame, name: str) -> str:
    """name, or name with underscores before it where df has such a column already."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
