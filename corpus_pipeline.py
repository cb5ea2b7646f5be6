"""The corpus pipeline: five operators applied one after another to documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.llm.common import table, written
from isobar.llm.decontaminate import contaminated
from isobar.llm.mixing import mix
from isobar.llm.quality_rules import quality_rules
from isobar.llm.queries import WEIGHTS, domain_model
from isobar.llm.sharding import shard_rows
from isobar.llm.simhash import similar_groups

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go; documents that the rules reject go."""
    kept = quality_rules(docs.select(*COLUMNS)).filter("kept")
    return kept.select("doc_id", F.col("clean_text").alias("text"), "lang", "source", F.length("clean_text").cast("long").alias("n_chars"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity 0.8) the document with the smallest id stays; one
    with a null id is a document of its own."""
    docs = docs.select(*COLUMNS)
    named = docs.filter("doc_id is not null")
    first = similar_groups(named).filter("doc_id = component_id").select("doc_id").distinct()
    return named.join(first, "doc_id", "left_semi").unionByName(docs.filter("doc_id is null"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    found = contaminated(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.select(*COLUMNS).join(found, "doc_id", "left_anti")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its rate says; at the least budget that keeps every domain whole, none is lost on purpose."""
    drawn = mix(docs.select(*COLUMNS), domain_model(spark, sf_dir), WEIGHTS)
    return drawn.filter("copies > 0").select(*COLUMNS, F.explode(F.sequence(F.lit(1), "copies")).alias("_copy")).drop("_copy")


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A shard and a slot for every document; copies get places of their own."""
    return shard_rows(docs.select(*COLUMNS), 24).drop("perm")


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("mixing", mixing), ("sharding", sharding)]
#: SQL can't express SimHash groups, template windows or projected gradients; tests compare the rows with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage: documents' columns with row_number, n_rows, shard and slot."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs)
    return docs
