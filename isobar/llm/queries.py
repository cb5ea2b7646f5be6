"""The queries that apply the operators to whole tables, and their SQL for DuckDB where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .decontaminate import contaminated
from .embedding_dedup import embedding_dedup
from .lexical_search import lexical_search
from .line_dedup import line_dedup
from .mixing import fit_domains, mix
from .oracle import SQL
from .quality_rules import quality_rules
from .secrets import KINDS, fit_markov, labelled_samples, made_samples, scan_secrets, span_text
from .sharding import shard_rows
from .simhash import simhash_groups
from .source_audit import source_audit
from .substring_dedup import substring_dedup
from .token_output import token_output
from .toxicity import fit_toxicity, score_toxicity


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    model = fit_toxicity(docs, table(spark, sf_dir, "labels").filter(~held_out))
    found = score_toxicity(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted", "n_toxic_words")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "n_bad_lines"
    )


#: Domains (languages) and their shares of the tokens of a mixture.
WEIGHTS = {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15}
#: Labelled rows that the domain classifier is fitted on at most: those with the least hashes of their ids.
DOMAIN_SAMPLE = 10_000


def domain_model(spark: SparkSession, sf_dir: str) -> dict[str, list[float]]:
    """Language models of the documents that labels names."""
    ids = table(spark, sf_dir, "labels").filter("doc_id is not null").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(DOMAIN_SAMPLE)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.col("lang").alias("domain"))
    return fit_domains(docs.join(F.broadcast(ids), "doc_id"), list(WEIGHTS))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mix(table(spark, sf_dir, "documents").select("doc_id", "text"), domain_model(spark, sf_dir), WEIGHTS)
    return found.select("doc_id", "n_tokens", *[F.get("p", F.lit(k)).alias(f"p_{d}") for k, d in enumerate(WEIGHTS)], "rate", "copies")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_markov(labelled_samples(docs).unionByName(made_samples(spark)))
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("secrets", lambda s: s["kind"] != "markov")
    return scan_secrets(docs, model).select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS], F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("secrets")).alias("spans")
    )


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup(table(spark, sf_dir, "documents"), 50)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = line_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", "longest_run", "n_runs", F.sha2("clean_text", 256).alias("clean_sha256"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    found = token_output(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    return shard_rows(docs, 24).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_number", "n_rows")


def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit(table(spark, sf_dir, "documents"))


def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(table(spark, sf_dir, "embeddings"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict:
    return {"op1_mixing": op1_mixing, "op2_decontaminate": op2_decontaminate, "op3_secret_scan": op3_secret_scan, "op4_toxicity": op4_toxicity, "op5_quality_rules": op5_quality_rules, "op6_substring_dedup": op6_substring_dedup, "op7_line_dedup": op7_line_dedup, "op8_simhash": op8_simhash, "op9_token_output": op9_token_output, "op10_sharding": op10_sharding, "op11_source_audit": op11_source_audit, "op12_embedding_dedup": op12_embedding_dedup, "op13_lexical_search": op13_lexical_search}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
