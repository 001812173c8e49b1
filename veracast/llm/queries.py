"""One query for each operator, over the whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from veracast.llm import (
    decontaminate,
    graded_quality,
    language_id,
    language_model,
    mixture,
    near_duplicates,
    prefix_trie,
    quality_rules,
    secret_scan,
    sequences,
    token_counts,
    vector_codes,
    warc,
)
from veracast.llm.common import fold_of, table

DOMAIN_WEIGHTS = {"d0": 4, "d1": 3, "d2": 2, "d3": 1}
LANG_WEIGHTS = {"en": 5, "de": 2, "fr": 2, "es": 1}


def domain_of(source: Column) -> Column:
    """The tables name no domain: a source's number modulo 4 stands for it."""
    number = F.substring(source, 4, 9).try_cast("int")
    return F.coalesce(F.concat(F.lit("d"), (number % 4).cast("string")), F.lit("other"))


def weight_of(column: str, weights: dict[str, int], other: int = 1) -> Column:
    out = F.lit(other)
    for name, weight in weights.items():
        out = F.when(F.col(column) == name, weight).otherwise(out)
    return out


def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, table(spark, folder, "benchmark"))
    return decontaminate.digest(found)


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = fold_of(F.col("doc_id"), 5) == 0
    model = language_id.train(docs.where(~held_out))
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id",
        held_out.alias("held_out"),
        F.col("_lang.lang").alias("lang_pred"),
        F.col("_lang.score").alias("score"),
    )


def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return sequences.packed(table(spark, folder, "documents"))


def op4_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = near_duplicates.near_duplicates(docs, shingle=2, percent=80)
    component = F.col("_near.component_id")
    return found.select(
        "doc_id",
        F.col("_near.n_shingles").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return quality_rules.judge(docs).select("doc_id", *[f"_quality.{c}" for c in names])


def op6_mixture(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    weights = {
        "domain": weight_of("domain", DOMAIN_WEIGHTS),
        "lang": weight_of("lang", LANG_WEIGHTS),
    }
    return mixture.mix(docs, domain_of(F.col("source")), weights).select(
        "doc_id", "lang", "source", "_mix.*"
    )


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = token_counts.section_tokens(docs, rule="most")
    return found.select("doc_id", F.explode("_sections").alias("s")).select("doc_id", "s.*")


def labelled_findings(docs: DataFrame) -> DataFrame:
    """Findings labelled by known formats: a long hex or prefixed key that is assigned.

    In capitals or not, with quotes or without; a name that says it is a checksum makes it none. The
    formats and the sign of assignment are withheld from the forest, which sees neither.
    """
    found = secret_scan.candidates(docs)
    known = F.col("value").rlike(r"(?i)^([0-9a-f]{32,64}|AKIA[0-9A-Z]{16}|(ghp|sk|xox[bp])[-_][\w-]+)$")
    assigned = F.col("before").rlike(r"[=:]\s*[\"']?$")
    checksum = F.col("before").rlike(r"(?i)(sha-?\d*|md5|checksum|commit|digest|uuid|etag)[\"']?\s*[=:]\s*[\"']?$")
    return found.withColumn("label", (known & assigned & ~checksum).cast("int"))


def op8_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    labelled = labelled_findings(docs.where(fold_of(F.col("doc_id"), 5) != 0))
    model = secret_scan.train(labelled, secret_scan.corpus_of(docs))
    return secret_scan.scan(docs, model).select(
        F.col("key").alias("doc_id"),
        "path",
        "place",
        F.sha2("value", 256).alias("value_sha256"),
        "probability",
    )


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    """Rated ids: grade 0 is toxic, 1 of low quality, 2 good."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    return table(spark, folder, "labels").select("doc_id", grade.alias("grade"))


def op9_graded_quality(spark: SparkSession, folder: str) -> DataFrame:
    held_out = fold_of(F.col("doc_id"), 5) == 0
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = graded_quality.train(docs, ratings(spark, folder).where(~held_out))
    return graded_quality.grade(docs, model).select("doc_id", held_out.alias("held_out"), "_grade.*")


def op10_language_model(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = fold_of(F.col("doc_id"), 7) == 2
    found = language_model.score(docs, docs.where(~held_out), key="doc_id")
    return found.select("doc_id", held_out.alias("held_out"), "_lm.*")


def op11_warc(spark: SparkSession, folder: str) -> DataFrame:
    found = warc.archived(table(spark, folder, "pages"))
    return found.select(
        F.col("key").cast("bigint").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("bigint").alias("refers_to"),
    )


def rebuilt_conversations(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations that begin like the first one of their twenty, for ``crc32 mod 4`` turns."""
    own = prefix_trie.turns_of(table(spark, folder, "conversations"))
    borrowed = own.where(F.col("conv_id") % 20 == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, 3).alias("front")
    )
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    rows = own.select(
        "*", (F.col("conv_id") - F.col("conv_id") % 20).alias("base"), taken.cast("int").alias("h")
    ).join(borrowed, "base", "left")
    front = F.slice(F.coalesce("front", F.slice("turns", 1, 0)), F.lit(1), F.col("h"))
    rest = F.slice("turns", F.col("h") + 1, F.size("turns"))
    return rows.select("conv_id", F.concat(front, rest).alias("turns"))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(rebuilt_conversations(spark, folder))


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.product_codes(table(spark, folder, "embeddings")).drop("label")


def queries() -> dict:
    own = (
        op1_decontaminate,
        op2_language_id,
        op3_token_files,
        op4_near_duplicates,
        op5_quality_rules,
        op6_mixture,
        op7_token_counts,
        op8_secret_scan,
        op9_graded_quality,
        op10_language_model,
        op11_warc,
        op12_prefix_trie,
        op13_vector_codes,
    )
    return {f.__name__: f for f in own}
