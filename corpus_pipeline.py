"""A training corpus from raw documents: clean, deduplicate, decontaminate, mix, write token files.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it to the shared folder
and reads it again as the next stage's ``docs``. All stages but the last return the columns of
``documents``. Nulls, empty texts, repeated rows and empty tables have the results the operators'
docstrings state: rows without words fail the quality rules, a row without an id is kept as others are.
Extra columns come along, whatever their names. A stage's work tables are deleted when the next one
starts, its result by ``run`` when the next one's is written.
"""

from __future__ import annotations

import functools
import gc
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from veracast.llm import decontaminate, mixture, near_duplicates, quality_rules, sequences
from veracast.llm.common import free_name, kept, new_place, recorded, remove, table
from veracast.llm.queries import DOMAIN_WEIGHTS, LANG_WEIGHTS, domain_of, weight_of

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
# Folders that results of earlier stages are read from.
_left: list[str] = []


def _clear(spark: SparkSession, docs: DataFrame) -> None:
    """Delete what earlier stages worked with, now that their results are written and reread.

    What ``docs`` itself still reads stays, should a caller not have written it first.
    """
    files = docs.inputFiles() if _left else []
    for place in _left:
        if not any(place.rsplit("/", 1)[1] in f for f in files):
            remove(spark, place)
    _left.clear()
    # Spark deletes shuffle files of tables that nothing refers to any more.
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _stage(work: Stage) -> Stage:
    @functools.wraps(work)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _clear(spark, docs)
        with recorded() as places:
            out = work(spark, docs, sf_dir)
        _left.extend(places)
        return out

    return stage


@_stage
def clean_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their failing lines; documents that the rules reject go."""
    into = free_name(docs, "_quality")
    judged = quality_rules.judge(docs, into).where(F.col(into)["kept"])
    clean = F.col(into)["clean"]
    fresh = {"text": clean, "n_chars": F.length(clean).cast("bigint")}
    return judged.select(*[fresh[c].alias(c) if c in fresh else F.col(c) for c in docs.columns])


@_stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    into = free_name(docs, "_near")
    found = near_duplicates.near_duplicates(docs, into=into)
    return found.where(F.col(into)["first"]).select(*docs.columns)


@_stage
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of any benchmark item."""
    into = free_name(docs, "_hits")
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"), into)
    return found.where(F.size(F.col(into)["spans"]) == 0).select(*docs.columns)


@_stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents taken by the target weights; one epoch, so none is taken twice."""
    weights = {
        "domain": weight_of("domain", DOMAIN_WEIGHTS),
        "lang": weight_of("lang", LANG_WEIGHTS),
    }
    into = free_name(docs, "_mix")
    mixed = mixture.mix(docs, domain_of(F.col("source")), weights, (9, 10), epochs=1, into=into)
    return mixed.where(F.col(into)["copies"] > 0).select(*docs.columns)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back: place, length and checksum of each."""
    _clear(spark, docs)
    return sequences.packed(docs)


STAGES = [
    ("quality_rules", clean_lines),
    ("near_dedup", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("mixture", mix_sources),
    ("token_files", write_tokens),
]

# Token ids and files are beyond SQL; tests/llm/test_pipeline.py holds every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        place = new_place(spark, f"stage-{name}")
        docs = kept(stage(spark, docs, sf_dir), name, place)
        if before:
            remove(spark, before)
        before = place
    return docs
