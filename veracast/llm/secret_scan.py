"""Secret scan: candidates by pattern, false positives removed by a random forest.

A candidate is a run of 16 or more key characters holding a letter and a digit; shorter runs, and
those of letters or digits alone, are not judged. Its features are its length, how unusual its
character transitions are in the corpus, how much of it dictionary words cover, its character mix,
and what labelled findings tell of the path it comes from and of the words beside it. Spark's random
forest learns from labelled findings; candidates it takes for false positives are dropped.

Transitions and words are counted over all documents of the corpus. The transition table is bounded
(128 x 128 characters) and goes to the tasks; words grow with the corpus and are joined. Paths and
words beside findings are counted by label, and stand for their log odds against those of all
findings; an unseen one stands for 0. A finding that the forest learns from is given the counts of
the other folds of findings, so its own label is not among its features.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from veracast.llm.common import kept
from veracast.llm.language_model import word_counts

CANDIDATE = r"[A-Za-z0-9+/_=.\-]{16,}"
# A name assigned within the run, as in API_KEY=...: it belongs to the text before the value.
NAME = r"^.*=(?=[^=]{16,}=*$)"
# Findings the forest learns from at most.
TRAIN_FINDINGS = 20_000
# Letters and count from which a word of the corpus is one of the dictionary.
WORD_LETTERS, WORD_COUNT = 3, 2
# Folds of labelled findings, and the findings that a word's or path's odds start from.
FOLDS, PRIOR_FINDINGS = 5, 2.0
FEATURES = [
    "length", "digits", "capitals", "changes", "unlikely", "dictionary",
    "beside_most", "beside_mean", "path_odds",
]
_WORD_BESIDE = "[a-z][a-z0-9]*"


def candidates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = "source"
) -> DataFrame:
    """One row a candidate: key, path, place, value, before, after.

    ``place`` numbers the candidates of a document from 0; before and after are up to 40 characters
    beside it; a name that a run of key characters assigns to its rest is before the value, not in it.
    A null text has none; every row of ``docs`` is searched, repeated ones too.
    """
    body = F.coalesce(docs[text], F.lit(""))
    rows = docs.select(
        docs[key].alias("key"), docs[path].cast("string").alias("path"), body.alias("body")
    ).where(F.col("body").rlike(CANDIDATE))
    found = F.regexp_extract_all("body", F.lit(CANDIDATE), F.lit(0))
    # Text is cut at the candidates: part i is before candidate i, part i + 1 is after it.
    rows = rows.select("key", "path", found.alias("values"), F.split("body", CANDIDATE).alias("parts"))
    rows = rows.select("key", "path", "parts", F.posexplode("values").alias("place", "value"))
    rows = rows.where(F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Za-z]"))
    before = F.concat(F.get("parts", F.col("place")), F.regexp_extract("value", NAME, 0))
    return rows.select(
        "key",
        "path",
        F.col("place").cast("bigint").alias("place"),
        F.regexp_replace("value", NAME, "").alias("value"),
        F.right(before, F.lit(40)).alias("before"),
        F.left(F.get("parts", F.col("place") + 1), F.lit(40)).alias("after"),
    )


def _count(value: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(value, f"[^{pattern}]", "")).cast("double")


class Corpus(NamedTuple):
    """``surprise[a, b]``: -log2 of the share of b among characters after a; ``words``: the dictionary."""

    surprise: np.ndarray
    words: DataFrame


class Learnt(NamedTuple):
    """Findings by label of each (kind, item, fold), kind being word or path, and the share labelled 1."""

    counts: DataFrame
    share: float


class Scanner(NamedTuple):
    """The forest, or the one probability of labels of one kind, and what its features rest on."""

    forest: RandomForestClassificationModel | float
    corpus: Corpus
    learnt: Learnt | None


def _ascii(texts: list[str]) -> np.ndarray:
    """Characters of all texts, each followed by 0; those beyond ASCII are 1."""
    joined = "\0".join([*texts, ""]).encode("utf-32-le", "surrogatepass")
    codes = np.frombuffer(joined, np.uint32)
    return np.where(codes < 128, codes, 1).astype(np.int64)


def corpus_of(docs: DataFrame, text: str = "text") -> Corpus:
    """Transitions and words of all texts, in lower case. Dictionary words consist of letters alone."""
    counts = kept(word_counts(docs, text), "words")

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << 14)
        for batch in batches:
            words = batch.column(0).to_pylist()
            codes = _ascii(words)
            sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
            times = np.repeat(batch.column(1).to_numpy(zero_copy_only=False), sizes)
            inside = (codes[:-1] > 0) & (codes[1:] > 0)
            cells = (codes[:-1] * 128 + codes[1:])[inside]
            table += np.bincount(cells, times[:-1][inside], minlength=1 << 14)
        cells = np.flatnonzero(table)
        yield pa.record_batch([pa.array(cells), pa.array(table[cells])], names=["cell", "times"])

    found = counts.mapInArrow(pairs, "cell bigint, times double").groupBy("cell").agg(F.sum("times"))
    table = np.ones(1 << 14)
    for cell, times in found.collect():
        table[cell] += times
    table = table.reshape(128, 128)
    surprise = np.log2(table.sum(axis=1, keepdims=True)) - np.log2(table)
    bare = F.regexp_replace("word", r"^[^a-z0-9]+|[^a-z0-9]+$", "").alias("word")
    words = (
        counts.select(bare, "count")
        .where(F.col("word").rlike(f"^[a-z]{{{WORD_LETTERS},}}$"))
        .groupBy("word")
        .agg(F.sum("count").alias("count"))
        .where(F.col("count") >= WORD_COUNT)
        .select("word")
    )
    return Corpus(surprise.astype(np.float32), kept(words, "dictionary"))


def _unlikely(surprise: np.ndarray):
    """Mean surprise of a value's transitions."""

    def rows(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for values in batches:
            texts = [v.lower() for v in values.to_pylist()]
            codes = _ascii(texts)
            inside = (codes[:-1] > 0) & (codes[1:] > 0)
            own = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])[:-1][inside]
            bits = np.bincount(own, surprise[codes[:-1], codes[1:]][inside], minlength=len(texts))
            yield pa.array(bits / np.maximum(np.bincount(own, minlength=len(texts)), 1))

    return F.arrow_udf(rows, "double")


def _covered(found: DataFrame, corpus: Corpus) -> DataFrame:
    """(value, covered): letters of each distinct value that lie in dictionary words, if any do.

    Words of a value are its letter runs, which end where capitals follow small letters.
    """
    runs = F.regexp_extract_all(
        "value", F.lit(f"[A-Z]?[a-z]{{{WORD_LETTERS - 1},}}|[A-Z]{{{WORD_LETTERS},}}"), F.lit(0)
    )
    rows = found.select("value").distinct().select("value", F.explode(runs).alias("word"))
    rows = rows.select("value", F.lower("word").alias("word")).where(F.length("word") >= WORD_LETTERS)
    rows = rows.join(corpus.words, "word")
    return rows.groupBy("value").agg(F.sum(F.length("word")).alias("covered"))


def _items(found: DataFrame, *rest: str) -> DataFrame:
    """One row for each distinct word beside a finding, and one for its path."""
    near = F.lower(F.concat_ws(" ", "before", "after"))
    words = F.array_distinct(F.regexp_extract_all(near, F.lit(_WORD_BESIDE), F.lit(0)))
    word = F.transform(words, lambda w: F.struct(F.lit("word").alias("kind"), w.alias("item")))
    path = F.struct(F.lit("path").alias("kind"), F.coalesce("path", F.lit("")).alias("item"))
    items = F.explode(F.concat(word, F.array(path))).alias("i")
    return found.select(*rest, items).select(*rest, "i.kind", "i.item")


def learn_items(labelled: DataFrame) -> Learnt:
    """Counts by label of words and paths, from findings with ``label`` and ``fold``."""
    one = F.col("label").cast("double")
    counts = (
        _items(labelled, "fold", "label")
        .groupBy("kind", "item", "fold")
        .agg(F.sum(one).alias("yes"), F.sum(1 - one).alias("no"))
    )
    share = labelled.agg(F.avg("label")).first()[0]
    return Learnt(kept(counts, "items"), min(max(share or 0.0, 1e-6), 1 - 1e-6))


def _odds(found: DataFrame, learnt: Learnt) -> DataFrame:
    """(row, beside_most, beside_mean, path_odds): log odds without the finding's own fold."""
    items = _items(found, "row", "fold")
    whole = learnt.counts.groupBy("kind", "item").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
    own = learnt.counts.select("kind", "item", "fold", F.col("yes").alias("own_yes"), F.col("no").alias("own_no"))
    joined = items.join(whole, ["kind", "item"]).join(own, ["kind", "item", "fold"], "left")
    yes = F.col("yes") - F.coalesce("own_yes", F.lit(0.0)) + PRIOR_FINDINGS * learnt.share
    no = F.col("no") - F.coalesce("own_no", F.lit(0.0)) + PRIOR_FINDINGS * (1 - learnt.share)
    start = float(np.log(learnt.share / (1 - learnt.share)))
    joined = joined.select("row", "kind", (F.log(yes / no) - start).alias("odds"))
    of = lambda kind: F.when(F.col("kind") == kind, F.col("odds"))
    return joined.groupBy("row").agg(
        F.max(of("word")).alias("beside_most"),
        F.avg(of("word")).alias("beside_mean"),
        F.max(of("path")).alias("path_odds"),
    )


def features(found: DataFrame, corpus: Corpus, learnt: Learnt) -> DataFrame:
    """Adds the features. Null context counts as empty, a null path as a path of its own.

    Findings with a ``fold`` are judged by the others' labels, those without one by all.
    """
    if "fold" not in found.columns:
        found = found.withColumn("fold", F.lit(None).cast("int"))
    found = kept(found.withColumn("row", F.monotonically_increasing_id()), "findings")
    found = found.join(_covered(found, corpus), "value", "left").join(_odds(found, learnt), "row", "left")
    value, n = F.col("value"), F.length("value").cast("double")
    # A change of character class (lower, capital, digit, other) from one character to the next.
    classes = F.regexp_replace(
        F.regexp_replace(F.regexp_replace(value, "[a-z]+", "a"), "[A-Z]+", "A"), "[0-9]+", "0"
    )
    none = F.lit(0.0)
    out = found.withColumns(
        {
            "length": n,
            "digits": _count(value, "0-9") / n,
            "capitals": _count(value, "A-Z") / n,
            "changes": F.length(classes) / n,
            "unlikely": _unlikely(corpus.surprise)(value),
            "dictionary": F.coalesce("covered", F.lit(0)) / n,
            "beside_most": F.coalesce("beside_most", none),
            "beside_mean": F.coalesce("beside_mean", none),
            "path_odds": F.coalesce("path_odds", none),
        }
    )
    return out.drop("covered", "fold", "row")


def train(
    labelled: DataFrame,
    corpus: Corpus | None = None,
    most: int = TRAIN_FINDINGS,
    trees: int = 40,
    depth: int = 8,
    seed: int = 11,
) -> Scanner | None:
    """Forest from labelled findings: the columns of ``candidates`` and ``label`` 0 or 1.

    Without a ``corpus`` the findings and the text beside them are taken for it.
    Equal findings are one, weighted by their number. At most ``most`` with the smallest hashes are
    used, half of each label or more where the other has fewer; weights make up for those left out,
    so that labels count by their share in all findings. Those without a label are not used. Labels
    of one kind give their own probability everywhere; None if there are no labels.
    """
    if corpus is None:
        beside = F.concat_ws("", "before", "value", "after")
        corpus = corpus_of(labelled.select(beside.alias("text")))
    # Copies of a value share a fold.
    fold = F.pmod(F.xxhash64("value"), F.lit(FOLDS)).cast("int")
    labelled = kept(labelled.where("label is not null").withColumn("fold", fold), "given")
    if not labelled.take(1):
        return None
    learnt = learn_items(labelled)
    rows = features(labelled, corpus, learnt)
    rows = rows.select("value", F.col("label").cast("double").alias("label"), *FEATURES)
    rows = kept(rows.groupBy(*rows.columns).agg(F.count("*").cast("double").alias("times")), "labelled")
    found = rows.groupBy("label").agg(F.count("*"), F.sum("times")).collect()
    kinds = {label: (distinct, total) for label, distinct, total in found}
    if len(kinds) == 1:
        return Scanner(next(iter(kinds)), corpus, None)
    parts = []
    for label, (_, total) in kinds.items():
        others = sum(n for k, (n, _) in kinds.items() if k != label)
        some = rows.where(F.col("label") == label).orderBy(F.xxhash64("value", *FEATURES), "value")
        some = kept(some.limit(max(most // 2, most - others)), "sample")
        taken = some.agg(F.sum("times")).first()[0]
        parts.append(some.withColumn("weight", F.col("times") * F.lit(total / taken)))
    rows = parts[0].union(parts[1])
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, seed=seed, labelCol="label", weightCol="weight"
    )
    fitted = forest.fit(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows))
    return Scanner(fitted, corpus, learnt)


def scan(
    docs: DataFrame,
    model: Scanner | None,
    least: float = 0.5,
    key: str = "doc_id",
    text: str = "text",
    path: str = "source",
) -> DataFrame:
    """Secrets of ``docs``: key, path, place, value, probability.

    Without a model, which is without any label, nothing is known of any candidate: none is reported.
    Every row's whole text is searched, however long; a null or empty one has no candidates. Other
    columns are not used, whatever their names.
    """
    found = candidates(docs, key, text, path)
    keep = ["key", "at", "place", "value", "probability"]
    rows = found.withColumn("at", F.col("path"))
    if model is None:
        scored = rows.withColumn("probability", F.lit(0.0)).where(F.lit(False))
    elif isinstance(model.forest, float):
        scored = rows.withColumn("probability", F.lit(model.forest))
    else:
        rows = features(rows, model.corpus, model.learnt)
        vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)
        scored = model.forest.transform(vectors.drop("probability")).withColumn(
            "probability", vector_to_array("probability")[1]
        )
    return (
        scored.select(*keep).where(F.col("probability") >= least).withColumnRenamed("at", "path")
    )
