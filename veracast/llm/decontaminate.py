"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A test item is a set of windows of ``WINDOW`` consecutive words; an item with fewer words, but not
none, is one window of its own. The windows of one length m form one pattern set:

* the shift table maps a block of two words to how far the search may move when it ends on that
  block; a block in no window moves it by m - 1 words, so text that shares nothing with the
  benchmark is crossed in steps of nine words;
* windows ending in a block form its bucket, split by their first block;
* a window in the bucket is an occurrence only if all its words are those of the text.

Test items are the stated query set. They are taken in blocks of bounded text, each broadcast alone
and searched for in every document. With several blocks the texts are kept in the shared folder once,
and of each block the hits alone.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from veracast.llm.common import alnum_words, kept, per_row, refuse_taken

WINDOW = 10
# Benchmark text per broadcast block. Windows overlap, so a table takes some 60 times its text.
BLOCK_BYTES = 2 << 20
HITS = "n_words bigint, spans array<struct<first: bigint, last: bigint>>, items array<string>"


def windows_of(words: list[bytes], width: int = WINDOW) -> list[tuple[bytes, ...]]:
    if not words:
        return []
    width = min(width, len(words))
    return [tuple(words[i : i + width]) for i in range(len(words) - width + 1)]


def tables(width: int, windows: dict[tuple[bytes, ...], list[str]]) -> tuple[int, dict, dict]:
    """Width, shift table and buckets of windows that all have ``width`` words."""
    block = min(2, width)
    shift: dict[tuple[bytes, ...], int] = {}
    buckets: dict[tuple, dict[tuple, list]] = {}
    for window, items in windows.items():
        for end in range(block, width + 1):
            tail = window[end - block : end]
            shift[tail] = min(width - end, shift.get(tail, width))
        by_head = buckets.setdefault(window[-block:], {})
        by_head.setdefault(window[:block], []).append((window, items))
    return width, shift, buckets


class PatternSet:
    """Search for the windows of one width."""

    def __init__(self, width: int, shift: dict, buckets: dict):
        self.width, self.shift, self.buckets = width, shift, buckets
        self.block = min(2, width)
        self.far = width - self.block + 1

    def occurrences(self, words: list[bytes]):
        """(first word, items) of every place where a window occurs."""
        block, width, far, shift = self.block, self.width, self.far, self.shift
        end = width
        while end <= len(words):
            tail = tuple(words[end - block : end])
            step = shift.get(tail, far)
            if step:
                end += step
                continue
            at = end - width
            for window, items in self.buckets[tail].get(tuple(words[at : at + block]), ()):
                if tuple(words[at:end]) == window:
                    yield at, items
            end += 1


def pattern_tables(items: list[tuple[str | None, str | None]]) -> list[tuple[int, dict, dict]]:
    """One table for each window length that occurs; equal windows of several items are one pattern."""
    by_width: dict[int, dict[tuple[bytes, ...], dict[str, None]]] = {}
    for item, text in items:
        for window in windows_of(alnum_words(text)):
            owners = by_width.setdefault(len(window), {}).setdefault(window, {})
            if item is not None:
                owners[item] = None
    return [
        tables(width, {window: list(owners) for window, owners in windows.items()})
        for width, windows in sorted(by_width.items())
    ]


def find(words: list[bytes], sets: list[PatternSet]) -> tuple[list[dict], set[str]]:
    """Merged spans of words inside occurrences, and the items they belong to."""
    found, items = [], set()
    for patterns in sets:
        for at, owners in patterns.occurrences(words):
            found.append((at, at + patterns.width))
            items.update(owners)
    return _merged(found), items


def _merged(found: list[tuple[int, int]]) -> list[dict]:
    spans: list[dict] = []
    for first, last in sorted(found):
        if spans and first <= spans[-1]["last"]:
            spans[-1]["last"] = max(last, spans[-1]["last"])
        else:
            spans.append({"first": first, "last": last})
    return spans


def _searcher(sets):
    def work():
        known = [PatternSet(*t) for t in sets.value]

        def rows(texts):
            out = []
            for text in texts:
                words = alnum_words(text)
                spans, items = find(words, known)
                out.append({"n_words": len(words), "spans": spans, "items": sorted(items)})
            return out

        return rows

    return per_row(work, HITS)


def _joined():
    """Spans of several blocks of the benchmark put together."""

    def work():
        return lambda lists: [
            {"spans": _merged([(s["first"], s["last"]) for s in spans])} for spans in lists
        ]

    return per_row(work, "spans array<struct<first: bigint, last: bigint>>")


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    into: str = "_hits",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with a struct column ``into``: n_words, spans of hit words [first, last), items.

    A null or empty text has no words and no hits; an item without words is in no document. An item
    without an id is searched for, and its words count as hit, but it is not listed. Repeated items
    count once; every row of ``docs``, also a repeated one or one without an id, gives one row. With
    an empty benchmark nothing is hit. ``into`` may not be a column of ``docs``.
    """
    refuse_taken(docs, into)
    spark = docs.sparkSession
    items = benchmark.select(
        F.col(item_id).cast("string").alias("item"), F.col(item_text).alias("body")
    ).where("body is not null")
    size = items.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))

    def searched(block: int) -> Callable:
        part = items.where(F.pmod(F.xxhash64("item", "body"), F.lit(blocks)) == block)
        sets = spark.sparkContext.broadcast(pattern_tables([tuple(r) for r in part.toLocalIterator()]))
        return _searcher(sets)

    if blocks == 1:
        return docs.withColumn(into, searched(0)(F.col(text)))
    # The table is written once and searched for every block; of a block only its hits are kept.
    base = kept(
        docs.select(
            F.monotonically_increasing_id().alias("uid"),
            F.struct(*[docs[c] for c in docs.columns]).alias("row"),
            F.col(text).alias("body"),
        ),
        "decontaminate",
    )
    found = []
    for block in range(blocks):
        hits = base.select("uid", searched(block)("body").alias("h")).select("uid", "h.*")
        # Every row is counted once, with the first block.
        found.append(kept(hits if not block else hits.where(F.size("spans") > 0), "hits"))
    every = functools.reduce(DataFrame.union, found).groupBy("uid").agg(
        F.max("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    every = every.select("uid", "n_words", _joined()("spans").alias("s"), "items")
    hit = F.struct("n_words", "s.spans", "items").alias(into)
    return base.join(every, "uid").select(*[F.col("row")[c].alias(c) for c in docs.columns], hit)


def digest(annotated: DataFrame, hits: str = "_hits") -> DataFrame:
    """One row a document: how many words, hit words and items, and a digest of the items."""
    h = F.col(hits)
    return annotated.select(
        "doc_id",
        h["n_words"].alias("n_words"),
        F.aggregate(
            h["spans"], F.lit(0).cast("bigint"), lambda n, s: n + s["last"] - s["first"]
        ).alias("n_hit"),
        F.size(h["items"]).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(h["items"]), ","), 256).alias("items_sha256"),
        (F.size(h["spans"]) > 0).alias("contaminated"),
    )
