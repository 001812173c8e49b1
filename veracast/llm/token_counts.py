"""Token counts of sections by offset mapping.

A document is encoded once, as a whole; each token knows the characters it comes from. Sections are
character spans in order, [start, end). Tokens join the sections they overlap, and a token over a
boundary is allocated by the rule given:

* ``first``: to the section that holds its first character;
* ``last``: to the one that holds its last character;
* ``most``: to the one that holds most of its characters, the earlier one if equal.

Both lists are sorted, so the interval join is a binary search per token inside the document's task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from veracast.llm.common import refuse_taken
from veracast.llm.encode import RunEncoder, byte_slices, tokenizer_path

RULES = ("first", "last", "most")
# Sentences: each ends with one end mark or a line end.
SECTION_END = r"[.!?\n]"
_COLUMNS = [
    ("section", pa.int64()),
    ("start", pa.int64()),
    ("stop", pa.int64()),
    ("n_tokens", pa.int64()),
    ("n_crossing", pa.int64()),
]
RESULT = "array<struct<section: bigint, start: bigint, stop: bigint, n_tokens: bigint, n_crossing: bigint>>"


def sections_of(text: str, end: regex.Pattern) -> np.ndarray:
    """Boundaries 0 = b0 < b1 < ... < bn = length of a text cut after each end mark."""
    marks = [m.end() for m in end.finditer(text)]
    if not marks or marks[-1] != len(text):
        marks.append(len(text))
    return np.array([0, *marks], np.int64)


def allocate(first: np.ndarray, last: np.ndarray, bounds: np.ndarray, rule: str):
    """Section of each token [first, last) and whether it lies in several."""
    at_first = np.searchsorted(bounds, first, "right") - 1
    at_last = np.searchsorted(bounds, np.maximum(last - 1, first), "right") - 1
    sections = len(bounds) - 1
    at_first, at_last = np.minimum(at_first, sections - 1), np.minimum(at_last, sections - 1)
    crossing = at_first != at_last
    if rule == "first":
        return at_first, crossing
    if rule == "last":
        return at_last, crossing
    best, most = at_first.copy(), np.zeros(len(first), np.int64)
    for i in np.flatnonzero(crossing):
        for s in range(at_first[i], at_last[i] + 1):
            inside = min(last[i], bounds[s + 1]) - max(first[i], bounds[s])
            if inside > most[i]:
                best[i], most[i] = s, inside
    return best, crossing


def _counter(tokenizer: str, end: str, rule: str):
    def rows(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder, pattern = RunEncoder(tokenizer, offsets=True), regex.compile(end)
        for texts in batches:
            parts, offsets, total = [], [0], 0
            for at, n in byte_slices(texts):
                part = texts.slice(at, n)
                code = encoder.encode(part)
                upto = np.cumsum(code.counts)
                for body, stop, count in zip(part.to_pylist(), upto, code.counts):
                    if body:
                        bounds = sections_of(body, pattern)
                        own = slice(stop - count, stop)
                        where, crossing = allocate(code.first[own], code.last[own], bounds, rule)
                        k = len(bounds) - 1
                        counts = np.bincount(where, minlength=k)
                        across = np.bincount(where[crossing], minlength=k)
                        parts.append((np.arange(k), bounds[:-1], bounds[1:], counts, across))
                        total += k
                    offsets.append(total)
            columns = [
                pa.array(np.concatenate([p[i] for p in parts]) if parts else [], t)
                for i, (_, t) in enumerate(_COLUMNS)
            ]
            values = pa.StructArray.from_arrays(columns, [n for n, _ in _COLUMNS])
            yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)

    return F.arrow_udf(rows, RESULT).asNondeterministic()


def section_tokens(
    docs: DataFrame,
    into: str = "_sections",
    text: str = "text",
    tokenizer: str | None = None,
    end: str = SECTION_END,
    rule: str = "first",
) -> DataFrame:
    """``docs`` with an array ``into``: section, start, stop, n_tokens, n_crossing of each section.

    Sections are numbered from 0 and cover the text; ``n_crossing`` counts those of its tokens that
    also lie in another section. A null or empty text has no section. Every row gives one row.
    """
    if rule not in RULES:
        raise ValueError(f"rule {rule!r} is none of {RULES}")
    counter = _counter(tokenizer or tokenizer_path(), end, rule)
    refuse_taken(docs, into)
    return docs.withColumn(into, counter(F.col(text)))
