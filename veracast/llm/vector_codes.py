"""Product codes of vectors with integer arithmetic, trained with LAESA pivots.

A component x becomes floor(``SCALE`` * x). Vectors are cut into ``PARTS`` equal parts; each part
position has a codebook of at most ``ENTRIES`` entries, which start as that part of the vectors with
the smallest ids. A round assigns every part to its nearest entry (squared Euclidean distance, ties
to the lower index) and moves each entry to the floor of its parts' mean.

Nearest entries are found without measuring all of them. ``PIVOTS`` initial entries of each position,
chosen far apart, stay fixed as pivots; every part's distance to them is computed once and kept beside
the vector. Each round measures only pivots against entries. By the triangle inequality the difference
of the two distances is a lower bound of a part's distance to an entry: entries are tried in the order
of their bounds, and once a bound exceeds the best exact distance the rest is pruned. Kept distances
are whole numbers, rounded down, and the bounds allow for that, so pruning never loses the nearest.

Each round, a task gives one row for each position, entry and component; the driver sees the totals,
at most ``PARTS`` * ``ENTRIES`` * width numbers, whatever the input.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from veracast.llm.common import kept

SCALE, PARTS, ENTRIES, ROUNDS, PIVOTS = 4096, 8, 16, 6, 3
# Components saturate here, so that squared distances of a part fit 64 bits for widths to 32.
LARGEST = 1 << 28
_SLICE_ROWS = 4096
_SUMS = "part int, entry int, place int, total bigint, n bigint"


def _root(x: np.ndarray) -> np.ndarray:
    """Whole square roots, rounded down."""
    r = np.sqrt(x.astype(np.float64)).astype(np.int64)
    r -= r * r > x
    return r + ((r + 1) * (r + 1) <= x)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of each row of ``a`` to each row of ``b``, as whole numbers."""
    out = np.zeros((len(a), len(b)), np.int64)
    for j in range(a.shape[1]):
        out += (a[:, j, None] - b[None, :, j]) ** 2
    return out


def choose_pivots(entries: np.ndarray, pivots: int = PIVOTS) -> np.ndarray:
    """Entries far apart: the first, then always the one farthest from those chosen."""
    chosen = [0]
    nearest = distances(entries, entries[:1])[:, 0]
    while len(chosen) < min(pivots, len(entries)):
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, distances(entries, entries[chosen[-1:]])[:, 0])
    return entries[chosen]


def assign(parts: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray, pivots: np.ndarray):
    """(index of the nearest entry, squared distance, number of exact evaluations).

    ``to_pivots`` holds the rounded-down distances of the parts to the pivots.
    """
    n, k = len(parts), len(entries)
    pivot_entry = _root(distances(pivots, entries))
    # |d(x, p) - d(p, e)| with each distance within [kept, kept + 1).
    bound = np.zeros((n, k), np.int64)
    for j in range(len(pivots)):
        gap = np.abs(to_pivots[:, j, None] - pivot_entry[None, j]) - 1
        np.maximum(bound, gap, out=bound)
    bound *= bound
    order = np.argsort(bound, axis=1, kind="stable")
    best = np.full(n, np.iinfo(np.int64).max)
    index = np.zeros(n, np.int64)
    active, evaluated = np.arange(n), 0
    for step in range(k):
        tried = order[active, step]
        # A bound equal to the best may belong to an equally near entry of a lower index.
        open_ = bound[active, tried] <= best[active]
        active, tried = active[open_], tried[open_]
        if not len(active):
            break
        evaluated += len(active)
        exact = ((parts[active] - entries[tried]) ** 2).sum(axis=1)
        old = best[active]
        better = (exact < old) | ((exact == old) & (tried < index[active]))
        index[active[better]], best[active[better]] = tried[better], exact[better]
    return index, best, evaluated


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _SLICE_ROWS):
            yield batch.slice(at, _SLICE_ROWS)


def _whole(parts: int, pivots: np.ndarray):
    """Vectors as whole numbers, filled up to ``parts`` equal parts, and distances to the pivots."""
    per = pivots.shape[2]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            vectors = batch.column(2)
            sizes = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            with np.errstate(over="ignore"):
                scaled = np.floor(values * SCALE).clip(-LARGEST, LARGEST).astype(np.int32)
            full = np.zeros((batch.num_rows, parts * per), np.int32)
            full[np.arange(full.shape[1])[None, :] < sizes[:, None]] = scaled
            cut = full.astype(np.int64).reshape(-1, parts, per)
            away = [_root(distances(cut[:, p], pivots[p])) for p in range(parts)]
            away = np.concatenate(away, axis=1).astype(np.int32)
            yield pa.record_batch(
                [batch.column(0), batch.column(1), _lists(full), _lists(away)],
                names=["id", "label", "whole", "away"],
            )

    return rows


def _lists(values: np.ndarray) -> pa.ListArray:
    n, k = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * k, pa.int32()), pa.array(values.reshape(-1)))


def _assigned(batch: pa.RecordBatch, books: np.ndarray, pivots: np.ndarray):
    """For each part position: its parts, and what ``assign`` gives for them."""
    parts, _, per = books.shape
    whole = _matrix(batch.column("whole"), parts * per).reshape(-1, parts, per)
    away = _matrix(batch.column("away"), parts * pivots.shape[1]).reshape(-1, parts, pivots.shape[1])
    for p in range(parts):
        yield whole[:, p], *assign(whole[:, p], away[:, p], books[p], pivots[p])


def _summer(books: np.ndarray, pivots: np.ndarray):
    parts, k, per = books.shape

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, n = np.zeros((parts, k, per), np.int64), np.zeros((parts, k), np.int64)
        for batch in _slices(batches):
            for p, (own, index, _, _) in enumerate(_assigned(batch, books, pivots)):
                np.add.at(totals[p], index, own)
                n[p] += np.bincount(index, minlength=k)
        p, e, j = (a.reshape(-1) for a in np.indices(totals.shape))
        some = n[p, e] > 0
        p, e, j = p[some], e[some], j[some]
        columns = [p.astype(np.int32), e.astype(np.int32), j.astype(np.int32), totals[p, e, j], n[p, e]]
        yield pa.record_batch([pa.array(c) for c in columns], names=["part", "entry", "place", "total", "n"])

    return rows


def _coder(books: np.ndarray, pivots: np.ndarray):
    parts = len(books)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            code = np.zeros((batch.num_rows, parts), np.uint8)
            error = np.zeros(batch.num_rows, np.int64)
            for p, (_, index, best, _) in enumerate(_assigned(batch, books, pivots)):
                code[:, p] = index
                error += best
            text = code.tobytes().hex()
            texts = [text[at : at + 2 * parts] for at in range(0, len(text), 2 * parts)]
            yield pa.record_batch(
                [batch.column("id"), batch.column("label"), pa.array(texts, pa.string()), pa.array(error)],
                names=["id", "label", "code", "error"],
            )

    return rows


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' components by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def moved(books: np.ndarray, sums: DataFrame) -> np.ndarray:
    """Entries at the floor of their parts' mean; entries without parts stay."""
    found = sums.groupBy("part", "entry", "place").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")
    )
    out = books.copy()
    for p, e, j, total, n in found.collect():
        out[p, e, j] = int(total) // n
    return out


def product_codes(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    pivots: int = PIVOTS,
) -> DataFrame:
    """vec_id, label, code, error, label_error, codebooks_sha256 of every kept vector.

    Dropped are rows whose vector is null or holds null, NaN or an infinity. ``code`` has two hex
    digits for each part's entry, ``error`` is the sum of the parts' squared distances and
    ``label_error`` the errors' sum over the rows of that label, nulls together. Repeated ids are
    separate rows; among equal ids the smaller vector comes first, null ids come last. Vectors shorter
    than the longest, or whose length is no multiple of ``parts``, are filled up with zeros; an empty
    one is all zeros. Components beyond +-2^28 after scaling saturate there. Of an empty table there
    are no rows. Other columns are not used, whatever their names.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(vec_id).cast("bigint").alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector")
    )
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    rows = rows.where(F.col("vector").isNotNull() & F.forall("vector", finite))
    (width,) = rows.agg(F.max(F.size("vector"))).first()
    per = max(1, -(-(width or 0) // parts))
    first = rows.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    books = np.zeros((parts, max(1, len(first)), per), np.int64)
    for e, (v,) in enumerate(first):
        full = np.zeros(parts * per)
        full[: len(v)] = v
        books[:, e] = np.floor(full * SCALE).clip(-LARGEST, LARGEST).astype(np.int64).reshape(parts, per)
    fixed = np.stack([choose_pivots(book, pivots) for book in books])
    label_type = rows.schema["label"].dataType.simpleString()
    whole = kept(
        rows.mapInArrow(
            _whole(parts, fixed),
            f"id bigint, label {label_type}, whole array<int>, away array<int>",
        ),
        "whole",
    )
    numbers = whole.select("whole", "away")
    for _ in range(rounds):
        books = moved(books, numbers.mapInArrow(_summer(books, fixed), _SUMS))
    coded = kept(
        whole.mapInArrow(
            _coder(books, fixed), f"id bigint, label {label_type}, code string, error bigint"
        ),
        "coded",
    )
    labels = kept(
        coded.groupBy(F.col("label").alias("of")).agg(
            F.sum(F.col("error").cast("decimal(38,0)")).cast("bigint").alias("label_error")
        ),
        "labels",
    )
    return coded.join(labels, F.col("label").eqNullSafe(F.col("of")), "left").select(
        F.col("id").alias("vec_id"),
        "label",
        "code",
        "error",
        "label_error",
        F.lit(books_digest(books)).alias("codebooks_sha256"),
    )
