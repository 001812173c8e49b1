"""Quality by ordinal cumulative-link regression on hashed text.

P(grade <= k) = 1 / (1 + exp(-(t_k - w.x))): one weight vector, shared by all grades, over hashed
words, and ordered thresholds t_0 < t_1 < ... The expected grade and the chance of a grade at or
above a mark follow from the same score. Trained in numpy by Adam on the full batch of a bounded
sample of rated rows, with an L2 penalty.

Features: the distinct words (letters and digits, A-Z lowered) hashed to ``DIMENSIONS``, each word
counted once, plus shape features of the text hashed to the same space: coarse shares of marks,
of repeated words and of capitals, and the length class.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from veracast.llm.common import alnum_words, arrow_type, kept, refuse_taken

DIMENSIONS = 1 << 16
# The training sample: at most so many rated rows.
TRAIN_ROWS = 8_000
RESULT = "expected_grade double, tail_probability double, selected boolean"
LEAST_TEXTS = 5
_KEPT_WORDS = 500_000


def shape(text: str, words: list[bytes]) -> list[bytes]:
    """Shape features, as words that no text can hold."""
    n = max(1, len(text))
    marks = sum(map(text.count, "#*$%&|<>!")) / n
    repeats = 1 - len(set(words)) / max(1, len(words))
    capitals = sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")) / n
    return [
        b"\0marks%d" % min(9, int(marks * 60)),
        b"\0repeats%d" % int(repeats * 10),
        b"\0capitals%d" % min(9, int(capitals * 20)),
        b"\0length%d" % len(words).bit_length(),
    ]


class Features:
    """Hashed feature places of texts; the hash of a word is kept while the task runs."""

    def __init__(self):
        self._known: dict[bytes, int] = {}

    def of(self, text: str | None) -> np.ndarray:
        words = alnum_words(text)
        known = self._known
        if len(known) > _KEPT_WORDS:
            known.clear()
        places = []
        for word in {*words, *shape(text or "", words)}:
            place = known.get(word)
            if place is None:
                place = known[word] = zlib.crc32(word) % DIMENSIONS
            places.append(place)
        return np.unique(np.array(places, np.int64))


def _value(count: np.ndarray) -> np.ndarray:
    """Weight of each feature of a text with ``count`` features."""
    return 1 / np.maximum(1, count) ** 0.1


def fit(
    places: list[np.ndarray], grades: np.ndarray, steps: int = 300, rate: float = 0.05, l2: float = 5e-4
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by Adam on the mean negative log likelihood."""
    n, top = len(places), int(grades.max(initial=0))
    weights = np.zeros(DIMENSIONS)
    if not n or not top:
        return weights, np.zeros(top)
    sizes = np.array([len(p) for p in places])
    flat, owner = np.concatenate(places), np.repeat(np.arange(n), sizes)
    # Features of fewer texts only memorise those; their weights stay 0.
    common = np.bincount(flat, minlength=DIMENSIONS)[flat] >= LEAST_TEXTS
    flat, owner = flat[common], owner[common]
    value = _value(sizes)[owner]
    below = np.array([np.mean(grades <= k) for k in range(top)]).clip(1e-3, 1 - 1e-3)
    thresholds = np.log(below / (1 - below))
    # Thresholds as the first one and the logarithms of the gaps keep their order.
    theta = np.concatenate([thresholds[:1], np.log(np.maximum(np.diff(thresholds), 1e-2))])
    moments = [np.zeros(DIMENSIONS + top), np.zeros(DIMENSIONS + top)]
    rows = np.arange(n)
    for step in range(1, steps + 1):
        gaps = np.exp(theta[1:])
        t = np.concatenate([[-np.inf], theta[0] + np.concatenate([[0.0], np.cumsum(gaps)]), [np.inf]])
        score = np.bincount(owner, weights=weights[flat] * value, minlength=n)
        upper, lower = t[grades + 1] - score, t[grades] - score
        up, low = _sigmoid(upper), _sigmoid(lower)
        chance = np.maximum(up - low, 1e-12)
        d_up, d_low = up * (1 - up) / chance, low * (1 - low) / chance
        g_score = (d_up - d_low) / n
        g_weights = np.bincount(flat, weights=g_score[owner] * value, minlength=DIMENSIONS)
        g_t = np.zeros(top + 2)
        np.add.at(g_t, grades[rows] + 1, -d_up / n)
        np.add.at(g_t, grades[rows], d_low / n)
        g_t = g_t[1:-1]
        tails = np.cumsum(g_t[::-1])[::-1]
        g_theta = np.concatenate([[g_t.sum()], tails[1:] * gaps])
        gradient = np.concatenate([g_weights + l2 * weights, g_theta])
        moments[0] = 0.9 * moments[0] + 0.1 * gradient
        moments[1] = 0.999 * moments[1] + 0.001 * gradient**2
        move = moments[0] / (1 - 0.9**step) / (np.sqrt(moments[1] / (1 - 0.999**step)) + 1e-8)
        weights -= rate * move[:DIMENSIONS]
        theta -= rate * move[DIMENSIONS:]
    return weights, theta[0] + np.concatenate([[0.0], np.cumsum(np.exp(theta[1:]))])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def train(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    grade: str = "grade",
    rows: int = TRAIN_ROWS,
) -> tuple[np.ndarray, np.ndarray]:
    """Model from at most ``rows`` ratings, those of the smallest hash of the key.

    The ratings are chosen from ``labels`` alone, before any text is read; the chosen keys, at most
    ``rows``, are broadcast to one scan of ``docs``. Copies of a text under several keys come in or
    stay out each by its own key. Ratings without a key or a grade are not used, repeated ones count
    once; of several texts of one key the one with the smallest hash counts, however long; a null
    text is an empty one. Features are made in the tasks; only their places come to the driver.
    """

    def places(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        features = Features()
        for texts in batches:
            out = [features.of(t.as_py()).tolist() for t in texts]
            yield pa.array(out, pa.list_(pa.int64()))

    hashed = F.arrow_udf(places, "array<bigint>").asNondeterministic()
    rated = labels.select(F.col(key).alias("key"), F.col(grade).cast("int").alias("grade"))
    rated = rated.where(F.col("key").isNotNull() & F.col("grade").isNotNull()).distinct()
    chosen = kept(
        rated.orderBy(F.xxhash64("key", F.lit("rated")), "key", "grade").limit(rows), "rated"
    )
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    texts = texts.join(F.broadcast(chosen), "key")
    texts = texts.select("key", "grade", F.xxhash64("text").alias("h"), hashed("text").alias("places"))
    one = texts.groupBy("key", "grade").agg(F.min_by("places", "h").alias("places"))
    found = one.orderBy("key", "grade").select("places", "grade").toArrow()
    lists = [p.values.to_numpy() for p in found.column("places")]
    return fit(lists, np.array(found.column("grade").to_pylist(), np.int64))


def grade(
    docs: DataFrame,
    model: tuple[np.ndarray, np.ndarray],
    mark: int = 2,
    least: float = 0.5,
    into: str = "_grade",
    text: str = "text",
) -> DataFrame:
    """``docs`` with a struct column ``into``: expected grade, chance of grade >= ``mark``, selected.

    A text is selected if that chance is at least ``least``. A null text is graded as an empty one.
    If nothing was rated, or all alike, the expected grade is 0 and nothing is selected. Every row,
    also a repeated one, gives one row, and its whole text counts, however long. Equal chances are
    equal results. A column ``into`` of ``docs`` is refused.
    """
    refuse_taken(docs, into)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = arrow_type(StructType.fromDDL(RESULT))

    def rows(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weights, thresholds = shared.value
        features = Features()
        for texts in batches:
            scores = []
            for t in texts:
                places = features.of(t.as_py())
                scores.append(weights[places].sum() * _value(np.array([len(places)]))[0])
            above = 1 - _sigmoid(thresholds[None, :] - np.array(scores)[:, None])
            tail = above[:, mark - 1] if len(thresholds) >= mark else np.zeros(len(scores))
            columns = [pa.array(above.sum(axis=1)), pa.array(tail), pa.array(tail >= least)]
            yield pa.StructArray.from_arrays(columns, fields=list(schema))

    return docs.withColumn(into, F.arrow_udf(rows, RESULT).asNondeterministic()(F.col(text)))
