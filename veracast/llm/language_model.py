"""Text scores from a log-bilinear language model trained with noise-contrastive estimation.

A token is predicted from the two before it: their vectors, each through a matrix of its own place,
add up to a predicted vector, whose product with a target vector plus its bias is a score. The
vocabulary holds every word seen ``LEAST_COUNT`` times or more in training, the commonest ``MOST_WORDS``
at most (a bound on memory: 9 MB of parameters), and one entry for all others. Words are cut by
frequency into classes of ``CLASS`` words; a word's probability is that of its class times its own
within the class. Both are softmaxes over a few hundred scores, so every probability is normalised
exactly by two batched matrix products, whatever the vocabulary.

Training covers every training document. Noise is drawn: classes from the unigram distribution, shared
by a mini-batch, and words for each token from the unigram distribution of its class. Documents are
dealt out to parts, and ordered within, by a hash of key and text, so the model does not follow file
splits or cores. The first part is trained alone; the others start from what it learnt, so that they
stay comparable, and their parameters are averaged row by row, weighted by how often each part
trained the row.

A word outside the vocabulary has the probability of its entry times its share of it:
(c + 1) / (N_o + V_o + 1), c its count, N_o and V_o tokens and distinct words outside in training.
Counts are over all training documents. The most frequent ``HEAD`` words are looked up in the tasks;
rarer ones are joined, one row for a document and word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from veracast.llm.common import kept, refuse_taken
from veracast.llm.encode import byte_slices

LEAST_COUNT, MOST_WORDS = 5, 65_535
CLASS = 256
WIDTH = 16
# Draws a mini-batch shares for classes, and draws a token has within its class.
CLASS_NOISE, WORD_NOISE = 64, 4
HEAD = 200_000
# Training tokens to a part, and the most parts: past that, larger ones.
PART_TOKENS, MOST_PARTS = 4_000_000, 16_384
RATE = 0.08
# The end of a text; no word is empty.
END = ""
_BATCH = 4096
# Tokens of whole documents that mini-batches are drawn from in one go.
_STIRRED = 500_000
_BLOCK_ROWS = 4096
_SCORED_ROWS, _CACHED_ROWS, _PICKED_ROWS = 524_288, 192, 65_536
# Slices of a batch of texts whose words are looked up in one go.
_LOOKED_UP = 4
# Stretches of a class's line, each with the first word in it.
_STRETCHES = 1024
# Gradients of one row up to which they are added row by row.
_FEW_ROWS = 8
# Scores up to this have exponentials whose sum over a class fits single precision.
_SAFE = 80.0


def tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct tokens of a batch, the index of each token, and tokens per text (end included)."""
    texts = pc.take(texts.cast(pa.large_string()), pa.array(np.arange(len(texts))))
    runs = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    coded = runs.flatten().dictionary_encode()
    distinct = coded.dictionary
    index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    named = pc.binary_length(distinct).to_numpy(zero_copy_only=False) > 0
    real = named.take(index)
    before = np.concatenate([[0], np.cumsum(real)])[runs.offsets.to_numpy()]
    if named.all():
        end = len(distinct)
        distinct = pa.concat_arrays([distinct, pa.array([END], distinct.type)])
    else:
        end = int(np.flatnonzero(~named)[0])
    return distinct, np.insert(index[real], before[1:], end), np.diff(before) + 1


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, count) over all rows; END counts the rows. Counted per batch before the shuffle."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, n in byte_slices(batch.column(0), 16 << 20):
                distinct, index, _ = tokens(batch.column(0).slice(at, n))
                count = np.bincount(index, minlength=len(distinct))
                used = np.flatnonzero(count)
                words = distinct.take(pa.array(used)).cast(pa.string())
                yield pa.record_batch([words, pa.array(count[used])], names=["word", "count"])

    counted = docs.select(text).mapInArrow(rows, "word string, count bigint")
    return counted.groupBy("word").agg(F.sum("count").alias("count"))


class LogBilinear:
    """Parameters as four tables; entry 0 of the vocabulary is the one of all other words.

    ``context`` holds a row a word and one for what stands before a text, ``target`` and ``classes`` a
    vector and a bias a row, ``places`` the matrices of the far and the near word.
    """

    NAMES = ("context", "target", "classes", "places")

    def __init__(self, tables: list[np.ndarray], frequency: np.ndarray):
        self.context, self.target, self.classes, self.places = tables
        size = len(frequency)
        self.frequency = frequency
        self.of_class = np.arange(size) // CLASS
        share = frequency / frequency.sum()
        self.class_share = np.bincount(self.of_class, weights=share)
        self.word_share = (share / self.class_share[self.of_class]).astype(np.float32)
        # Logarithms of the expected number of times that noise draws an entry.
        self.class_noise = np.log(CLASS_NOISE * self.class_share).astype(np.float32)
        self.word_noise = np.log(WORD_NOISE * self.word_share)
        # Each class takes an equal stretch of the line from which words are drawn.
        within = np.concatenate([[0.0], np.cumsum(share / self.class_share[self.of_class])])
        self._within = within
        self._starts = within[np.arange(len(self.class_share)) * CLASS]
        edges = self._starts[:, None] + np.arange(_STRETCHES) / _STRETCHES
        self._guide = np.searchsorted(within, edges.reshape(-1), "right").astype(np.int32)
        self._class_line = np.cumsum(self.class_share)

    @classmethod
    def start(cls, frequency: np.ndarray, seed: int = 3) -> LogBilinear:
        """Small random vectors; biases give the unigram distribution."""
        draw = np.random.default_rng(seed)
        size, classes = len(frequency), -(-len(frequency) // CLASS)
        tables = [draw.normal(0, 0.1, (size + 1, WIDTH)), draw.normal(0, 0.1, (size, WIDTH + 1))]
        tables += [draw.normal(0, 0.1, (classes, WIDTH + 1)), np.concatenate([0.5 * np.eye(WIDTH), np.eye(WIDTH)])]
        model = cls([t.astype(np.float32) for t in tables], frequency)
        model.target[:, WIDTH] = np.log(model.word_share)
        model.classes[:, WIDTH] = np.log(model.class_share)
        return model

    @property
    def tables(self) -> list[np.ndarray]:
        return [self.context, self.target, self.classes, self.places]

    def moved(self) -> tuple[np.ndarray, np.ndarray]:
        """What every word adds to a predicted vector, as the far and as the near one."""
        far, near = np.split(self.places.astype(np.float64), 2)
        return self.context @ far, self.context @ near

    def log_probabilities(self, words: np.ndarray, far: np.ndarray, near: np.ndarray, moved=None) -> np.ndarray:
        """Normalised natural logarithms of each word behind its two words; ``moved`` is that of the model.

        A softmax is summed once for the tokens that share it: over classes for two words before,
        within a class for those and the class. A token's result does not depend on the others.
        """
        out = np.empty(len(words))
        size = len(self.context)
        far_moved, near_moved = moved or self.moved()
        for at in range(0, len(words), _SCORED_ROWS):
            some = slice(at, at + _SCORED_ROWS)
            key = far[some] * size + near[some]
            by_pair = np.argsort(key)
            key = key.take(by_pair)
            new = _changes(key)
            pair = np.cumsum(new) - 1
            far_word, near_word = np.divmod(key[new], size)
            q = np.ones((len(far_word), WIDTH + 1), np.float32)
            for first in range(0, len(q), _PICKED_ROWS):
                few = slice(first, first + _PICKED_ROWS)
                vectors = far_moved.take(far_word[few], axis=0)
                vectors += near_moved.take(near_word[few], axis=0)
                q[few, :WIDTH] = vectors
            # Tokens of one class lie side by side for one product each, those of one pair within.
            own = words[some].take(by_pair)
            kind = self.of_class.take(own)
            by_kind = _order(kind, len(self.classes))
            own, kind, pair = own.take(by_kind), kind.take(by_kind), pair.take(by_kind)
            logs = -_log_sums(q, self.classes).take(pair)
            new = _changes(kind) | _changes(pair)
            cell = np.cumsum(new) - 1
            kinds, rows = kind[new], pair[new]
            sums = np.empty(len(rows))
            begin = 0
            for end in (np.flatnonzero(np.diff(kinds, append=-1)) + 1).tolist():
                vectors = q.take(rows[begin:end], axis=0)
                first = int(kinds[begin]) * CLASS
                sums[begin:end] = _log_sums(vectors, self.target[first : first + CLASS])
                sums[begin:end] -= np.einsum("bd,d->b", vectors, self.classes[kinds[begin]])
                begin = end
            logs -= sums.take(cell)
            for first in range(0, len(own), _PICKED_ROWS):
                few = slice(first, first + _PICKED_ROWS)
                vectors = q.take(pair[few], axis=0)
                logs[few] += np.einsum("bd,bd->b", vectors, self.target.take(own[few], axis=0))
            out[some][by_pair.take(by_kind)] = logs
        return out

    def draw_words(self, kind: np.ndarray, draw: np.random.Generator, order=None) -> np.ndarray:
        """``WORD_NOISE`` words for each class given, by their share of the class.

        ``order`` tells which one's turn it was to draw.
        """
        share = draw.random((len(kind), WORD_NOISE))
        if order is not None:
            share = share.take(order, axis=0)
        at = (self._starts.take(kind)[:, None] + share).reshape(-1)
        stretch = kind[:, None] * _STRETCHES + (share * _STRETCHES).astype(np.int64)
        # The first boundary beyond a draw: on from that beyond its stretch's edge.
        found = self._guide.take(stretch.reshape(-1))
        left = np.flatnonzero(self._within.take(found, mode="clip") <= at)
        for _ in range(2):
            found[left] += 1
            left = left[self._within.take(found.take(left), mode="clip") <= at.take(left)]
        found[left] = np.searchsorted(self._within, at.take(left), "right")
        found = found.reshape(share.shape) - 1
        last = np.minimum((kind + 1) * CLASS, len(self.word_share)) - 1
        return np.clip(found, (kind * CLASS)[:, None], last[:, None])

    def step(self, words, far, near, draw, squares, seen) -> None:
        """One step on the contrastive loss of a mini-batch, classes and words within them.

        Tokens are taken by word, so that what is looked up for one lies near what the next one needs.
        """
        order = _order(words, len(self.target))
        words, far, near = words.take(order), far.take(order), near.take(order)
        f, n = self.context.take(far, axis=0), self.context.take(near, axis=0)
        q = np.ones((len(words), WIDTH + 1), np.float32)
        q[:, :WIDTH] = f @ self.places[:WIDTH]
        q[:, :WIDTH] += n @ self.places[WIDTH:]
        kind = self.of_class.take(words)
        noise = np.searchsorted(self._class_line, draw.random(CLASS_NOISE) * self._class_line[-1])
        noise = np.minimum(noise, len(self.classes) - 1)
        # Classes: the true one against the draws of the batch.
        true, drawn_classes = self.classes.take(kind, axis=0), self.classes.take(noise, axis=0)
        g_true = _sigmoid(np.einsum("bd,bd->b", q, true) - self.class_noise.take(kind)) - 1
        against = -drawn_classes
        against[:, WIDTH] += self.class_noise.take(noise)
        g_noise = _falling(q @ against.T)
        gq = g_noise @ drawn_classes
        true *= g_true[:, None]
        gq += true
        g_class = np.concatenate([g_true[:, None] * q, g_noise.T @ q])
        # Words: the true one against draws from its class.
        drawn = np.concatenate([words[:, None], self.draw_words(kind, draw, order)], axis=1)
        vectors = self.target.take(drawn, axis=0)
        g = _sigmoid(np.einsum("bd,bkd->bk", q, vectors) - self.word_noise.take(drawn))
        g[:, 0] -= 1
        gq += np.einsum("bk,bkd->bd", g, vectors)
        gq = np.ascontiguousarray(gq[:, :WIDTH])
        g_places = np.concatenate([f.T @ gq, n.T @ gq])
        g_context = np.concatenate([gq @ self.places[:WIDTH].T, gq @ self.places[WIDTH:].T])
        one = g.reshape(-1)
        changes = (
            (np.concatenate([far, near]), lambda at: g_context.take(at, axis=0)),
            (drawn.reshape(-1), lambda at: q.take(at // drawn.shape[1], axis=0) * one.take(at)[:, None]),
            (np.concatenate([kind, noise]), lambda at: g_class.take(at, axis=0)),
        )
        for table, square, count, (rows, gradients) in zip(self.tables, squares, seen, changes):
            rows, times, total = _row_sums(rows, len(table), gradients)
            sums = square.take(rows) + np.einsum("bd,bd->b", total, total) / np.float32(total.shape[1])
            square[rows] = sums
            total *= (RATE / np.sqrt(sums + 1e-6))[:, None]
            # A row moves as one value.
            as_one = np.dtype((np.void, table.itemsize * table.shape[1]))
            moved = np.subtract(table.take(rows, axis=0), total, out=total)
            table.view(as_one).reshape(-1)[rows] = moved.view(as_one).reshape(-1)
            count[rows] += times
        # The matrices move whole.
        squares[3] += np.einsum("bd,bd->b", g_places, g_places) / np.float32(WIDTH)
        g_places *= (RATE / np.sqrt(squares[3] + 1e-6))[:, None]
        self.places -= g_places
        seen[3] += 1


def _row_sums(rows: np.ndarray, size: int, gradients) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct row numbers, how often each is in ``rows``, and the sum of its gradients.

    ``gradients`` gives those at some places of ``rows``. Rows with few of them are added side by side,
    the first of all, then the second of those that have one, and so on.
    """
    order = _order(rows, size)
    rows = rows.take(order)
    begin = np.flatnonzero(_changes(rows))
    times = np.empty_like(begin)
    np.subtract(begin[1:], begin[:-1], out=times[:-1])
    times[-1] = len(order) - begin[-1]
    many = times > _FEW_ROWS
    of_many = order[np.repeat(many, times)]
    most = times[many]
    # Those with many come first, then by falling number.
    rank = (_FEW_ROWS + 1 - np.minimum(times, _FEW_ROWS + 1)).astype(np.uint8)
    falling = np.argsort(rank, kind="stable")
    begin, times = begin.take(falling), times.take(falling)
    total = gradients(order.take(begin))
    if len(most):
        total[: len(most)] = np.add.reduceat(gradients(of_many), np.cumsum(most) - most, axis=0)
    # How many rows have more gradients than k.
    ends = np.cumsum(np.bincount(rank, minlength=_FEW_ROWS + 1))[::-1]
    for k in range(1, _FEW_ROWS):
        own = slice(len(most), int(ends[k]))
        if own.stop > own.start:
            total[own] += gradients(order.take(begin[own] + k))
    return rows.take(begin), times, total


def _changes(x: np.ndarray) -> np.ndarray:
    """Whether each value differs from the one before it, as the first does."""
    out = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=out[1:])
    return out


def _order(rows: np.ndarray, size: int) -> np.ndarray:
    """Stable order of row numbers below ``size``; 16 bits are sorted by digits, the few beyond come last."""
    if size <= 1 << 8:
        return np.argsort(rows.astype(np.uint8), kind="stable")
    low = np.argsort(rows.astype(np.uint16), kind="stable")
    if size <= 1 << 16:
        return low
    return low.take(np.argsort((rows.take(low) >> 16).astype(np.uint8), kind="stable"))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return _falling(np.negative(x, out=x))


def _falling(x: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(x)), in place; an exponential beyond single precision gives 0."""
    with np.errstate(over="ignore"):
        np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _log_sums(q: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Logarithm of the sum of exponentials over ``targets`` for each row, in blocks a cache holds.

    Products are taken in double precision and then rounded, as single ones would follow a row's place
    in the block. The largest is taken off where the vectors' lengths do not rule out an overflow.
    """
    out = np.empty(len(q))
    across = np.ascontiguousarray(targets.T, np.float64)
    longest = float(np.sqrt(np.einsum("bd,bd->b", targets, targets).max()))
    large = np.sqrt(np.einsum("bd,bd->b", q, q)) * longest > _SAFE
    # A block's room is used again, so that it stays in the cache.
    shape = min(_CACHED_ROWS, len(q)), len(targets)
    products, rounded = np.empty(shape), np.empty(shape, np.float32)
    for first in range(0, len(q), _CACHED_ROWS):
        some = slice(first, min(first + _CACHED_ROWS, len(q)))
        scores, top = rounded[: some.stop - first], np.float32(0)
        scores[...] = np.matmul(q[some].astype(np.float64), across, out=products[: len(scores)])
        if (own := large[some]).any():
            top = np.where(own, scores.max(axis=1), np.float32(0))
            scores -= top[:, None]
        np.exp(scores, out=scores)
        out[some] = top + np.log(np.einsum("bk->b", scores).astype(np.float64))
    return out


def _places(distinct: pa.Array, known: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Place of each word in ``known``, -1 if it is not there, and its entry in a vocabulary of ``size``.

    The vocabulary is the beginning of ``known`` behind the entry of all other words.
    """
    at = pc.fill_null(pc.index_in(distinct, value_set=known), -1).to_numpy(zero_copy_only=False)
    return at, np.where(at < size - 1, at + 1, 0)


def _contexts(words: np.ndarray, sizes: np.ndarray, outside: int) -> tuple[np.ndarray, np.ndarray]:
    start = np.zeros(len(words), bool)
    start[np.cumsum(sizes) - sizes] = True
    near = np.concatenate([[outside], words[:-1]])
    near[start] = outside
    far = np.concatenate([[outside], near[:-1]])
    far[start] = outside
    return far, near


def _encoder(shared):
    """(h, text) to (h, ids): vocabulary indices of all tokens as unsigned 16-bit numbers."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = pa.array(shared.value, pa.large_string())
        for batch in batches:
            for at, n in byte_slices(batch.column(1), 4 << 20):
                distinct, index, sizes = tokens(batch.column(1).slice(at, n))
                flat = _places(distinct, words, len(words) + 1)[1].astype(np.uint16).take(index)
                ends = np.concatenate([[0], np.cumsum(sizes)]) * 2
                ids = pa.Array.from_buffers(
                    pa.large_binary(), n, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(flat)]
                ).cast(pa.binary())
                yield pa.record_batch([batch.column(0).slice(at, n), ids], names=["h", "ids"])

    return rows


_ROWS_OF = "name string, block int, part int, rows binary, times binary"


def _trainer(shared):
    """One part's documents, in order, to its parameters, a row for each block of a table.

    Behind a row's parameters stands its sum of squared gradients, which sets its step.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        tables, squares, frequency, phase = shared.value
        model, squares = LogBilinear([t.copy() for t in tables], frequency), [q.copy() for q in squares]
        draw, outside, trained = np.random.default_rng([phase, part]), len(frequency), False
        seen = [np.zeros(len(t), np.float32) for t in model.tables]
        for batch in batches:
            column = batch.column("ids")
            lengths = np.diff(np.frombuffer(column.buffers()[1], np.int32)[column.offset :][: len(column) + 1])
            begin = np.frombuffer(column.buffers()[1], np.int32)[column.offset]
            data = np.frombuffer(column.buffers()[2], np.uint8)[begin : begin + lengths.sum()]
            flat, sizes = data.copy().view(np.uint16), lengths // 2
            ends = np.cumsum(sizes)
            first = 0
            while first < len(sizes):
                done = ends[first] - sizes[first]
                last = max(first + 1, int(np.searchsorted(ends, done + _STIRRED, "right")))
                words = flat[done : ends[last - 1]].astype(np.int64)
                far, near = _contexts(words, sizes[first:last], outside)
                # A token and the two before it, of 17 bits each, move as one number.
                stirred = (words << 34 | far << 17 | near).take(draw.permutation(len(words)))
                for at in range(0, len(words), _BATCH):
                    some = stirred[at : at + _BATCH]
                    model.step(some >> 34, some >> 17 & 0x1FFFF, some & 0x1FFFF, draw, squares, seen)
                first, trained = last, True
        if not trained:
            return
        for name, table, square, times in zip(LogBilinear.NAMES, model.tables, squares, seen):
            table = np.concatenate([table, square[:, None]], axis=1)
            for block, at in enumerate(range(0, len(table), _BLOCK_ROWS)):
                own, n = table[at : at + _BLOCK_ROWS], times[at : at + _BLOCK_ROWS]
                columns = [[name], [block], [part], [(own * n[:, None]).tobytes()], [n.tobytes()]]
                types = [pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
                yield pa.record_batch(
                    [pa.array(c, t) for c, t in zip(columns, types)],
                    names=["name", "block", "part", "rows", "times"],
                )

    return rows


def _adder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks in order of name, number and part to their sums, one block held at a time."""
    names = ["name", "block", "part", "rows", "times"]
    types = [pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]

    def given():
        columns = [[current[0]], [current[1]], [0], [total.tobytes()], [times.tobytes()]]
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    current, total, times = None, None, None
    for batch in batches:
        for i in range(batch.num_rows):
            at = (batch.column(0)[i].as_py(), batch.column(1)[i].as_py())
            own = np.frombuffer(batch.column(3)[i].as_py(), np.float32).astype(np.float64)
            n = np.frombuffer(batch.column(4)[i].as_py(), np.float32).astype(np.float64)
            if at != current:
                if current is not None:
                    yield given()
                current, total, times = at, own, n
            else:
                total, times = total + own, times + n
    if current is not None:
        yield given()


def train(
    docs: DataFrame,
    words: list[str],
    frequency: np.ndarray,
    tokens_given: int,
    text: str = "text",
    key: str | None = None,
) -> LogBilinear:
    """The model after one pass over all rows of ``docs``; ``words`` are entries 1 and on.

    The number of parts follows the tokens alone. To the driver come the averaged parameters.
    """
    parts = max(1, min(MOST_PARTS, -(-tokens_given // PART_TOKENS)))
    model = LogBilinear.start(frequency)
    squares = [np.zeros(len(t), np.float32) for t in model.tables]
    places = docs.sparkSession.sparkContext.broadcast(words)
    h = F.xxhash64(*([F.col(key)] if key else []), F.col(text))
    rows = docs.select(h.alias("h"), F.col(text).alias("text"))
    part = F.pmod("h", F.lit(parts)).cast("int")
    _train_parts(rows.where(part == 0), 1, F.lit(0), places, model, squares, phase=0)
    if parts > 1:
        _train_parts(rows.where(part > 0), parts, part, places, model, squares, phase=1)
    return model


def _train_parts(rows, parts: int, part, places, model: LogBilinear, squares, phase: int) -> None:
    """Train parts from the model as it is, and put their averages in its place."""
    frequency = model.frequency
    shared = rows.sparkSession.sparkContext.broadcast((model.tables, squares, frequency, phase))
    coded = rows.mapInArrow(_encoder(places), "h bigint, ids binary")
    dealt = coded.repartitionById(parts, part).sortWithinPartitions("h", "ids")
    added = (
        dealt.mapInArrow(_trainer(shared), _ROWS_OF)
        .repartition("name", "block")
        .sortWithinPartitions("name", "block", "part")
        .mapInArrow(_adder, _ROWS_OF)
        .toArrow()
    )
    for name, block, total, times in zip(*(added.column(c).to_pylist() for c in ("name", "block", "rows", "times"))):
        number = LogBilinear.NAMES.index(name)
        n = np.frombuffer(times, np.float64)
        mean = np.frombuffer(total, np.float64).reshape(len(n), -1) / np.maximum(n, 1)[:, None]
        # Rows that no part trained stay as they were.
        own = slice(block * _BLOCK_ROWS, block * _BLOCK_ROWS + len(n))
        model.tables[number][own][n > 0] = mean[n > 0, :-1]
        squares[number][own][n > 0] = mean[n > 0, -1]


_SCORED = (
    "n_tokens bigint, model double, outside bigint, known bigint, logs double, inside_logs double, "
    "rare array<struct<word: string, times: bigint>>"
)


def _scorer(shared):
    def rows(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tables, frequency, known, counts = shared.value
        model, known = LogBilinear(tables, frequency), pa.array(known, pa.large_string())
        moved = model.moved()
        for texts in batches:
            parts = []
            slices = list(byte_slices(texts, 3 << 20)) or [(0, 0)]
            for first in range(0, len(slices), _LOOKED_UP):
                # Several slices are looked up in one go, as each builds an index of all words known.
                read = [tokens(texts.slice(at, n)) for at, n in slices[first : first + _LOOKED_UP]]
                at, entry = _places(pa.concat_arrays([r[0] for r in read]), known, len(frequency))
                ends = np.cumsum([len(r[0]) for r in read])[:-1]
                for one, own_at, own_entry in zip(read, np.split(at, ends), np.split(entry, ends)):
                    parts.append(_scored(*one, own_at, own_entry, model, moved, counts))
            yield pa.concat_arrays(parts)

    return F.arrow_udf(rows, _SCORED).asNondeterministic()


def _scored(distinct, index, sizes, at, entry, model, moved, counts) -> pa.StructArray:
    words = entry.astype(np.int64).take(index)
    far, near = _contexts(words, sizes, len(model.frequency))
    log_p = model.log_probabilities(words, far, near, moved)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    sums = lambda x: np.bincount(owner, weights=x, minlength=len(sizes))
    # The last count, 0, is that of words beyond the head.
    count = counts.take(at)
    logs = np.log10(count + 1.0).take(index)
    count = count.take(index)
    inside = words > 0
    # Words beyond the head, once for each text they are in.
    rare = np.flatnonzero(count == 0)
    cells, times = np.unique(owner[rare] * len(distinct) + index[rare], return_counts=True)
    offsets = np.searchsorted(cells, np.arange(len(sizes) + 1) * len(distinct))
    rare_words = distinct.take(pa.array(cells % len(distinct))).cast(pa.string())
    lists = pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32()),
        pa.StructArray.from_arrays([rare_words, pa.array(times)], ["word", "times"]),
    )
    whole = lambda x: pa.array(sums(x).astype(np.int64))
    columns = [
        pa.array(sizes), pa.array(sums(log_p) / np.log(10)), whole(~inside), whole(count > 0),
        pa.array(sums(logs)), pa.array(sums(np.where(inside, logs, 0.0))), lists,
    ]
    names = ["n_tokens", "model", "outside", "known", "logs", "inside_logs", "rare"]
    return pa.StructArray.from_arrays(columns, names)


def score(
    docs: DataFrame,
    training: DataFrame,
    text: str = "text",
    key: str | None = None,
    least_count: int = LEAST_COUNT,
    most_words: int = MOST_WORDS,
    head: int = HEAD,
    into: str = "_lm",
) -> DataFrame:
    """``docs`` with a struct ``into``: n_tokens, n_known, n_modelled, train_tokens, base_score, score.

    ``base_score`` is the sum of log10((c + 1) / (N + V + 1)), ``score`` the model's log10 probability
    of the text, its end included, ``n_modelled`` the tokens that are vocabulary words of their own. A
    null or empty text is its end alone. Without training rows all counts are 0 and the model knows
    one entry. ``key`` names a column that tells training rows of one text apart. Every row gives one
    row, however long its text; other columns stay, the text is not carried along, and a column
    ``into`` is refused. Words of equal count enter the vocabulary in their order.
    """
    refuse_taken(docs, into)
    spark = docs.sparkSession
    counts = kept(word_counts(training, text), "counts")
    total, distinct = counts.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count("*")).first()
    top = counts.orderBy(F.desc("count"), "word").limit(head).toArrow()
    known = dict(zip(top.column("word").to_pylist(), top.column("count").to_pylist()))
    common = [w for w, n in known.items() if n >= least_count][:most_words]
    inside = [known[w] for w in common]
    others = total - sum(inside)
    frequency = np.array([max(others, 1), *inside], float)
    model = train(training, common, frequency, total, text, key) if total else LogBilinear.start(frequency)
    head_counts = np.array([*known.values(), 0], np.int64)
    shared = spark.sparkContext.broadcast((model.tables, frequency, list(known), head_counts))
    rest = [docs[c] for c in docs.columns if c != text]
    scored = docs.select(
        F.monotonically_increasing_id().alias("_uid"),
        (F.struct(*rest) if rest else F.lit(None).cast("int")).alias("_row"),
        _scorer(shared)(docs[text]).alias("_s"),
    )
    scored = kept(scored, "scored")
    rare = scored.select("_uid", F.explode("_s.rare").alias("r")).select("_uid", "r.word", "r.times")
    joined = rare.join(counts, "word").groupBy("_uid").agg(
        F.sum(F.col("times") * F.log10(F.col("count") + 1.0)).alias("rare_logs"),
        F.sum("times").alias("rare_known"),
    )
    whole = scored.drop("rare").join(joined, "_uid", "left")
    s, rare_logs = F.col("_s"), F.coalesce("rare_logs", F.lit(0.0))
    logs = s["logs"] + rare_logs
    of_class = np.log10(others + distinct - len(common) + 1.0)
    lm = F.struct(
        s["n_tokens"].alias("n_tokens"),
        (s["known"] + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        (s["n_tokens"] - s["outside"]).alias("n_modelled"),
        F.lit(int(total)).cast("bigint").alias("train_tokens"),
        (logs - s["n_tokens"] * F.lit(float(np.log10(total + distinct + 1.0)))).alias("base_score"),
        (s["model"] + logs - s["inside_logs"] - s["outside"] * F.lit(float(of_class))).alias("score"),
    )
    return whole.select(*[F.col("_row")[c].alias(c) for c in docs.columns if c != text], lm.alias(into))
